"""Every registered query with SQL gives the same rows as that SQL in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from basketry.plans.registered import REGISTERED

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "SMALLINT": "smallint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def sql(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(name, spark, folder, sql):
    df = entry.queries()[name](spark, folder)
    columns = sorted(df.columns)
    got = sorted(tuple(repr(r[c]) for c in columns) for r in df.collect())
    cursor = sql.execute(entry.oracle_sql()[name])
    described = {d[0]: TYPES[str(d[1])] for d in cursor.description}
    names = [d[0] for d in cursor.description]
    expected = sorted(
        tuple(repr(r[names.index(c)]) for c in columns) for r in cursor.fetchall()
    )
    assert sorted(names) == columns
    assert got == expected
    assert dict(df.dtypes) == described


def test_every_query_has_sql():
    assert set(REGISTERED) <= set(entry.oracle_sql())


def test_every_operator_has_a_query():
    counts = {"I": 11, "Q": 14, "E": 16, "S": 9, "R": 6, "C": 11, "K": 15, "V": 2, "M": 12}
    wanted = {f"{group}{k}" for group, n in counts.items() for k in range(1, n + 1)}
    assert {q.item for q in REGISTERED.values()} == wanted


def test_entry_gives_ranked_items(spark):
    rows = entry.entry(spark).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    assert [r["score"] for r in rows] == sorted((r["score"] for r in rows), reverse=True)
