"""Append-only dictionary of ids: a number, once given, stays and is never given again."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.ranking import number_rows
from basketry.sources import tables


def append_ids(df: DataFrame, column: str, uri: str, index: str = "index") -> DataFrame:
    """Number the ids of ``df`` that the dictionary under ``uri`` lacks, and return it whole.

    New ids get the next numbers from 0, in ascending order of the id within a call; nulls get
    none. Only the new ones are written, and a commit takes the entry behind the one that was
    read, only if nobody has taken it: else what the other writer added is left out and the
    rest is numbered again. A part without an entry is never read, so a lost writer leaves no
    gap; a batch that is repeated adds nothing.
    """
    spark = df.sparkSession
    ids = df.select(column).where(F.col(column).isNotNull()).distinct()
    while True:
        entries = _entries(spark, uri)
        new, first = ids, 0
        if entries:
            known = _read(spark, uri, entries)
            if known.schema[column].dataType != df.schema[column].dataType:
                raise TypeError(f"{column} is {known.schema[column].dataType} in the dictionary")
            new = ids.join(known, column, "left_anti")
            first = entries[-1]["first"] + entries[-1]["rows"]
        path = tables.new_version(spark, uri)
        numbered = number_rows(new, [F.col(column)], index)
        numbered.withColumn(index, F.col(index) + F.lit(first)).write.parquet(path)
        rows = spark.read.parquet(path).count()
        if not rows and entries:
            tables._delete(spark, path)
            return _read(spark, uri, entries)
        entry = {"version": path.rsplit("/", 1)[1], "rows": rows, "first": first}
        target = f"{tables._log(uri)}/{len(entries) + 1:012d}"
        if tables._put_if_absent(spark, target, json.dumps(entry)):
            return _read(spark, uri, [*entries, entry])
        tables._delete(spark, path)


def read_dictionary(spark: SparkSession, uri: str) -> DataFrame:
    """All ids and their numbers, as of the last commit."""
    entries = _entries(spark, uri)
    if not entries:
        raise FileNotFoundError(f"no dictionary under {uri}")
    return _read(spark, uri, entries)


def _entries(spark: SparkSession, uri: str) -> list[dict]:
    """Entries of the commit log, one for each call that found new ids."""
    numbers = sorted(tables._numbers(spark, uri))
    return [tables._read_entry(spark, f"{tables._log(uri)}/{k:012d}") for k in numbers]


def _read(spark: SparkSession, uri: str, entries: list[dict]) -> DataFrame:
    return spark.read.parquet(*(f"{tables._versions(uri)}/{e['version']}" for e in entries))
