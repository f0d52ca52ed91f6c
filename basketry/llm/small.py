"""Tables of a few rows that a parameter bounds, as part of the plan."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOST = 20_000  # rows beyond which the table is spread out and joined by a shuffle


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows of plain values under a schema such as "a int, b string".

    The optimizer knows how small such a table is and broadcasts it by itself.
    """
    rows = list(rows)
    if len(rows) > MOST or not rows:
        return spark.createDataFrame(rows, schema)
    names = [field.split()[0] for field in schema.split(",")]
    listed = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    parsed = F.from_json(F.lit(listed), f"array<struct<{schema}>>")
    return spark.range(1, numPartitions=1).select(F.inline(parsed))
