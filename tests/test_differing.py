"""Moves of rows when tables are compared."""

from __future__ import annotations

from conftest import rows_of
from pyspark.sql import functions as F

from basketry.operators import quality as Q


def test_rows_move_once_at_most(spark, monkeypatch):
    left = spark.range(3000).select((F.col("id") % 700).alias("a"), F.lit("x").alias("b"))
    right = left.where("a % 50 <> 7")
    plan = Q.differing_rows(left, right)._jdf.queryExecution().executedPlan().toString()
    # Only partial aggregates are shuffled, no row for a join.
    lines = plan.splitlines()
    below = [lines[k + 1] for k, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert below and all("HashAggregate" in line and "partial_" in line for line in below)
    assert "SortMergeJoin" not in plan
    expected = sorted(
        (a, "x", 3000 // 700 + (a < 3000 % 700), 0) for a in range(700) if a % 50 == 7
    )
    for buckets in (1, 64, 1 << 16):
        monkeypatch.setattr(Q, "FINE_BUCKETS", buckets)
        assert rows_of(Q.differing_rows(left, right)) == sorted(expected, key=repr)
        assert Q.differing_rows(left, left.orderBy(F.desc("a"))).isEmpty()
