"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import scratch_path


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the edges (a, b): root is the smallest node reachable.

    Each round hangs the larger neighbours of every node, then the smaller ones, under its
    least neighbour, so paths shrink by halves; it ends when the edges are stars. Every
    round's edges are written to the shared folder, which cuts lineage and survives lost
    executors. Minima are combined before the shuffle and a hot node only repeats in joins,
    which adaptive execution can split. Self-loops and nulls are dropped.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges, state = _written(edges.distinct())
    while True:
        edges, after = _written(_small(_large(edges)))
        if after == state:
            break
        state = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.join(least, "a")
        .where("b > a and b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    path = scratch_path(edges.sparkSession, "edges")
    edges.write.parquet(path)
    kept = edges.sparkSession.read.schema("a long, b long").parquet(path)
    total = kept.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("h")).first()
    return kept, (total["n"], total["h"])
