"""Ranks and row numbers under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import cut_lineage

# monotonically_increasing_id() keeps the partition number above these bits.
_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group, numbered from 1.

    The filter on the row number lets Catalyst prune every map partition to ``n`` rows per
    group before the shuffle, so a group holding a third of all rows sends only ``n`` rows
    per map task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def number_rows(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Dense 0-based position of every row under a total ``order``.

    Range partitioning on the whole order spreads the rows evenly whatever the keys are.
    The sorted rows are checkpointed, which pins them to their partitions; a position is
    then the place inside the partition plus the size of all partitions before it.
    """
    ordered = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    place = F.monotonically_increasing_id()
    placed = ordered.withColumn("_place", place).select(
        "*",
        F.shiftright("_place", _POSITION_BITS).alias("_part"),
        F.col("_place").bitwiseAND(F.lit(_POSITION_MASK)).alias("_offset"),
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    # ``starts`` has one row per partition of the sort: bounded by the partition count.
    return placed.join(starts, "_part").select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("_start") + F.col("_offset")).alias(name),
    )


def rank_within(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], rank: str = "rank"
) -> DataFrame:
    """Rank every row inside its group with one shuffle on the group.

    For groups whose size is bounded by construction; ``rank_within_large`` is for others.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window))


def rank_within_large(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], rank: str = "rank"
) -> DataFrame:
    """Same result as ``rank_within`` when a single group may hold a third of all rows.

    All rows are numbered along (group, order), which spreads a large group over many
    range partitions; subtracting the first number of the group gives the rank.  The first
    numbers are partial aggregates, and the join back on the group is one adaptive
    execution can split, its other side having one row per group.
    """
    numbered = number_rows(df, [*[F.col(g) for g in group], *order], "_number")
    first = numbered.groupBy(*[F.col(g).alias(f"_{g}") for g in group]).agg(
        F.min("_number").alias("_first")
    )
    same_group = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]
    return (
        numbered.join(first, same_group)
        .withColumn(rank, (F.col("_number") - F.col("_first") + 1).cast("int"))
        .select(*df.columns, rank)
    )
