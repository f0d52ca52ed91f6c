"""Distribution summaries that never gather raw values in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUARTILES = (0.25, 0.5, 0.75)
WIDE_PERCENTILES = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def describe_counts(
    df: DataFrame,
    value: str,
    percentiles: Sequence[float] = QUARTILES,
    by: Sequence[str] = (),
) -> DataFrame:
    """count, mean, std, min, exact linear percentiles and max of a column of counts.

    ``value`` counts rows per key.  The values are first reduced to a histogram: counts
    that add up to at most N rows take at most sqrt(2 N) different values, so what the
    last aggregation holds stays small even for trillions of input rows.
    """
    v, f = F.col(value).cast("bigint"), F.col("_freq")
    histogram = (
        df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_freq"))
    )
    # Exact sums: squares of counts can pass the bigint range.
    wide = v.cast("decimal(20,0)")
    total = F.sum(f)
    mean = F.sum(wide * f).cast("double") / total
    squares = F.sum(wide * wide * f).cast("double")
    variance = (squares - total * mean * mean) / F.when(total > 1, total - 1)
    points = [float(p) for p in percentiles]
    described = histogram.groupBy(*by).agg(
        F.coalesce(total, F.lit(0)).alias("count"),
        mean.alias("mean"),
        F.sqrt(F.greatest(variance, F.when(variance.isNotNull(), F.lit(0.0)))).alias("std"),
        F.min(v).alias("min"),
        F.percentile(v, F.array(*[F.lit(p) for p in points]), f).alias("_p"),
        F.max(v).alias("max"),
    )
    return described.select(
        *by,
        "count",
        "mean",
        "std",
        "min",
        *[F.col("_p")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(points)],
        "max",
    )
