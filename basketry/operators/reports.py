"""Exploratory reports on properties, activity and category conversion.

Reports on categories count events per item before they meet the item's category, so
what is joined has one row per item and not one per event, however hot the item.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.config import CATEGORY_PROPERTY, EVENT_TYPES
from basketry.functions.columns import (
    between_times,
    percent,
    period_start,
    ratio,
    single_value,
)
from basketry.operators.cleaning import property_stats as _property_stats

Time = str | dt.datetime | None


def value_counts_topn(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent values and their rows; ties by value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), column)
        .limit(n)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """One row: number of different non-null values."""
    return df.agg(F.countDistinct(column).alias("distinct_values"))


def items_per_property(props: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` properties found on most items."""
    return (
        props.where(F.col("property").isNotNull())
        .groupBy("property")
        .agg(F.countDistinct("itemid").alias("items_count"))
        .orderBy(F.desc("items_count"), "property")
        .limit(n)
    )


def property_coverage(props: DataFrame, n: int = 20) -> DataFrame:
    """``items_per_property`` with the share of all items in percent."""
    total = single_value(props.agg(F.countDistinct("itemid").alias("items")), "items")
    return items_per_property(props, n).withColumn(
        "coverage_percent", percent(F.col("items_count"), total)
    )


def property_stats(props: DataFrame) -> DataFrame:
    """Items, distinct values and coverage of every property, widest coverage first."""
    return (
        _property_stats(props)
        .select("property", "items_count", "unique_values", "coverage_percent")
        .orderBy(F.desc("coverage_percent"), "property")
    )


def items_by_period(
    df: DataFrame, unit: str = "month", low: Time = None, high: Time = None
) -> DataFrame:
    """Distinct items per period inside ``[low, high)``."""
    return (
        between_times(df, "timestamp", low, high)
        .groupBy(period_start(F.col("timestamp"), unit).alias("period"))
        .agg(F.countDistinct("itemid").alias("items"))
    )


def activity_by_period(
    events: DataFrame, unit: str = "month", low: Time = None, high: Time = None
) -> DataFrame:
    """Interactions, users, items and interactions per user of every period."""
    return (
        between_times(events, "timestamp", low, high)
        .groupBy(period_start(F.col("timestamp"), unit).alias("period"))
        .agg(
            F.count(F.lit(1)).alias("interactions"),
            F.countDistinct("visitorid").alias("users"),
            F.countDistinct("itemid").alias("items"),
        )
        .withColumn("interactions_per_user", ratio(F.col("interactions"), F.col("users")))
    )


def _count_types(types: Sequence[str], weight: str | None = None):
    """One zero-filled count per event type: a pivot whose values are known."""
    n = F.lit(1) if weight is None else F.col(weight)
    return [
        F.sum(F.when(F.col("event") == t, n).otherwise(0)).cast("bigint").alias(t) for t in types
    ]


def events_by_type_period(
    events: DataFrame,
    unit: str = "month",
    low: Time = None,
    high: Time = None,
    types: Sequence[str] = EVENT_TYPES,
) -> DataFrame:
    """Events of each type per period, zero where there are none."""
    return (
        between_times(events, "timestamp", low, high)
        .groupBy(period_start(F.col("timestamp"), unit).alias("period"))
        .agg(*_count_types(types))
    )


def item_categories(props: DataFrame) -> DataFrame:
    """Category changes per item; values that are no number of two bytes are dropped."""
    number = F.trim(F.col("value")).try_cast("double")
    return (
        props.where(F.col("property") == CATEGORY_PROPERTY)
        .select("timestamp", "itemid", number.alias("_number"))
        .where(F.col("_number").between(-32768, 32767))
        .select("timestamp", "itemid", F.col("_number").cast("short").alias("categoryid"))
    )


def latest_category(categories: DataFrame) -> DataFrame:
    """Last category of every item; the larger id where two carry the same time.

    Repeated notices of one category collapse first, in a hash aggregation on the map side;
    what is compared as (time, category) afterwards is about one row per item.
    """
    changes = categories.groupBy("itemid", "categoryid").agg(F.max("timestamp").alias("_last"))
    newest = F.max(F.struct("_last", "categoryid"))
    return (
        changes.groupBy("itemid")
        .agg(newest.alias("_newest"))
        .select("itemid", F.col("_newest.categoryid").alias("categoryid"))
    )


def events_with_category(events: DataFrame, latest: DataFrame) -> DataFrame:
    """Events with the last known category of their item; null where there is none.

    ``latest`` has one row per item, so adaptive execution may split a hot item's events
    over many tasks and hand each of them that row.
    """
    return events.join(latest.select("itemid", "categoryid"), "itemid", "left").select(
        *events.columns, "categoryid"
    )


def _category_counts(counted: DataFrame, latest: DataFrame) -> DataFrame:
    """Counts per item with the item's category; items without one take no part."""
    known = latest.where(F.col("categoryid").isNotNull()).select("itemid", "categoryid")
    return counted.join(known, "itemid")


def top_categories(
    events: DataFrame, latest: DataFrame, event: str = "transaction", n: int = 20
) -> DataFrame:
    """The ``n`` categories with most events of one type."""
    per_item = (
        events.where(F.col("event") == event).groupBy("itemid").agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        _category_counts(per_item, latest)
        .groupBy("categoryid")
        .agg(F.sum("_n").alias("events"))
        .orderBy(F.desc("events"), "categoryid")
        .limit(n)
    )


def category_event_matrix(
    events: DataFrame, latest: DataFrame, types: Sequence[str] = EVENT_TYPES
) -> DataFrame:
    """Events of each type per category, zero-filled, with the total over all types."""
    per_item = events.groupBy("itemid").agg(
        *_count_types(types), F.count("event").alias("total")
    )
    return (
        _category_counts(per_item, latest)
        .groupBy("categoryid")
        .agg(*[F.sum(c).alias(c) for c in (*types, "total")])
        .orderBy(F.desc("transaction"), "categoryid")
    )


def category_trend(
    events: DataFrame,
    latest: DataFrame,
    n: int = 10,
    unit: str = "month",
    low: Time = None,
    high: Time = None,
    event: str = "transaction",
) -> DataFrame:
    """Events per period of the ``n`` categories that lead inside ``[low, high)``."""
    per_item = (
        between_times(events.where(F.col("event") == event), "timestamp", low, high)
        .groupBy("itemid", period_start(F.col("timestamp"), unit).alias("period"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    trend = (
        _category_counts(per_item, latest)
        .groupBy("period", "categoryid")
        .agg(F.sum("_n").alias("events"))
    )
    leading = (
        trend.groupBy("categoryid")
        .agg(F.sum("events").alias("_all"))
        .orderBy(F.desc("_all"), "categoryid")
        .limit(n)
    )
    return trend.join(leading, "categoryid", "left_semi").select("period", "categoryid", "events")


def _conversion(matrix: DataFrame, part: str, whole: str) -> DataFrame:
    return matrix.select(
        "categoryid",
        "view",
        "addtocart",
        "transaction",
        percent(F.col(part), F.col(whole)).alias("percent"),
    )


def _best(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_last("percent"), "categoryid").limit(n)


def category_conversion(matrix: DataFrame, min_views: int = 5000, n: int = 20) -> DataFrame:
    """Categories with most carts per view, among those seen often enough."""
    return _best(_conversion(matrix.where(F.col("view") >= min_views), "addtocart", "view"), n)


def mean_category_conversion(matrix: DataFrame, min_views: int = 5000) -> DataFrame:
    """One row: unweighted mean over categories of carts per view in percent."""
    rated = _conversion(matrix.where(F.col("view") >= min_views), "addtocart", "view")
    return rated.agg(
        F.count("percent").alias("categories"), F.avg("percent").alias("mean_percent")
    )


def _with_carts(matrix: DataFrame, min_views: int) -> DataFrame:
    return matrix.where((F.col("view") >= min_views) & (F.col("addtocart") > 0))


def _with_purchases(matrix: DataFrame, min_carts: int) -> DataFrame:
    return matrix.where((F.col("addtocart") >= min_carts) & (F.col("transaction") > 0))


def _pooled(matrix: DataFrame, part: str, whole: str) -> DataFrame:
    """One row: ratio of the sums, so that large categories weigh more."""
    return matrix.agg(
        F.sum(part).alias("part"),
        F.sum(whole).alias("whole"),
        percent(F.sum(part), F.sum(whole)).alias("pooled_percent"),
    )


def cart_from_view(matrix: DataFrame, min_views: int = 5000, n: int = 20) -> DataFrame:
    """Categories with most carts per view, among those with at least one cart."""
    return _best(_conversion(_with_carts(matrix, min_views), "addtocart", "view"), n)


def pooled_cart_from_view(matrix: DataFrame, min_views: int = 5000) -> DataFrame:
    return _pooled(_with_carts(matrix, min_views), "addtocart", "view")


def purchase_from_cart(matrix: DataFrame, min_carts: int = 200, n: int = 20) -> DataFrame:
    """Categories with most purchases per cart, among those with at least one purchase."""
    return _best(_conversion(_with_purchases(matrix, min_carts), "transaction", "addtocart"), n)


def pooled_purchase_from_cart(matrix: DataFrame, min_carts: int = 200) -> DataFrame:
    return _pooled(_with_purchases(matrix, min_carts), "transaction", "addtocart")
