"""Typed, deduplicated tables out of raw extracts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.columns import epoch_millis_to_time, single_value
from basketry.sources.tables import union_parts


def clean_events(events: DataFrame) -> DataFrame:
    """Epoch milliseconds to times, narrow ids, full duplicates removed.

    A missing transactionid stays null.  Casting first makes the rows narrow before the
    one shuffle that removes duplicates.
    """
    return events.select(
        epoch_millis_to_time(F.col("timestamp")).alias("timestamp"),
        F.col("visitorid").cast("int"),
        "event",
        F.col("itemid").cast("int"),
        F.col("transactionid").cast("int"),
    ).distinct()


def clean_category_tree(tree: DataFrame) -> DataFrame:
    """Narrow ids; roots keep their null parent."""
    return tree.select(F.col("categoryid").cast("short"), F.col("parentid").cast("short"))


def clean_item_properties(
    parts: Sequence[DataFrame], constants: DataFrame | Iterable[str] = ()
) -> DataFrame:
    """Stack the extracts, type them and drop constant properties.

    ``constants`` is a list of property names or the output of
    ``detect_constant_properties``.  A null property name is kept, like any other name
    that is not listed.
    """
    stacked = union_parts(parts).select(
        epoch_millis_to_time(F.col("timestamp")).alias("timestamp"),
        F.col("itemid").cast("int"),
        "property",
        "value",
    )
    return drop_properties(stacked, constants)


def drop_properties(props: DataFrame, names: DataFrame | Iterable[str]) -> DataFrame:
    """Rows of all other properties; a row without a property name stays.

    Names given as a table are joined on the property: a short table is broadcast below
    Spark's own threshold, and of a long one no row goes through the driver.
    """
    if isinstance(names, DataFrame):
        dropped = names.where(F.col("property").isNotNull()).select("property").distinct()
        return props.join(dropped, "property", "left_anti").select(props.columns)
    names = list(names)
    if not names:
        return props
    return props.where(F.col("property").isNull() | ~F.col("property").isin(names))


def property_stats(props: DataFrame) -> DataFrame:
    """Per property: items having it, distinct values and share of all items in percent.

    Rows without a property name belong to no property.  Counting distinct values shuffles
    on (property, value) first, so a property holding a third of all rows is spread out.
    """
    total = single_value(props.agg(F.countDistinct("itemid").alias("items")), "items")
    return (
        props.where(F.col("property").isNotNull())
        .groupBy("property")
        .agg(
            F.countDistinct("itemid").alias("items_count"),
            F.countDistinct("value").alias("unique_values"),
        )
        .withColumn("total_items", total)
        .withColumn(
            "coverage_percent",
            F.try_divide(F.col("items_count").cast("double"), F.col("total_items")) * 100,
        )
    )


def detect_constant_properties(props: DataFrame) -> DataFrame:
    """Properties every item has and that take exactly one value.

    One aggregation on (property, item) gives both the items of a property and the items of
    all: a property has one value if its least is its greatest.
    """
    pairs = props.groupBy("property", "itemid").agg(
        F.min("value").alias("_least"), F.max("value").alias("_most")
    )
    total = single_value(pairs.agg(F.countDistinct("itemid").alias("items")), "items")
    return (
        pairs.where(F.col("property").isNotNull())
        .groupBy("property")
        .agg(
            F.count("itemid").alias("items_count"),
            F.min("_least").alias("_least"),
            F.max("_most").alias("_most"),
        )
        .where((F.col("items_count") == total) & (F.col("_least") == F.col("_most")))
        .select("property", "items_count", F.lit(1).cast("bigint").alias("unique_values"))
    )


def filter_impact(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows and items before, after and removed."""

    def counted(df: DataFrame, side: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias(f"rows_{side}"), F.countDistinct("itemid").alias(f"items_{side}")
        )

    kept = counted(after, "after").select(F.struct("*").alias("kept"))
    return (
        counted(before, "before")
        .withColumn("kept", single_value(kept, "kept"))
        .select(
            "rows_before",
            "kept.rows_after",
            (F.col("rows_before") - F.col("kept.rows_after")).alias("rows_removed"),
            "items_before",
            "kept.items_after",
            (F.col("items_before") - F.col("kept.items_after")).alias("items_removed"),
        )
    )


def normalize_interactions(events: DataFrame) -> DataFrame:
    """Canonical ``user_id``/``item_id`` names and a time column, whatever was given.

    Numeric timestamps are epoch milliseconds.  Input that is canonical already passes
    through unchanged.
    """
    renamed = events.withColumnsRenamed({"visitorid": "user_id", "itemid": "item_id"})
    if isinstance(renamed.schema["timestamp"].dataType, T.NumericType):
        renamed = renamed.withColumn("timestamp", epoch_millis_to_time(F.col("timestamp")))
    return renamed
