"""Every operator as a query over the given tables, next to its SQL where it has one.

Doubles are rounded on both sides before they are compared.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry import schemas
from basketry.config import AlsConfig, RankerConfig
from basketry.operators import candidates as C
from basketry.operators import cleaning as I
from basketry.operators import evaluation as M
from basketry.operators import factorisation as A
from basketry.operators import generators as R
from basketry.operators import quality as Q
from basketry.operators import ranker as K
from basketry.operators import reports as E
from basketry.operators import serving as V
from basketry.operators import splits as S
from basketry.operators import weights as W
from basketry.plans.inputs import (
    ALS_N,
    CANDIDATES,
    ORDER_SPLIT,
    SIMILAR_N,
    Inputs,
)
from basketry.plans.oracle_views import with_views
from basketry.session import scratch_path
from basketry.sources import dictionary as D
from basketry.sources import tables as T


@dataclass(frozen=True)
class Query:
    item: str
    build: Callable[[Inputs], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Inputs(spark, folder))


REGISTERED: dict[str, Query] = {}


def query(item: str, sql: str | None = None):
    """Register a query under its function's name; ``item`` is its inventory id."""

    def add(build: Callable[[Inputs], DataFrame]):
        REGISTERED[build.__name__] = Query(item, build, with_views(sql) if sql else None)
        return build

    return add


def rounded(column: str, places: int = 6) -> Column:
    return F.round(F.col(column).cast("double"), places).alias(column)


def with_rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: rounded(c, places) for c in columns})


# Sources and cleaning ---------------------------------------------------------------------


@query(
    "I1",
    """SELECT timestamp, CAST(visitorid AS BIGINT) AS visitorid, event,
              CAST(itemid AS BIGINT) AS itemid, CAST(transactionid AS BIGINT) AS transactionid
       FROM raw_events""",
)
def csv_to_parquet(x: Inputs) -> DataFrame:
    csv, parquet = scratch_path(x.spark, "events-csv"), scratch_path(x.spark, "events")
    x.raw_events().write.option("header", True).csv(csv)
    return T.csv_to_parquet(x.spark, csv, parquet, schemas.RAW_EVENTS)


@query("I2", "SELECT timestamp, itemid, property, value FROM item_properties")
def union_parts(x: Inputs) -> DataFrame:
    return T.union_parts(x.property_parts())


@query(
    "I3",
    """SELECT DISTINCT make_timestamp_ms(timestamp) AS timestamp, CAST(visitorid AS INT) AS visitorid,
              event, CAST(itemid AS INT) AS itemid, CAST(transactionid AS INT) AS transactionid
       FROM raw_events""",
)
def clean_events(x: Inputs) -> DataFrame:
    return I.clean_events(x.raw_events())


@query("I4", "SELECT categoryid, parentid FROM category_tree")
def clean_category_tree(x: Inputs) -> DataFrame:
    return I.clean_category_tree(x.raw_category_tree())


@query("I5", "SELECT timestamp, itemid, property, value FROM item_properties WHERE property <> '159'")
def clean_item_properties(x: Inputs) -> DataFrame:
    constants = I.detect_constant_properties(x.item_properties())
    return I.clean_item_properties(x.raw_property_parts(), constants)


@query("I5", "SELECT timestamp, itemid, property, value FROM item_properties WHERE property <> '159'")
def clean_item_properties_listed(x: Inputs) -> DataFrame:
    return I.clean_item_properties(x.raw_property_parts(), ["159", "112", "764"])


@query(
    "I6",
    """SELECT property, count(DISTINCT itemid) AS items_count, count(DISTINCT value) AS unique_values
       FROM item_properties GROUP BY property
       HAVING count(DISTINCT itemid) = (SELECT count(DISTINCT itemid) FROM item_properties)
          AND count(DISTINCT value) = 1""",
)
def detect_constant_properties(x: Inputs) -> DataFrame:
    return I.detect_constant_properties(x.item_properties())


@query(
    "I7",
    """SELECT rows_before, rows_after, rows_before - rows_after AS rows_removed,
              items_before, items_after, items_before - items_after AS items_removed
       FROM (SELECT count(*) AS rows_before, count(DISTINCT itemid) AS items_before,
                    count(*) FILTER (property <> '159') AS rows_after,
                    count(DISTINCT itemid) FILTER (property <> '159') AS items_after
             FROM item_properties)""",
)
def filter_impact(x: Inputs) -> DataFrame:
    props = x.item_properties()
    return I.filter_impact(props, I.drop_properties(props, ["159"]))


@query("I8", "SELECT itemid, score FROM popular WHERE rank <= 10")
def read_dataset(x: Inputs) -> DataFrame:
    path = scratch_path(x.spark, "popular")
    x.build_popular().write.parquet(path)
    return T.read_dataset(
        x.spark, path, schemas.TOP_POPULAR, ["itemid", "score"], F.col("rank") <= 10
    )


@query("I9", "SELECT visitorid, event, itemid FROM shop_events")
def publish_dataset(x: Inputs) -> DataFrame:
    uri = scratch_path(x.spark, "published")
    events = x.shop_events().select("visitorid", "event", "itemid")
    T.publish_dataset(events.where("event = 'view'"), uri)
    T.publish_dataset(events, uri, drop_previous=True)
    return T.read_published(x.spark, uri)


@query(
    "I10",
    """SELECT 'shop_events' AS dataset, count(*) AS rows FROM shop_events
       UNION ALL SELECT 'item_properties', count(*) FROM item_properties
       UNION ALL SELECT 'category_tree', count(*) FROM category_tree""",
)
def validate_outputs(x: Inputs) -> DataFrame:
    return T.validate_outputs(
        {
            "shop_events": x.shop_events(),
            "item_properties": x.item_properties(),
            "category_tree": x.raw_category_tree(),
        }
    )


@query(
    "I11",
    """SELECT make_timestamp_ms(timestamp) AS timestamp, visitorid AS user_id, event,
              itemid AS item_id, transactionid FROM raw_events""",
)
def normalize_interactions(x: Inputs) -> DataFrame:
    return I.normalize_interactions(x.raw_events())


# Data quality -----------------------------------------------------------------------------


@query(
    "Q1",
    """SELECT 'raw_events' AS dataset, count(*) AS rows,
              count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_events)) AS duplicates,
              count(*) - count(transactionid) AS null_values, CAST(0 AS BIGINT) AS empty_strings
       FROM raw_events
       UNION ALL
       SELECT 'item_properties', count(*),
              count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM item_properties)), 0,
              count(*) FILTER (regexp_full_match(value, '\\s*'))
       FROM item_properties
       UNION ALL
       SELECT 'category_tree', count(*),
              count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM category_tree)),
              count(*) - count(parentid), 0
       FROM category_tree""",
)
def quality_summary(x: Inputs) -> DataFrame:
    return Q.quality_summary(
        {
            "raw_events": x.raw_events(),
            "item_properties": x.item_properties(),
            "category_tree": x.raw_category_tree(),
        }
    )


@query(
    "Q2",
    """SELECT 'raw_events' AS dataset, 'transactionid' AS "column",
              count(*) - count(transactionid) AS null_values, CAST(0 AS BIGINT) AS empty_strings
       FROM raw_events
       UNION ALL
       SELECT 'item_properties', 'value', 0, count(*) FILTER (regexp_full_match(value, '\\s*'))
       FROM item_properties
       UNION ALL
       SELECT 'category_tree', 'parentid', count(*) - count(parentid), 0 FROM category_tree""",
)
def quality_by_column(x: Inputs) -> DataFrame:
    return Q.quality_by_column(
        {
            "raw_events": x.raw_events(),
            "item_properties": x.item_properties(),
            "category_tree": x.raw_category_tree(),
        }
    )


@query(
    "Q3",
    """SELECT 'events' AS dataset, count(*) AS rows,
              count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_events)) AS duplicates,
              count(*) - count(transactionid) AS null_values, CAST(0 AS BIGINT) AS empty_strings
       FROM raw_events
       UNION ALL
       SELECT 'category_tree', count(*), 0, count(*) - count(parentid), 0 FROM category_tree""",
)
def csv_quality(x: Inputs) -> DataFrame:
    events, tree = scratch_path(x.spark, "events-csv"), scratch_path(x.spark, "tree-csv")
    x.raw_events().write.option("header", True).csv(events)
    x.raw_category_tree().write.option("header", True).csv(tree)
    return Q.csv_quality(
        x.spark,
        {
            "events": (events, schemas.RAW_EVENTS),
            "category_tree": (tree, schemas.RAW_CATEGORY_TREE),
        },
    )


@query(
    "Q4",
    """SELECT 'transactionid' AS "column", count(*) - count(transactionid) AS null_count,
              round(100.0 * (count(*) - count(transactionid)) / count(*), 2) AS null_percent
       FROM shop_events""",
)
def missing_by_column(x: Inputs) -> DataFrame:
    return Q.missing_by_column(x.shop_events())


@query(
    "Q5",
    """SELECT event, count(*) AS rows, count(*) - count(transactionid) AS null_count,
              count(transactionid) AS filled_count
       FROM order_events GROUP BY event""",
)
def missing_by_group(x: Inputs) -> DataFrame:
    return Q.missing_by_group(x.order_events(), "event", "transactionid")


@query(
    "Q6",
    """SELECT "column", dtype, CAST(low AS DOUBLE) AS "min", CAST(high AS DOUBLE) AS "max",
              CASE WHEN low >= -128 AND high <= 127 THEN 'tinyint'
                   WHEN low >= -32768 AND high <= 32767 THEN 'smallint'
                   WHEN low >= -2147483648 AND high <= 2147483647 THEN 'int'
                   ELSE 'bigint' END AS narrowest
       FROM (SELECT 'timestamp' AS "column", 'bigint' AS dtype, min(timestamp) AS low,
                    max(timestamp) AS high FROM raw_events
             UNION ALL SELECT 'visitorid', 'int', min(visitorid), max(visitorid) FROM raw_events
             UNION ALL SELECT 'itemid', 'int', min(itemid), max(itemid) FROM raw_events
             UNION ALL SELECT 'transactionid', 'int', min(transactionid), max(transactionid)
             FROM raw_events)""",
)
def numeric_profile(x: Inputs) -> DataFrame:
    return Q.numeric_profile(x.raw_events())


@query(
    "Q7",
    """SELECT count(*) AS rows, 5 AS columns, count(*) AS other_rows, 5 AS other_columns,
              true AS same_shape, true AS same_data
       FROM raw_events""",
)
def compare_datasets(x: Inputs) -> DataFrame:
    csv = scratch_path(x.spark, "events-csv")
    events = x.raw_events().withColumns(
        {c: F.col(c).cast("bigint") for c in ("visitorid", "itemid", "transactionid")}
    )
    events.write.option("header", True).csv(csv)
    parquet = T.csv_to_parquet(
        x.spark, csv, scratch_path(x.spark, "events"), schemas.RAW_EVENTS
    )
    return Q.compare_datasets(events, parquet)


@query(
    "Q7",
    """SELECT count(*) > 0 AS has_files, count(*) > 0 AS is_smaller FROM raw_events""",
)
def compare_storage(x: Inputs) -> DataFrame:
    csv, parquet = scratch_path(x.spark, "events-csv"), scratch_path(x.spark, "events")
    x.raw_events().write.option("header", True).csv(csv)
    T.csv_to_parquet(x.spark, csv, parquet, schemas.RAW_EVENTS)
    sizes = Q.compare_storage(T.dataset_bytes(x.spark, csv), T.dataset_bytes(x.spark, parquet))
    return sizes.select(
        (F.col("other_disk_mb") > 0).alias("has_files"), (F.col("compression") > 1).alias("is_smaller")
    )


@query(
    "Q7",
    """SELECT 'events' AS dataset, count(*) AS rows, 5 AS columns, true AS same_shape,
              true AS same_data, true AS has_sizes FROM raw_events
       UNION ALL
       SELECT 'categories', count(*), 2, true, true, true FROM category_tree""",
)
def comparison_report(x: Inputs) -> DataFrame:
    """CSV against Parquet for two datasets."""
    raw = {
        "events": (x.raw_events(), schemas.RAW_EVENTS),
        "categories": (x.raw_category_tree(), schemas.RAW_CATEGORY_TREE),
    }
    pairs = {}
    for name, (df, schema) in raw.items():
        csv, parquet = scratch_path(x.spark, f"{name}-csv"), scratch_path(x.spark, name)
        df.write.option("header", True).csv(csv)
        pairs[name] = (
            T.read_csv(x.spark, csv, schema),
            T.csv_to_parquet(x.spark, csv, parquet, schema),
            T.dataset_bytes(x.spark, csv),
            T.dataset_bytes(x.spark, parquet),
        )
    report = Q.comparison_report(pairs)
    sizes = F.least("disk_mb", "other_disk_mb", "compression")
    return report.select(
        "dataset", "rows", "columns", "same_shape", "same_data", (sizes >= 0).alias("has_sizes")
    )


@query(
    "Q7",
    """SELECT itemid, property, in_left, in_right FROM (
         SELECT itemid, property, count(*) FILTER (side = 1) AS in_left,
                count(*) FILTER (side = 2) AS in_right
         FROM (SELECT itemid, property, 1 AS side FROM item_properties
               UNION ALL
               SELECT itemid, property, 2 FROM item_properties WHERE itemid % 50 <> 7)
         GROUP BY itemid, property)
       WHERE in_left <> in_right""",
)
def differing_rows(x: Inputs) -> DataFrame:
    """Properties of items against the same table without some items."""
    pairs = x.item_properties().select("itemid", "property")
    return Q.differing_rows(pairs, pairs.where("itemid % 50 <> 7"))


@query(
    "Q8",
    """SELECT property, count(*) AS rows,
              count(*) FILTER (value IS NULL OR regexp_full_match(value, '\\s*')) AS missing_values,
              round(100.0 * count(*) FILTER (value IS NULL OR regexp_full_match(value, '\\s*'))
                    / count(*), 6) AS missing_percent
       FROM item_properties GROUP BY property
       HAVING count(*) FILTER (value IS NULL OR regexp_full_match(value, '\\s*')) > 0""",
)
def property_missing_share(x: Inputs) -> DataFrame:
    return with_rounded(Q.property_missing_share(x.item_properties()), "missing_percent")


@query(
    "Q9",
    """SELECT property, count(*) AS rows,
              count(*) FILTER (TRY_CAST(value AS DOUBLE) = 0) AS zero_values
       FROM item_properties GROUP BY property
       HAVING count(*) FILTER (TRY_CAST(value AS DOUBLE) = 0) > 0""",
)
def property_zero_values(x: Inputs) -> DataFrame:
    return Q.property_zero_values(x.item_properties())


@query(
    "Q10",
    """SELECT (SELECT count(DISTINCT itemid) FROM shop_events) AS event_items,
              (SELECT count(DISTINCT itemid) FROM item_properties) AS property_items,
              (SELECT count(DISTINCT itemid) FROM shop_events
               WHERE itemid NOT IN (SELECT itemid FROM item_properties)) AS items_without_properties""",
)
def items_without_properties(x: Inputs) -> DataFrame:
    return Q.items_without_properties(x.shop_events(), x.item_properties())


@query(
    "Q10",
    """SELECT DISTINCT itemid FROM shop_events
       WHERE itemid NOT IN (SELECT itemid FROM item_properties)""",
)
def list_items_without_properties(x: Inputs) -> DataFrame:
    return Q.list_items_without_properties(x.shop_events(), x.item_properties())


@query(
    "Q11",
    """SELECT count(DISTINCT itemid) FILTER (property IS NULL OR regexp_full_match(property, '\\s*'))
                AS items_with_blank_property,
              count(DISTINCT itemid) FILTER (value IS NULL OR regexp_full_match(value, '\\s*'))
                AS items_with_blank_value
       FROM item_properties""",
)
def items_with_blank_fields(x: Inputs) -> DataFrame:
    return Q.items_with_blank_fields(x.item_properties())


@query(
    "Q12",
    """SELECT count(*) AS "count", round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
              min(n) AS "min", round(quantile_cont(n, 0.25), 6) AS p25,
              round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.75), 6) AS p75,
              max(n) AS "max"
       FROM (SELECT itemid, count(DISTINCT value) AS n FROM item_properties
             WHERE property = 'categoryid' GROUP BY itemid)""",
)
def values_per_item(x: Inputs) -> DataFrame:
    described = Q.values_per_item(x.item_properties(), "categoryid")
    return with_rounded(described, "mean", "std", "p25", "p50", "p75")


@query("Q13", "SELECT min(timestamp) AS min_time, max(timestamp) AS max_time FROM item_properties")
def time_range(x: Inputs) -> DataFrame:
    return Q.time_range(x.item_properties())


@query(
    "Q13",
    """SELECT 'history' AS split, min(timestamp) AS min_time, max(timestamp) AS max_time
       FROM shop_history
       UNION ALL SELECT 'ranker', min(timestamp), max(timestamp) FROM shop_ranker
       UNION ALL SELECT 'evaluation', min(timestamp), max(timestamp) FROM shop_evaluation""",
)
def time_range_by_split(x: Inputs) -> DataFrame:
    return Q.time_range(_labelled_splits(x.splits()), by=["split"])


_CELLS = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS filled, count(*) AS total,
               count(*) FILTER ({c} = 0) AS zeros FROM candidates"""
    for c in schemas.CANDIDATES.fieldNames()
)


@query(
    "Q14",
    f"""SELECT "column", filled AS notna, total - filled AS isna, zeros AS zero,
               total - zeros AS non_zero, filled - zeros AS non_zero_filled,
               round(100.0 * (filled - zeros) / total, 2) AS non_zero_percent
        FROM ({_CELLS})""",
)
def column_value_profile(x: Inputs) -> DataFrame:
    return Q.column_value_profile(x.candidates())


# Reports ----------------------------------------------------------------------------------


@query(
    "E1",
    """SELECT itemid, count(*) AS rows FROM item_properties GROUP BY itemid
       ORDER BY rows DESC, itemid LIMIT 20""",
)
def value_counts_topn(x: Inputs) -> DataFrame:
    return E.value_counts_topn(x.item_properties(), "itemid", 20)


@query("E1", "SELECT count(DISTINCT property) AS distinct_values FROM item_properties")
def distinct_values(x: Inputs) -> DataFrame:
    return E.distinct_values(x.item_properties(), "property")


@query(
    "E2",
    """SELECT property, count(DISTINCT itemid) AS items_count FROM item_properties
       GROUP BY property ORDER BY items_count DESC, property LIMIT 20""",
)
def items_per_property(x: Inputs) -> DataFrame:
    return E.items_per_property(x.item_properties(), 20)


@query(
    "E3",
    """SELECT property, count(DISTINCT itemid) AS items_count,
              round(100.0 * count(DISTINCT itemid)
                    / (SELECT count(DISTINCT itemid) FROM item_properties), 6) AS coverage_percent
       FROM item_properties GROUP BY property ORDER BY items_count DESC, property LIMIT 20""",
)
def property_coverage(x: Inputs) -> DataFrame:
    return with_rounded(E.property_coverage(x.item_properties(), 20), "coverage_percent")


@query(
    "E4",
    """SELECT property, count(DISTINCT itemid) AS items_count, count(DISTINCT value) AS unique_values,
              round(100.0 * count(DISTINCT itemid)
                    / (SELECT count(DISTINCT itemid) FROM item_properties), 6) AS coverage_percent
       FROM item_properties GROUP BY property""",
)
def property_stats(x: Inputs) -> DataFrame:
    return with_rounded(E.property_stats(x.item_properties()), "coverage_percent")


_LOW, _HIGH = "1996-01-01", "1999-01-01"


@query(
    "E5",
    """SELECT CAST(date_trunc('month', timestamp) AS DATE) AS period,
              count(DISTINCT itemid) AS items
       FROM item_properties
       WHERE timestamp >= TIMESTAMP '1996-01-01' AND timestamp < TIMESTAMP '1999-01-01'
       GROUP BY 1""",
)
def items_by_period(x: Inputs) -> DataFrame:
    return E.items_by_period(x.item_properties(), "month", _LOW, _HIGH)


@query(
    "E6",
    """SELECT CAST(date_trunc('month', timestamp) AS DATE) AS period, count(*) AS interactions,
              count(DISTINCT visitorid) AS users, count(DISTINCT itemid) AS items,
              round(count(*) * 1.0 / count(DISTINCT visitorid), 6) AS interactions_per_user
       FROM order_events
       WHERE timestamp >= TIMESTAMP '1996-01-01' AND timestamp < TIMESTAMP '1999-01-01'
       GROUP BY 1""",
)
def activity_by_period(x: Inputs) -> DataFrame:
    return with_rounded(
        E.activity_by_period(x.order_events(), "month", _LOW, _HIGH), "interactions_per_user"
    )


@query(
    "E7",
    """SELECT CAST(date_trunc('month', timestamp) AS DATE) AS period,
              count(*) FILTER (event = 'view') AS "view",
              count(*) FILTER (event = 'addtocart') AS addtocart,
              count(*) FILTER (event = 'transaction') AS "transaction"
       FROM order_events
       WHERE timestamp >= TIMESTAMP '1996-01-01' AND timestamp < TIMESTAMP '1999-01-01'
       GROUP BY 1""",
)
def events_by_type_period(x: Inputs) -> DataFrame:
    return E.events_by_type_period(x.order_events(), "month", _LOW, _HIGH)


def _latest(x: Inputs) -> DataFrame:
    return E.latest_category(E.item_categories(x.item_properties()))


def _matrix(x: Inputs) -> DataFrame:
    return E.category_event_matrix(x.order_events(), _latest(x))


@query("E8", "SELECT timestamp, itemid, categoryid FROM item_categories")
def item_categories(x: Inputs) -> DataFrame:
    return E.item_categories(x.item_properties())


@query("E9", "SELECT itemid, categoryid FROM latest_category")
def latest_category(x: Inputs) -> DataFrame:
    return _latest(x)


@query(
    "E10",
    """SELECT timestamp, visitorid, event, itemid, transactionid, categoryid
       FROM events_with_category""",
)
def events_with_category(x: Inputs) -> DataFrame:
    return E.events_with_category(x.order_events(), _latest(x))


@query(
    "E11",
    """SELECT categoryid, count(*) AS events FROM events_with_category
       WHERE event = 'transaction' AND categoryid IS NOT NULL
       GROUP BY categoryid ORDER BY events DESC, categoryid LIMIT 20""",
)
def top_categories(x: Inputs) -> DataFrame:
    return E.top_categories(x.order_events(), _latest(x))


@query("E12", 'SELECT categoryid, "view", addtocart, "transaction", total FROM category_matrix')
def category_event_matrix(x: Inputs) -> DataFrame:
    return _matrix(x)


@query(
    "E13",
    """SELECT CAST(date_trunc('month', timestamp) AS DATE) AS period, categoryid,
              count(*) AS events
       FROM events_with_category
       WHERE event = 'transaction' AND timestamp >= TIMESTAMP '1996-01-01'
         AND timestamp < TIMESTAMP '1999-01-01'
         AND categoryid IN (
           SELECT categoryid FROM events_with_category
           WHERE event = 'transaction' AND categoryid IS NOT NULL
             AND timestamp >= TIMESTAMP '1996-01-01' AND timestamp < TIMESTAMP '1999-01-01'
           GROUP BY categoryid ORDER BY count(*) DESC, categoryid LIMIT 10)
       GROUP BY 1, 2""",
)
def category_trend(x: Inputs) -> DataFrame:
    return E.category_trend(x.order_events(), _latest(x), 10, "month", _LOW, _HIGH)


@query(
    "E14",
    """SELECT categoryid, "view", addtocart, "transaction",
              round(100.0 * addtocart / "view", 6) AS percent
       FROM category_matrix WHERE "view" >= 100
       ORDER BY addtocart / "view" DESC, categoryid LIMIT 20""",
)
def category_conversion(x: Inputs) -> DataFrame:
    return with_rounded(E.category_conversion(_matrix(x), 100, 20), "percent")


@query(
    "E14",
    """SELECT count(*) AS categories, round(avg(100.0 * addtocart / "view"), 6) AS mean_percent
       FROM category_matrix WHERE "view" >= 100""",
)
def mean_category_conversion(x: Inputs) -> DataFrame:
    return with_rounded(E.mean_category_conversion(_matrix(x), 100), "mean_percent")


@query(
    "E15",
    """SELECT categoryid, "view", addtocart, "transaction",
              round(100.0 * addtocart / "view", 6) AS percent
       FROM category_matrix WHERE "view" >= 100 AND addtocart > 0
       ORDER BY addtocart / "view" DESC, categoryid LIMIT 20""",
)
def cart_from_view(x: Inputs) -> DataFrame:
    return with_rounded(E.cart_from_view(_matrix(x), 100, 20), "percent")


@query(
    "E15",
    """SELECT CAST(sum(addtocart) AS BIGINT) AS part, CAST(sum("view") AS BIGINT) AS whole,
              round(100.0 * sum(addtocart) / sum("view"), 6) AS pooled_percent
       FROM category_matrix WHERE "view" >= 100 AND addtocart > 0""",
)
def pooled_cart_from_view(x: Inputs) -> DataFrame:
    return with_rounded(E.pooled_cart_from_view(_matrix(x), 100), "pooled_percent")


@query(
    "E16",
    """SELECT categoryid, "view", addtocart, "transaction",
              round(100.0 * "transaction" / addtocart, 6) AS percent
       FROM category_matrix WHERE addtocart >= 50 AND "transaction" > 0
       ORDER BY "transaction" / addtocart DESC, categoryid LIMIT 20""",
)
def purchase_from_cart(x: Inputs) -> DataFrame:
    return with_rounded(E.purchase_from_cart(_matrix(x), 50, 20), "percent")


@query(
    "E16",
    """SELECT CAST(sum("transaction") AS BIGINT) AS part, CAST(sum(addtocart) AS BIGINT) AS whole,
              round(100.0 * sum("transaction") / sum(addtocart), 6) AS pooled_percent
       FROM category_matrix WHERE addtocart >= 50 AND "transaction" > 0""",
)
def pooled_purchase_from_cart(x: Inputs) -> DataFrame:
    return with_rounded(E.pooled_purchase_from_cart(_matrix(x), 50), "pooled_percent")


# Splits and weights -----------------------------------------------------------------------


def _labelled_splits(splits: S.Splits) -> DataFrame:
    return T.union_parts(
        [df.withColumn("split", F.lit(name)) for name, df in splits._asdict().items()]
    )


@query("S1", "SELECT ranker_start, evaluation_start, data_end FROM shop_bounds")
def time_boundaries(x: Inputs) -> DataFrame:
    return x.bounds()


@query("S1", "SELECT ranker_start, evaluation_start, data_end FROM order_bounds")
def time_boundaries_orders(x: Inputs) -> DataFrame:
    return S.time_boundaries(x.order_events(), ORDER_SPLIT)


@query(
    "S2",
    """SELECT *, 'history' AS split FROM shop_history
       UNION ALL SELECT *, 'ranker' FROM shop_ranker
       UNION ALL SELECT *, 'evaluation' FROM shop_evaluation""",
)
def temporal_split(x: Inputs) -> DataFrame:
    return _labelled_splits(x.splits())


@query(
    "S2",
    """SELECT *, 'history' AS split FROM order_history
       UNION ALL SELECT *, 'ranker' FROM order_ranker
       UNION ALL SELECT *, 'evaluation' FROM order_evaluation""",
)
def temporal_split_orders(x: Inputs) -> DataFrame:
    return _labelled_splits(x.order_splits())


@query("S3", "SELECT user_id, item_id FROM positives")
def positive_pairs(x: Inputs) -> DataFrame:
    return x.positives()


@query(
    "S3",
    """SELECT DISTINCT user_id, item_id FROM order_ranker
       WHERE event IN ('addtocart', 'transaction')""",
)
def positive_pairs_orders(x: Inputs) -> DataFrame:
    return S.positive_pairs(x.order_splits().ranker)


@query(
    "S4",
    """SELECT timestamp, user_id, event, item_id, transactionid FROM order_evaluation
       WHERE user_id IN (SELECT user_id FROM order_history)
         AND item_id IN (SELECT item_id FROM order_history)""",
)
def known_only(x: Inputs) -> DataFrame:
    splits = x.order_splits()
    return S.known_only(splits.evaluation, splits.history)


@query(
    "S5",
    """SELECT visitorid, dense_rank() OVER (ORDER BY visitorid) - 1 AS index
       FROM (SELECT DISTINCT visitorid FROM order_events)""",
)
def encode_ids(x: Inputs) -> DataFrame:
    return S.encode_ids(x.order_events(), "visitorid")


@query(
    "S5",
    """SELECT visitorid, row_number() OVER (ORDER BY arrived, visitorid) - 1 AS index
       FROM (SELECT visitorid, min(year(timestamp)) AS arrived FROM order_events GROUP BY 1)""",
)
def append_ids(x: Inputs) -> DataFrame:
    """Numbers after the events of one year after the other were appended."""
    events = x.order_events().withColumn("arrived", F.year("timestamp"))
    uri = scratch_path(x.spark, "ids")
    found = D.append_ids(events.limit(0), "visitorid", uri)
    # One row a year.
    for row in events.select("arrived").distinct().orderBy("arrived").collect():
        found = D.append_ids(events.where(F.col("arrived") == row["arrived"]), "visitorid", uri)
    return found


@query("S5", "SELECT timestamp, visitorid, event, itemid, transactionid FROM shop_events")
def decode_ids(x: Inputs) -> DataFrame:
    events = x.shop_events()
    encoding = S.encode_ids(events, "visitorid")
    encoded = S.apply_encoding(events, encoding, "visitorid")
    return S.decode_ids(encoded, encoding, "visitorid")


@query(
    "S6",
    """SELECT users_with_both, users_with_source, round(probability, 6) AS probability
       FROM conversion""",
)
def conversion_probability(x: Inputs) -> DataFrame:
    return with_rounded(W.conversion_probability(x.splits().history), "probability")


def _weights(x: Inputs) -> DataFrame:
    return W.event_weights(W.conversion_probability(x.splits().history))


def _interactions(x: Inputs) -> DataFrame:
    return W.weighted_interactions(x.splits().history, _weights(x))


@query("S7", "SELECT event, round(weight, 6) AS weight FROM weights")
def event_weights(x: Inputs) -> DataFrame:
    return with_rounded(_weights(x), "weight")


@query("S8", "SELECT user_id, item_id, round(weight, 6) AS weight FROM interactions")
def weighted_interactions(x: Inputs) -> DataFrame:
    return with_rounded(_interactions(x), "weight")


@query(
    "S9",
    """SELECT count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items,
              count(*) AS pairs,
              round((SELECT probability FROM conversion), 6) AS p_cart_given_view
       FROM interactions""",
)
def interaction_stats(x: Inputs) -> DataFrame:
    probability = W.conversion_probability(x.splits().history)
    return with_rounded(W.interaction_stats(_interactions(x), probability), "p_cart_given_view")


# Candidate generators ---------------------------------------------------------------------


@query("R1", "SELECT itemid, score, rank FROM popular")
def top_popular(x: Inputs) -> DataFrame:
    return x.build_popular()


@query(
    "R1",
    """SELECT item_id AS itemid, score,
              CAST(row_number() OVER (ORDER BY score DESC, item_id) AS INT) AS rank
       FROM (SELECT item_id, count(DISTINCT user_id) AS score FROM order_history
             WHERE event IN ('addtocart', 'transaction') GROUP BY item_id
             ORDER BY score DESC, item_id LIMIT 100)""",
)
def top_popular_orders(x: Inputs) -> DataFrame:
    return R.top_popular(x.order_splits().history)


def _als_model(x: Inputs):
    return R.train_als(_interactions(x))


@query("R2", "SELECT count(*) AS pairs, count(*) > 0 AS better_than_zeros FROM interactions")
def train_als(x: Inputs) -> DataFrame:
    """Pairs, and whether the loss is below that of factors that are all zero."""
    weighted = _interactions(x)
    zeros = weighted.agg(F.sum(1 + F.col("weight") * AlsConfig().alpha).alias("loss")).scalar()
    loss = R.als_training_loss(_als_model(x), weighted)
    return loss.select("pairs", (F.col("squared_error") < zeros).alias("better_than_zeros"))


@query(
    "R2",
    f"""SELECT count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items,
               CAST({AlsConfig().iterations} AS BIGINT) AS iterations,
               CAST(0 AS BIGINT) AS rises, true AS loss_of_factors
        FROM interactions WHERE weight > 0""",
)
def factorise(x: Inputs) -> DataFrame:
    """Vectors, iterations, those after which the loss is higher than before, and whether the
    last loss is that of the factors."""
    weighted = x.stage("interactions", lambda: _interactions(x))
    found = A.factorise(weighted)
    total = F.col("squared_error") + F.col("penalty")
    before = F.lag(total).over(Window.orderBy("step"))
    own = R.als_training_loss(found, weighted).first()["squared_error"]
    return (
        found.loss.withColumn("rise", total > before * (1 + 1e-9))
        .agg(
            F.count(F.lit(1)).alias("iterations"),
            F.count_if("rise").alias("rises"),
            F.max_by("squared_error", "step").alias("last"),
        )
        .select(
            found.userFactors.agg(F.count(F.lit(1))).scalar().alias("users"),
            found.itemFactors.agg(F.count(F.lit(1))).scalar().alias("items"),
            "iterations",
            "rises",
            (F.abs(F.col("last") / own - 1) < 1e-4).alias("loss_of_factors"),
        )
    )


def _list_shape(lists: DataFrame, owner: str, item: str) -> DataFrame:
    """Per list: rows, distinct items, ranks left out, and scores above the one before."""
    before = F.lag("score").over(Window.partitionBy(owner).orderBy("rank"))
    rows = F.count(F.lit(1))
    return (
        lists.withColumn("_rises", F.coalesce((F.col("score") > before).cast("int"), F.lit(0)))
        .groupBy(owner)
        .agg(
            rows.alias("rows"),
            F.countDistinct(item).alias("items"),
            (F.max("rank") - rows).alias("gaps"),
            F.sum("_rises").alias("inversions"),
        )
    )


def _shape_sql(owner: str, name: str, source: str, n: str) -> str:
    zero = "CAST(0 AS BIGINT)"
    return f"""SELECT DISTINCT {owner} AS {name}, {n} AS rows, {n} AS items,
                      {zero} AS gaps, {zero} AS inversions
               FROM {source},
                    (SELECT count(DISTINCT item_id) AS catalog FROM interactions)"""


@query("R3", _shape_sql("user_id", "visitorid", "interactions", "least(20, catalog)"))
def personal_als(x: Inputs) -> DataFrame:
    return _list_shape(R.personal_als(_als_model(x), ALS_N), "visitorid", "itemid")


@query(
    "R4",
    _shape_sql("user_id", "visitorid", "interactions", "least(10, catalog)")
    + " WHERE user_id IN (SELECT user_id FROM positives)",
)
def recommend_for_users(x: Inputs) -> DataFrame:
    lists = R.recommend_for_users(_als_model(x), x.positives(), 10)
    return _list_shape(lists, "visitorid", "itemid")


def _fixed_lists(lists: DataFrame) -> DataFrame:
    return with_rounded(lists, "score").withColumn("rank", F.col("rank").cast("int"))


_FIXED_SQL = "SELECT visitorid, itemid, round(CAST(score AS DOUBLE), 6) AS score, rank FROM best_products"


@query("R3", _FIXED_SQL)
def personal_fixed(x: Inputs) -> DataFrame:
    """Lists by inner products of given vectors, as users and as items."""
    return _fixed_lists(R.best_products(x.embeddings(), x.embeddings(), 10))


@query("R4", _FIXED_SQL + " WHERE visitorid IN (SELECT user_id FROM positives)")
def recommend_fixed(x: Inputs) -> DataFrame:
    keys = x.positives().select(F.col("user_id").alias("id")).distinct()
    wanted = x.embeddings().join(keys, "id", "left_semi")
    return _fixed_lists(R.best_products(wanted, x.embeddings(), 10))


@query(
    "R5",
    """SELECT itemid, similar_itemid, round(CAST(score AS DOUBLE), 6) AS score, rank
       FROM neighbours""",
)
def similar_items(x: Inputs) -> DataFrame:
    similar = R.similar_items(x.embeddings(), SIMILAR_N)
    return with_rounded(similar, "score").withColumn("rank", F.col("rank").cast("int"))


@query("R5", _shape_sql("item_id", "itemid", "interactions", "least(10, catalog - 1)"))
def similar_items_als(x: Inputs) -> DataFrame:
    lists = R.similar_items(_als_model(x).itemFactors, SIMILAR_N)
    return _list_shape(lists, "itemid", "similar_itemid")


@query(
    "R6",
    """SELECT itemid, similar_itemid, round(CAST(score AS DOUBLE), 6) AS score, rank FROM neighbours
       WHERE itemid IN (SELECT itemid FROM popular)""",
)
def similar_for_items(x: Inputs) -> DataFrame:
    wanted = x.popular().select(F.col("itemid").alias("id"))
    similar = R.similar_for_items(x.embeddings(), wanted, SIMILAR_N)
    return with_rounded(similar, "score").withColumn("rank", F.col("rank").cast("int"))


# Candidates -------------------------------------------------------------------------------


@query("C1", "SELECT DISTINCT visitorid AS user_id, itemid AS item_id FROM personal")
def als_candidates(x: Inputs) -> DataFrame:
    return C.als_candidates(x.personal())


def _history(x: Inputs) -> DataFrame:
    return C.user_history(x.shop_events(), x.bounds(), CANDIDATES.history_items)


def _similar_features(x: Inputs) -> DataFrame:
    return C.similar_features(_history(x), x.similar(), CANDIDATES.similar_top_n)


def _popular_candidates(x: Inputs) -> DataFrame:
    return C.popular_candidates(_history(x), x.popular(), CANDIDATES.popular_top_n)


def _pairs(x: Inputs) -> DataFrame:
    return C.union_candidates(
        C.als_candidates(x.personal()), _similar_features(x), _popular_candidates(x)
    )


@query("C2", "SELECT user_id, source_item_id FROM history")
def user_history(x: Inputs) -> DataFrame:
    return _history(x)


@query(
    "C2",
    """SELECT user_id, item_id AS source_item_id FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id
                                      ORDER BY last_time DESC, item_id) AS place
         FROM (SELECT user_id, item_id, max(timestamp) AS last_time FROM order_history
               GROUP BY user_id, item_id)) WHERE place <= 10""",
)
def user_history_orders(x: Inputs) -> DataFrame:
    return C.user_history(x.order_events(), x.order_bounds())


@query(
    "C3",
    """SELECT user_id, item_id, round(CAST(similarity_score AS DOUBLE), 6) AS similarity_score, similarity_rank,
              similarity_sources FROM similar_features""",
)
def similar_features(x: Inputs) -> DataFrame:
    return _as_ints(
        with_rounded(_similar_features(x), "similarity_score"),
        "similarity_rank",
        "similarity_sources",
    )


def _as_ints(df: DataFrame, *columns: str) -> DataFrame:
    """Narrow integers widened for the comparison with SQL."""
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


@query("C4", "SELECT user_id, item_id FROM popular_pairs")
def popular_candidates(x: Inputs) -> DataFrame:
    return _popular_candidates(x)


@query("C5", "SELECT user_id, item_id FROM pairs")
def union_candidates(x: Inputs) -> DataFrame:
    return _pairs(x)


@query("C6", "SELECT user_id, item_id, popular_score, popular_rank FROM candidates")
def add_popular_features(x: Inputs) -> DataFrame:
    featured = C.add_popular_features(_pairs(x), x.popular())
    return _as_ints(with_rounded(featured, "popular_score"), "popular_rank")


@query(
    "C7",
    """SELECT user_id, item_id, round(CAST(similarity_score AS DOUBLE), 6) AS similarity_score, similarity_rank,
              similarity_sources FROM candidates""",
)
def add_similar_features(x: Inputs) -> DataFrame:
    featured = C.add_similar_features(_pairs(x), _similar_features(x))
    return _as_ints(
        with_rounded(featured, "similarity_score"), "similarity_rank", "similarity_sources"
    )


@query("C8", "SELECT user_id, item_id, als_score, als_rank FROM candidates")
def add_als_features(x: Inputs) -> DataFrame:
    featured = C.add_als_features(_pairs(x), x.personal())
    return _as_ints(with_rounded(featured, "als_score"), "als_rank")


_CANDIDATE_SQL = """
    SELECT user_id, item_id, als_score, als_rank, popular_score, popular_rank,
           round(CAST(similarity_score AS DOUBLE), 6) AS similarity_score, similarity_rank, similarity_sources,
           from_als, from_popular, from_similar,
           round(popular_score_log, 4) AS popular_score_log
    FROM candidates"""


def _comparable(candidates: DataFrame) -> DataFrame:
    smooth = with_rounded(candidates, "als_score", "popular_score", "similarity_score")
    smooth = with_rounded(smooth, "popular_score_log", places=4)
    return _as_ints(
        smooth,
        "als_rank",
        "popular_rank",
        "similarity_rank",
        "similarity_sources",
        "from_als",
        "from_popular",
        "from_similar",
    )


@query("C9", _CANDIDATE_SQL)
def finalize_candidates(x: Inputs) -> DataFrame:
    featured = C.add_popular_features(_pairs(x), x.popular())
    featured = C.add_similar_features(featured, _similar_features(x))
    featured = C.add_als_features(featured, x.personal())
    return _comparable(C.finalize_candidates(featured))


@query(
    "C10",
    """SELECT count(*) AS candidates_count, round(avg(from_als), 6) AS from_als_share,
              round(avg(from_popular), 6) AS from_popular_share,
              round(avg(from_similar), 6) AS from_similar_share,
              round(count(als_score) * 1.0 / count(*), 6) AS als_score_notna_share,
              round(count(popular_score) * 1.0 / count(*), 6) AS popular_score_notna_share,
              round(count(similarity_score) * 1.0 / count(*), 6) AS similarity_score_notna_share,
              count(*) FILTER (popular_score > 0) AS popular_count,
              round(count(*) FILTER (popular_score > 0) * 1.0 / count(*), 6) AS popular_share
       FROM candidates""",
)
def candidate_stats(x: Inputs) -> DataFrame:
    stats = C.candidate_stats(x.candidates())
    return with_rounded(stats, *[c for c in stats.columns if c.endswith("_share")])


@query("C11", _CANDIDATE_SQL)
def build_candidates(x: Inputs) -> DataFrame:
    return _comparable(x.build_candidates())


# Ranker -----------------------------------------------------------------------------------


@query(
    "K1",
    """SELECT count(*) AS positives, count(c.item_id) AS found,
              round(count(c.item_id) * 1.0 / count(*), 6) AS coverage
       FROM positives p LEFT JOIN candidates c USING (user_id, item_id)""",
)
def candidate_coverage(x: Inputs) -> DataFrame:
    return with_rounded(K.candidate_coverage(x.positives(), x.candidates()), "coverage")


@query(
    "K2",
    """SELECT 'user' AS entity, count(*) AS positives, count(c.user_id) AS found,
              round(count(c.user_id) * 1.0 / count(*), 6) AS coverage
       FROM (SELECT DISTINCT user_id FROM positives) p
       LEFT JOIN (SELECT DISTINCT user_id FROM candidates) c USING (user_id)
       UNION ALL
       SELECT 'item', count(*), count(c.item_id), round(count(c.item_id) * 1.0 / count(*), 6)
       FROM (SELECT DISTINCT item_id FROM positives) p
       LEFT JOIN (SELECT DISTINCT item_id FROM candidates) c USING (item_id)""",
)
def entity_coverage(x: Inputs) -> DataFrame:
    return with_rounded(K.entity_coverage(x.positives(), x.candidates()), "coverage")


@query(
    "K3",
    """SELECT count(*) AS found, CAST(sum(from_als) AS BIGINT) AS from_als,
              CAST(sum(from_popular) AS BIGINT) AS from_popular,
              CAST(sum(from_similar) AS BIGINT) AS from_similar
       FROM candidates JOIN positives USING (user_id, item_id)""",
)
def positives_by_source(x: Inputs) -> DataFrame:
    return K.positives_by_source(x.positives(), x.candidates())


@query(
    "K3",
    """SELECT from_als, from_popular, from_similar, count(*) AS pairs
       FROM candidates JOIN positives USING (user_id, item_id) GROUP BY ALL""",
)
def positives_by_combination(x: Inputs) -> DataFrame:
    combos = K.positives_by_combination(x.positives(), x.candidates())
    return _as_ints(combos, "from_als", "from_popular", "from_similar")


_DESCRIBE = """count(*) AS "count", round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
    CAST(min(n) AS BIGINT) AS "min", round(quantile_cont(n, 0.25), 6) AS p25,
    round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.75), 6) AS p75,
    round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.95), 6) AS p95,
    round(quantile_cont(n, 0.99), 6) AS p99, CAST(max(n) AS BIGINT) AS "max\""""
_DESCRIBED = ("mean", "std", "p25", "p50", "p75", "p90", "p95", "p99")


@query(
    "K4",
    f"""SELECT {_DESCRIBE}
        FROM (SELECT user_id, count(*) AS n FROM candidates
              WHERE user_id IN (SELECT user_id FROM positives) GROUP BY user_id)""",
)
def candidates_per_user(x: Inputs) -> DataFrame:
    return with_rounded(K.candidates_per_user(x.candidates(), x.positives()), *_DESCRIBED)


@query(
    "K5",
    f"""SELECT metric, {_DESCRIBE}
        FROM (SELECT user_id, 'total_candidates' AS metric, count(*) AS n FROM candidates
              WHERE user_id IN (SELECT user_id FROM positives) GROUP BY user_id
              UNION ALL SELECT user_id, 'als_candidates', CAST(sum(from_als) AS BIGINT)
              FROM candidates
              WHERE user_id IN (SELECT user_id FROM positives) GROUP BY user_id
              UNION ALL SELECT user_id, 'popular_candidates', CAST(sum(from_popular) AS BIGINT)
              FROM candidates
              WHERE user_id IN (SELECT user_id FROM positives) GROUP BY user_id
              UNION ALL SELECT user_id, 'similar_candidates', CAST(sum(from_similar) AS BIGINT)
              FROM candidates
              WHERE user_id IN (SELECT user_id FROM positives) GROUP BY user_id)
        GROUP BY metric""",
)
def source_counts_per_user(x: Inputs) -> DataFrame:
    return with_rounded(K.source_counts_per_user(x.candidates(), x.positives()), *_DESCRIBED)


@query(
    "K6",
    """SELECT count(*) AS candidates, count(p.itemid) AS real_from_als,
              CAST(sum(from_als) AS BIGINT) AS from_als,
              count(*) FILTER ((p.itemid IS NOT NULL) <> (from_als = 1)) AS mismatches
       FROM candidates c
       LEFT JOIN personal p ON p.visitorid = c.user_id AND p.itemid = c.item_id
       WHERE c.user_id IN (SELECT user_id FROM positives)""",
)
def audit_als_flag(x: Inputs) -> DataFrame:
    return K.audit_als_flag(x.candidates(), x.personal(), x.positives())


_TRAIN_COLUMNS = (
    "user_id",
    "item_id",
    "als_score",
    "als_rank",
    "popular_score",
    "popular_rank",
    "similarity_score",
    "similarity_rank",
    "target",
)
_TRAIN_SQL = """
    SELECT user_id, item_id, als_score, als_rank, popular_score, popular_rank,
           round(CAST(similarity_score AS DOUBLE), 6) AS similarity_score, similarity_rank, target FROM """


def _train_rows(df: DataFrame) -> DataFrame:
    smooth = with_rounded(
        df.select(*_TRAIN_COLUMNS), "als_score", "popular_score", "similarity_score"
    )
    return _as_ints(smooth, "als_rank", "popular_rank", "similarity_rank", "target")


def _labelled(x: Inputs) -> DataFrame:
    return K.label_candidates(x.candidates(), x.positives())


def _train(x: Inputs) -> DataFrame:
    return K.valid_groups(_labelled(x))


def _training_rows(x: Inputs) -> DataFrame:
    """The same rows, written once: fitting bins, merging and scoring each read them."""
    return x.stage("training", lambda: _train(x))


@query("K7", _TRAIN_SQL + "labelled")
def label_candidates(x: Inputs) -> DataFrame:
    return _train_rows(_labelled(x))


@query("K8", _TRAIN_SQL + "valid")
def valid_groups(x: Inputs) -> DataFrame:
    return _train_rows(_train(x))


@query("K9", _TRAIN_SQL + "valid ORDER BY user_id, als_rank ASC NULLS LAST, item_id")
def order_groups(x: Inputs) -> DataFrame:
    return _train_rows(K.order_groups(_train(x)))


@query(
    "K10",
    """SELECT count(*) AS rows, count(DISTINCT user_id) AS users,
              count(*) FILTER (target = 1) AS positives,
              round(count(*) FILTER (target = 1) * 1.0 / count(*), 6) AS positive_share
       FROM valid""",
)
def ranker_train_stats(x: Inputs) -> DataFrame:
    return with_rounded(K.ranker_train_stats(_train(x)), "positive_share")


def _ranker(x: Inputs):
    """The ranker of these tables: trained once, saved next to the stage tables."""

    path = _RANKERS.get((x.spark.sparkContext.applicationId, x.folder))
    if path is None:
        path = K.save_ranker(K.train_ranker(_training_rows(x)), scratch_path(x.spark, "ranker"))
        _RANKERS[(x.spark.sparkContext.applicationId, x.folder)] = path
    return K.load_ranker(path)


_RANKERS: dict[tuple[str, str], str] = {}


@query(
    "K11",
    """SELECT count(*) AS rows, CAST(0 AS BIGINT) AS null_scores, count(*) > 0 AS positives_above
       FROM valid""",
)
def train_ranker(x: Inputs) -> DataFrame:
    """Scores of the training rows; positives score above negatives on average."""
    train = _training_rows(x)
    scored = K.score_candidates(K.train_ranker(train), train)
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("score").isNull()).alias("null_scores"),
        (
            F.avg(F.when(F.col("target") == 1, F.col("score")))
            > F.avg(F.when(F.col("target") == 0, F.col("score")))
        ).alias("positives_above"),
    )


@query(
    "K11",
    """SELECT count(*) AS rows, CAST(0 AS BIGINT) AS null_scores, count(*) > 0 AS positives_above
       FROM valid""",
)
def train_ranker_grouped(x: Inputs) -> DataFrame:
    """As ``train_ranker``, with the loss on the order within each user: positives score above
    the mean of their own user's candidates."""
    config = RankerConfig(loss="grouped")
    train = _training_rows(x)
    scored = K.score_candidates(K.train_ranker(train, config), train)
    own = F.avg("score").over(Window.partitionBy("user_id"))
    return scored.withColumn("above", F.col("score") - own).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("score").isNull()).alias("null_scores"),
        (F.avg(F.when(F.col("target") == 1, F.col("above"))) > 0).alias("positives_above"),
    )


@query(
    "K12",
    """SELECT user_id, count(*) AS rows, CAST(0 AS BIGINT) AS null_scores FROM candidates
       GROUP BY user_id""",
)
def score_candidates(x: Inputs) -> DataFrame:
    scored = K.score_candidates(_ranker(x), x.candidates())
    return scored.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("score").isNull()).alias("null_scores")
    )


@query("K13", "SELECT user_id, item_id, score, rank FROM recommendations")
def rank_recommendations(x: Inputs) -> DataFrame:
    return K.rank_recommendations(x.scored())


@query("K13", "SELECT user_id, item_id, score, rank FROM recommendations")
def rank_recommendations_large_users(x: Inputs) -> DataFrame:
    return K.rank_recommendations(x.scored(), large_users=True)


@query("K14", "SELECT user_id, item_id, als_rank, popular_rank, similarity_rank FROM candidates")
def require_features(x: Inputs) -> DataFrame:
    ranks = ("als_rank", "popular_rank", "similarity_rank")
    return _as_ints(K.require_features(x.candidates()).select("user_id", "item_id", *ranks), *ranks)


@query("K15", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS different FROM valid")
def save_and_load_ranker(x: Inputs) -> DataFrame:
    """Rows, and those that a ranker in memory scores otherwise once saved and loaded."""
    train = _training_rows(x)
    ranker = K.train_ranker(train, RankerConfig(iterations=5))
    loaded = K.load_ranker(K.save_ranker(ranker, scratch_path(x.spark, "ranker")))
    # The second ranker scores the rows of the first, so no two tables of scores are joined.
    before = K.score_candidates(ranker, train).withColumnRenamed("score", "before")
    return K.score_candidates(loaded, before).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("score").eqNullSafe(F.col("before"))).alias("different"),
    )


# Serving ----------------------------------------------------------------------------------


@query(
    "V1",
    """SELECT user_id, item_id, score, rank FROM (
         SELECT user_id, item_id, score,
                CAST(row_number() OVER (PARTITION BY user_id
                                        ORDER BY score DESC, item_id) AS INT) AS rank
         FROM scored s
         WHERE NOT EXISTS (SELECT 1 FROM shop_canonical e
                           WHERE e.user_id = s.user_id AND e.item_id = s.item_id
                             AND e.event = 'transaction')) WHERE rank <= 10""",
)
def serve_batch(x: Inputs) -> DataFrame:
    return V.serve_batch(x.scored(), x.shop_events())


@query(
    "V1",
    """SELECT user_id, least(5, count(*)) AS rows, CAST(0 AS BIGINT) AS bought
       FROM candidates c
       WHERE user_id IN (SELECT user_id FROM positives)
         AND NOT EXISTS (SELECT 1 FROM shop_canonical e
                         WHERE e.user_id = c.user_id AND e.item_id = c.item_id
                           AND e.event = 'transaction')
       GROUP BY user_id""",
)
def serve_batch_model(x: Inputs) -> DataFrame:
    """Per user: rows served with the learned ranker, and bought items among them."""
    served = V.serve_batch(x.candidates(), x.shop_events(), _ranker(x), x.positives(), 5)
    bought = (
        x.shop_events()
        .where("event = 'transaction'")
        .select(F.col("visitorid").alias("user_id"), F.col("itemid").alias("item_id"))
        .distinct()
        .withColumn("_bought", F.lit(1))
    )
    return (
        served.join(bought, ["user_id", "item_id"], "left")
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.count("_bought").alias("bought"))
    )


@query(
    "V2",
    """SELECT le, count(score) FILTER (score / 1000.0 <= bound) AS "count"
       FROM recommendations,
            (VALUES ('-2.0', -2.0), ('-1.0', -1.0), ('-0.5', -0.5), ('0.0', 0.0), ('0.5', 0.5),
                    ('1.0', 1.0), ('2.0', 2.0), ('+Inf', CAST('Infinity' AS DOUBLE))) b (le, bound)
       GROUP BY le""",
)
def score_histogram(x: Inputs) -> DataFrame:
    scaled = x.scored().withColumn("score", F.col("score") / 1000.0)
    return V.score_histogram(K.rank_recommendations(scaled))


# Evaluation -------------------------------------------------------------------------------


def _users(x: Inputs) -> DataFrame:
    return M.eval_users(x.truth(), x.personal())


def _eval_truth(x: Inputs) -> DataFrame:
    return M.truth_of(x.truth(), _users(x))


def _final(x: Inputs) -> DataFrame:
    return M.recs_for_eval(x.recommendations(), _users(x))


def _novelty(x: Inputs) -> DataFrame:
    return M.novelty_map(x.shop_events(), x.bounds())


def _catalog(x: Inputs) -> DataFrame:
    return M.catalog_size(x.property_items())


@query("M1", "SELECT user_id, item_id FROM truth")
def ground_truth(x: Inputs) -> DataFrame:
    return M.ground_truth(x.shop_events(), x.bounds())


@query("M2", "SELECT user_id FROM eval_users")
def eval_users(x: Inputs) -> DataFrame:
    return _users(x)


@query("M2", "SELECT user_id, item_id FROM eval_truth")
def truth_of_eval_users(x: Inputs) -> DataFrame:
    return _eval_truth(x)


@query("M3", "SELECT user_id, item_id, rank FROM eval_popular")
def popular_as_recs(x: Inputs) -> DataFrame:
    return M.popular_as_recs(x.popular(), _users(x))


@query("M4", "SELECT user_id, item_id, rank FROM eval_final")
def recs_for_eval(x: Inputs) -> DataFrame:
    return _final(x)


@query("M5", "SELECT count(DISTINCT itemid) AS catalog_size FROM item_properties")
def catalog_size(x: Inputs) -> DataFrame:
    return _catalog(x)


@query("M6", "SELECT item_id, round(novelty, 6) AS novelty FROM item_novelty")
def novelty_map(x: Inputs) -> DataFrame:
    return with_rounded(_novelty(x), "novelty")


def _metrics_sql(recs: str) -> str:
    return f"""
        SELECT (SELECT round(avg(hits / 10.0), 6) FROM (
                  SELECT t.user_id, count(r.item_id) AS hits FROM eval_truth t
                  LEFT JOIN {recs} r ON r.user_id = t.user_id AND r.item_id = t.item_id
                  GROUP BY t.user_id)) AS precision,
               (SELECT round(avg(hits * 1.0 / relevant), 6) FROM (
                  SELECT t.user_id, count(r.item_id) AS hits, count(*) AS relevant
                  FROM eval_truth t
                  LEFT JOIN {recs} r ON r.user_id = t.user_id AND r.item_id = t.item_id
                  GROUP BY t.user_id)) AS recall,
               (SELECT round(count(DISTINCT item_id) * 1.0
                             / (SELECT count(DISTINCT itemid) FROM item_properties), 6)
                FROM {recs}) AS coverage,
               (SELECT round(avg(n.novelty), 6) FROM {recs} r
                JOIN item_novelty n ON n.item_id = r.item_id) AS novelty"""


@query("M7", f"SELECT precision FROM ({_metrics_sql('eval_final')})")
def precision_at_k(x: Inputs) -> DataFrame:
    return with_rounded(M.precision_at_k(_final(x), _eval_truth(x)), "precision")


@query("M8", f"SELECT recall FROM ({_metrics_sql('eval_final')})")
def recall_at_k(x: Inputs) -> DataFrame:
    return with_rounded(M.recall_at_k(_final(x), _eval_truth(x)), "recall")


@query("M9", f"SELECT coverage FROM ({_metrics_sql('eval_final')})")
def coverage_at_k(x: Inputs) -> DataFrame:
    return with_rounded(M.coverage_at_k(_final(x), _catalog(x)), "coverage")


@query("M10", f"SELECT novelty FROM ({_metrics_sql('eval_final')})")
def novelty_at_k(x: Inputs) -> DataFrame:
    return with_rounded(M.novelty_at_k(_final(x), _novelty(x)), "novelty")


_METRICS = ("precision", "recall", "coverage", "novelty")


@query("M11", _metrics_sql("eval_final"))
def evaluate_recommendations(x: Inputs) -> DataFrame:
    metrics = M.evaluate_recommendations(_final(x), _eval_truth(x), _catalog(x), _novelty(x))
    return with_rounded(metrics, *_METRICS)


@query(
    "M12",
    " UNION ALL ".join(
        f"SELECT '{name}' AS model, * FROM ({_metrics_sql(recs)})"
        for name, recs in (
            ("Top Popular", "eval_popular"),
            ("ALS", "eval_personal"),
            ("Final Ranker", "eval_final"),
        )
    ),
)
def compare_models(x: Inputs) -> DataFrame:
    users = _users(x)
    models = {
        "Top Popular": M.popular_as_recs(x.popular(), users),
        "ALS": M.recs_for_eval(x.personal(), users),
        "Final Ranker": _final(x),
    }
    return with_rounded(
        M.compare_models(models, _eval_truth(x), _catalog(x), _novelty(x)), *_METRICS
    )
