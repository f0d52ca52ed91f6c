"""Data-quality and profiling reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.columns import is_blank, is_missing, missing_or_blank, percent
from basketry.functions.stats import QUARTILES, describe_counts
from basketry.sources.tables import read_csv, union_parts


def _missing_cell(field: T.StructField) -> Column:
    return is_missing(field.name, field.dataType).cast("int")


def _blank_cell(field: T.StructField) -> Column:
    if not isinstance(field.dataType, T.StringType):
        return F.lit(0)
    return F.coalesce(is_blank(F.col(field.name)).cast("int"), F.lit(0))


def _rows_of(df: DataFrame, per_column: Mapping[str, Sequence[Column]], names: Sequence[str]):
    """Aggregate once, then turn the one row of aggregates into one row per column."""
    entries = [
        F.struct(F.lit(column).alias("column"), *[v.alias(n) for v, n in zip(values, names)])
        for column, values in per_column.items()
    ]
    return df.agg(F.array(*entries).alias("_entries")).select(F.inline("_entries"))


def quality_summary(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Per dataset: rows, repeated rows (all but the first), null cells and blank strings.

    One shuffle per table: equal rows are counted together, and everything else follows
    from the groups.  Copies are merged on the map side, so a row repeated a billion times
    costs one record per map task.
    """
    reports = []
    for name, df in datasets.items():
        fields = df.schema.fields
        nulls = sum((_missing_cell(f) for f in fields), F.lit(0))
        blanks = sum((_blank_cell(f) for f in fields), F.lit(0))
        groups = df.groupBy(*[f"`{f.name}`" for f in fields]).agg(F.count(F.lit(1)).alias("_n"))
        n = F.col("_n")
        reports.append(
            groups.agg(
                F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(n - 1), F.lit(0)).alias("duplicates"),
                F.coalesce(F.sum(n * nulls), F.lit(0)).alias("null_values"),
                F.coalesce(F.sum(n * blanks), F.lit(0)).alias("empty_strings"),
            ).select(F.lit(name).alias("dataset"), "*")
        )
    return union_parts(reports)


def quality_by_column(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Null and blank cells per column; only columns that have some."""
    reports = []
    for name, df in datasets.items():
        counts = {
            f.name: (
                F.coalesce(F.sum(_missing_cell(f)), F.lit(0)).cast("bigint"),
                F.coalesce(F.sum(_blank_cell(f)), F.lit(0)).cast("bigint"),
            )
            for f in df.schema.fields
        }
        reports.append(
            _rows_of(df, counts, ("null_values", "empty_strings")).select(
                F.lit(name).alias("dataset"), "*"
            )
        )
    return union_parts(reports).where("null_values > 0 OR empty_strings > 0")


def csv_quality(
    spark: SparkSession, files: Mapping[str, tuple[str, T.StructType]]
) -> DataFrame:
    """``quality_summary`` straight from CSV files given as name -> (path, schema)."""
    return quality_summary(
        {name: read_csv(spark, path, schema) for name, (path, schema) in files.items()}
    )


def missing_by_column(df: DataFrame) -> DataFrame:
    """Null count and percentage (two places) of every column that has nulls."""
    rows = F.count(F.lit(1))
    counts = {
        f.name: (
            F.coalesce(F.sum(_missing_cell(f)), F.lit(0)).cast("bigint"),
            F.round(percent(F.sum(_missing_cell(f)), rows), 2),
        )
        for f in df.schema.fields
    }
    return _rows_of(df, counts, ("null_count", "null_percent")).where("null_count > 0")


def missing_by_group(df: DataFrame, key: str, column: str) -> DataFrame:
    """Rows, null and filled values of ``column`` per value of ``key``."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(column).isNull()).alias("null_count"),
            F.count(column).alias("filled_count"),
        )
    )


def numeric_profile(df: DataFrame) -> DataFrame:
    """Type, range and narrowest lossless integer type of every numeric column.

    Ranges are compared in the column's own type.  Fractional columns keep their type.
    """
    integers = (
        # Ranges of the integer types.
        ("tinyint", -(2**7), 2**7 - 1),
        ("smallint", -(2**15), 2**15 - 1),
        ("int", -(2**31), 2**31 - 1),
    )
    profile = {}
    for f in df.schema.fields:
        if not isinstance(f.dataType, T.NumericType):
            continue
        low, high, dtype = F.min(f.name), F.max(f.name), f.dataType.simpleString()
        narrowest = F.lit(dtype)
        if isinstance(f.dataType, T.IntegralType):
            narrowest = F.lit("bigint")
            for name, smallest, largest in reversed(integers):
                fits = (low >= smallest) & (high <= largest)
                narrowest = F.when(fits, F.lit(name)).otherwise(narrowest)
            narrowest = F.when(low.isNull(), F.lit(dtype)).otherwise(narrowest)
        profile[f.name] = (F.lit(dtype), low.cast("double"), high.cast("double"), narrowest)
    return _rows_of(df, profile, ("dtype", "min", "max", "narrowest"))


def compare_datasets(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: shapes of both tables and whether they hold the same rows.

    Rows count as a multiset, in any order.  Tasks send digests of a fixed number of buckets,
    so no row moves: two 64-bit hashes of every row, summed and exclusive-ored with its side's
    sign.  ``differing_rows`` shows which rows differ.
    """
    same_columns = left.dtypes == right.dtypes
    if not same_columns:
        shape = F.struct(F.count(F.lit(1)).alias("rows"))
        other = right.agg(shape.alias("other")).scalar()
        return left.agg(F.count(F.lit(1)).alias("rows")).select(
            "rows",
            F.lit(len(left.columns)).alias("columns"),
            other["rows"].alias("other_rows"),
            F.lit(len(right.columns)).alias("other_columns"),
            F.when(F.lit(len(left.columns) == len(right.columns)), F.col("rows") == other["rows"])
            .otherwise(False)
            .alias("same_shape"),
            F.lit(False).alias("same_data"),
        )
    both = _hashed(left, right)
    buckets = both.groupBy(_bucket("_one").alias("_bucket")).agg(*_digest())
    return buckets.agg(
        F.coalesce(F.sum("_in_left"), F.lit(0)).alias("rows"),
        F.lit(len(left.columns)).alias("columns"),
        F.coalesce(F.sum("_in_right"), F.lit(0)).alias("other_rows"),
        F.lit(len(right.columns)).alias("other_columns"),
        F.coalesce(F.sum("_in_left") == F.sum("_in_right"), F.lit(True)).alias("same_shape"),
        (F.count_if(F.expr(_DIFFERS)) == 0).alias("same_data"),
    )


DIGEST_BUCKETS = 4096
FINE_BUCKETS = 1 << 16
_DIFFERS = "_in_left <> _in_right OR _sum <> 0 OR _xor <> 0"


def _digest() -> list[Column]:
    """Of a bucket: rows on either side, and a sum and an exclusive or of hashes, which do not
    depend on the order of rows; what both sides have cancels out."""
    return [
        F.count_if(F.col("_sign") > 0).alias("_in_left"),
        F.count_if(F.col("_sign") < 0).alias("_in_right"),
        F.sum(F.col("_sign") * F.col("_two").cast("decimal(20,0)")).alias("_sum"),
        F.bit_xor("_one").alias("_xor"),
    ]


def _hashed(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both tables with two hashes and the sign of their side."""
    cells = [F.col(f"`{c}`") for c in left.columns]
    # A null adds nothing to a hash, so where nulls stand is hashed as well.
    cells += [c.isNull() for c in cells]
    sides = [
        df.withColumns({"_one": F.xxhash64(*cells), "_two": F.xxhash64(F.lit(1), *cells), "_sign": F.lit(s)})
        for df, s in ((left, 1), (right, -1))
    ]
    return sides[0].unionByName(sides[1])


def _bucket(column: str) -> Column:
    return F.pmod(F.col(column), F.lit(DIGEST_BUCKETS))


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that two tables of the same columns do not hold equally often, with how often
    either does (``in_left``, ``in_right``).

    Digests of ``FINE_BUCKETS`` buckets are compared first, without a row moving; only rows of
    buckets that differ are grouped.  So of tables that are nearly equal hardly any rows move,
    and of others every row moves once.
    """
    if left.dtypes != right.dtypes:
        raise ValueError("the tables have different columns")
    both = _hashed(left, right).withColumn("_bucket", F.pmod(F.col("_one"), F.lit(FINE_BUCKETS)))
    # Halves of a hash are summed as longs; a sum that leaves their range counts as a difference.
    halves = F.col("_two").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("_two", 32)
    digest = [F.try_sum(F.col("_sign") * half).alias(f"_sum_{k}") for k, half in enumerate(halves)]
    differ = (
        both.groupBy("_bucket")
        .agg(*_digest()[:2], *digest, F.bit_xor("_one").alias("_xor"))
        .where(
            "_in_left <> _in_right OR _xor <> 0"
            " OR coalesce(_sum_0 <> 0, true) OR coalesce(_sum_1 <> 0, true)"
        )
        .select("_bucket")
    )
    # At most FINE_BUCKETS numbers, whatever the rows.
    found = both.join(F.broadcast(differ), "_bucket", "left_semi")
    groups = found.groupBy(*[F.col(f"`{c}`") for c in left.columns]).agg(*_digest()[:2])
    return groups.where("_in_left <> _in_right").withColumnsRenamed(
        {"_in_left": "in_left", "_in_right": "in_right"}
    )


def compare_storage(left_bytes: DataFrame, right_bytes: DataFrame) -> DataFrame:
    """Megabytes of two datasets and how many times smaller the second one is."""
    other = right_bytes.select("bytes").scalar()
    mb = 1024.0 * 1024.0
    return left_bytes.select(
        F.round(F.col("bytes") / mb, 2).alias("disk_mb"),
        F.round(other / mb, 2).alias("other_disk_mb"),
        F.round(F.try_divide(F.col("bytes").cast("double"), other.cast("double")), 2).alias(
            "compression"
        ),
    )


def comparison_report(
    pairs: Mapping[str, tuple[DataFrame, DataFrame, DataFrame, DataFrame]],
) -> DataFrame:
    """One row per dataset: shapes and rows of two forms of it, their sizes and ratio.

    ``pairs``: by name the two tables, then the bytes of the files of either (see
    ``dataset_bytes``).
    """
    rows = []
    for name, (left, right, left_bytes, right_bytes) in pairs.items():
        sizes = compare_storage(left_bytes, right_bytes).select(F.struct("*").alias("s")).scalar()
        rows.append(
            compare_datasets(left, right)
            .withColumn("_sizes", sizes)
            .select(F.lit(name).alias("dataset"), "*", "_sizes.*")
            .drop("_sizes")
        )
    return union_parts(rows)


def property_missing_share(props: DataFrame) -> DataFrame:
    """Per property: rows and share of null or blank values; only where there are some."""
    return (
        props.where(F.col("property").isNotNull())
        .groupBy("property")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(missing_or_blank(F.col("value"))).alias("missing_values"),
        )
        .where("missing_values > 0")
        .withColumn("missing_percent", percent(F.col("missing_values"), F.col("rows")))
        .orderBy(F.desc("missing_percent"), "property")
    )


def property_zero_values(props: DataFrame) -> DataFrame:
    """Per property: rows and values that are the number 0; only where there are some."""
    is_zero = F.trim(F.col("value")).try_cast("double") == 0
    return (
        props.where(F.col("property").isNotNull())
        .groupBy("property")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_zero).alias("zero_values"))
        .where("zero_values > 0")
        .orderBy(F.desc("zero_values"), "property")
    )


def items_without_properties(events: DataFrame, props: DataFrame) -> DataFrame:
    """One row: items in events, items with properties, event items lacking them.

    One shuffle of item ids with map-side merging serves both sides.
    """
    seen = events.select("itemid", F.lit(1).alias("_event"), F.lit(0).alias("_prop"))
    known = props.select("itemid", F.lit(0).alias("_event"), F.lit(1).alias("_prop"))
    items = (
        seen.unionByName(known)
        .groupBy("itemid")
        .agg(F.max("_event").alias("_event"), F.max("_prop").alias("_prop"))
    )
    return items.agg(
        F.count_if(F.col("_event") == 1).alias("event_items"),
        F.count_if(F.col("_prop") == 1).alias("property_items"),
        F.count_if((F.col("_event") == 1) & (F.col("_prop") == 0)).alias("items_without_properties"),
    )


def list_items_without_properties(events: DataFrame, props: DataFrame) -> DataFrame:
    """The event items that have no property row."""
    return (
        events.select("itemid")
        .distinct()
        .join(props.select("itemid").distinct(), "itemid", "left_anti")
    )


def items_with_blank_fields(props: DataFrame) -> DataFrame:
    """One row: items with a null or blank property name, and with such a value."""
    items = props.groupBy("itemid").agg(
        F.max(missing_or_blank(F.col("property"))).alias("_property"),
        F.max(missing_or_blank(F.col("value"))).alias("_value"),
    )
    return items.where(F.col("itemid").isNotNull()).agg(
        F.count_if("_property").alias("items_with_blank_property"),
        F.count_if("_value").alias("items_with_blank_value"),
    )


def values_per_item(props: DataFrame, property: str) -> DataFrame:
    """Distinct values one property takes per item, described over the items."""
    per_item = (
        props.where(F.col("property") == property)
        .groupBy("itemid")
        .agg(F.countDistinct("value").alias("values"))
    )
    return describe_counts(per_item, "values", QUARTILES)


def time_range(df: DataFrame, column: str = "timestamp", by: Sequence[str] = ()) -> DataFrame:
    """First and last time, overall or per ``by``."""
    return df.groupBy(*by).agg(
        F.min(column).alias("min_time"), F.max(column).alias("max_time")
    )


def column_value_profile(df: DataFrame) -> DataFrame:
    """Per column: filled, null, zero and non-zero cells.

    ``non_zero`` counts a null as non-zero; ``non_zero_filled`` does not, and the
    percentage is taken from it.
    """
    rows = F.count(F.lit(1))
    profile = {}
    for f in df.schema.fields:
        filled = F.count_if(~is_missing(f.name, f.dataType))
        zero = F.lit(0).cast("bigint")
        if isinstance(f.dataType, T.NumericType):
            zero = F.count_if(F.col(f.name) == 0)
        profile[f.name] = (
            filled,
            rows - filled,
            zero,
            rows - zero,
            filled - zero,
            F.round(percent(filled - zero, rows), 2),
        )
    names = ("notna", "isna", "zero", "non_zero", "non_zero_filled", "non_zero_percent")
    return _rows_of(df, profile, names)
