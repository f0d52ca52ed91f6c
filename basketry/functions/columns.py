"""Column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: text that is empty once Unicode white space is stripped.
BLANK_TEXT = r"(?U)^[\s\x1c-\x1f]*$"

_PERIODS = ("year", "quarter", "month", "week")


def is_blank(text: Column) -> Column:
    """True for '', spaces, tabs and other white space; null for null."""
    return text.rlike(BLANK_TEXT)


def is_missing(column: str, dtype: T.DataType) -> Column:
    """Null, and NaN for floating-point columns."""
    missing = F.col(column).isNull()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        missing = missing | F.isnan(column)
    return missing


def missing_or_blank(text: Column) -> Column:
    return text.isNull() | is_blank(text)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, null where the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double")) * 100


def epoch_millis_to_time(millis: Column) -> Column:
    """Epoch milliseconds as UTC wall-clock time, whatever the session time zone is."""
    since = F.expr("INTERVAL '0.001' SECOND") * millis.cast("bigint")
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + since


def time_to_epoch_millis(time: Column) -> Column:
    """UTC wall-clock time as whole epoch milliseconds, fractions cut off."""
    since = time.cast("timestamp_ntz") - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    parts = {"DAY": 86_400_000, "HOUR": 3_600_000, "MINUTE": 60_000}
    whole = sum(
        (F.extract(F.lit(unit), since).cast("bigint") * millis for unit, millis in parts.items()),
        F.lit(0).cast("bigint"),
    )
    seconds = F.extract(F.lit("SECOND"), since).cast("decimal(18,6)")
    return whole + F.floor(seconds * 1000).cast("bigint")


def period_start(time: Column, unit: str) -> Column:
    """First date of the period ``time`` falls in."""
    day = time.cast("date")
    if unit == "day":
        return day
    if unit not in _PERIODS:
        raise ValueError(f"unit must be day or one of {_PERIODS}, got {unit!r}")
    return F.trunc(day, unit)


def time_literal(df: DataFrame, column: str, value: str | dt.datetime) -> Column:
    """``value`` as a literal of the column's own type, so that a filter is pushed down."""
    return F.lit(str(value)).cast(df.schema[column].dataType)


def between_times(
    df: DataFrame,
    column: str,
    low: str | dt.datetime | None = None,
    high: str | dt.datetime | None = None,
) -> DataFrame:
    """Rows in the half-open range ``[low, high)``; an unset end is open."""
    if low is not None:
        df = df.where(F.col(column) >= time_literal(df, column, low))
    if high is not None:
        df = df.where(F.col(column) < time_literal(df, column, high))
    return df


def single_value(one_row: DataFrame, column: str) -> Column:
    """A column of a one-row DataFrame as an uncorrelated scalar subquery.

    The subquery runs once, before the outer query, and its value reaches the Parquet
    scan as a pushed filter.  No join, no broadcast table, no driver round trip.
    """
    return one_row.select(column).scalar()


def small_list(rows: DataFrame, *columns: str) -> Column:
    """All rows of a table that a ``limit`` or a rank filter bounds, as one array value.

    Only for tables whose row count is fixed by a parameter.
    """
    packed = F.array_sort(F.collect_list(F.struct(*columns)))
    return rows.agg(packed.alias("rows")).scalar()
