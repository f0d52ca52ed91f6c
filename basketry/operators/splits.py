"""Time windows, positive pairs and id encoding."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.config import POSITIVE_EVENTS, SplitConfig
from basketry.functions.columns import single_value
from basketry.functions.ranking import number_rows
from basketry.operators.cleaning import normalize_interactions


class Splits(NamedTuple):
    history: DataFrame
    ranker: DataFrame
    evaluation: DataFrame


def time_boundaries(events: DataFrame, config: SplitConfig = SplitConfig()) -> DataFrame:
    """One row: ``ranker_start``, ``evaluation_start`` and ``data_end``.

    ``data_end`` lies one millisecond after the last event, so that half-open windows hold
    every event.  The table is used through scalar subqueries and never joined.
    """
    end = F.max("timestamp") + F.expr("INTERVAL '0.001' SECOND")
    evaluation = end - F.make_dt_interval(days=F.lit(config.evaluation_days))
    ranker = end - F.make_dt_interval(days=F.lit(config.evaluation_days + config.ranker_days))
    return normalize_interactions(events).agg(
        ranker.alias("ranker_start"), evaluation.alias("evaluation_start"), end.alias("data_end")
    )


def before(events: DataFrame, bounds: DataFrame, boundary: str) -> DataFrame:
    """Events strictly before a boundary."""
    return events.where(F.col("timestamp") < single_value(bounds, boundary))


def within(events: DataFrame, bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Events in the half-open window ``[start, end)``."""
    time = F.col("timestamp")
    return events.where(
        (time >= single_value(bounds, start)) & (time < single_value(bounds, end))
    )


def temporal_split(events: DataFrame, bounds: DataFrame) -> Splits:
    """History before the ranker window, the ranker window and the evaluation window."""
    events = normalize_interactions(events)
    return Splits(
        history=before(events, bounds, "ranker_start"),
        ranker=within(events, bounds, "ranker_start", "evaluation_start"),
        evaluation=within(events, bounds, "evaluation_start", "data_end"),
    )


def positive_pairs(events: DataFrame, types: Sequence[str] = POSITIVE_EVENTS) -> DataFrame:
    """Distinct (user, item) pairs with a cart or a purchase."""
    return (
        normalize_interactions(events)
        .where(F.col("event").isin(list(types)))
        .select("user_id", "item_id")
        .distinct()
    )


def known_only(test: DataFrame, train: DataFrame) -> DataFrame:
    """Test rows whose user and item both occur in the training rows.

    Training keys are made distinct first: partial aggregation shrinks them on the map side,
    and the semi joins then meet one row per key.
    """
    test, train = normalize_interactions(test), normalize_interactions(train)
    for key in ("user_id", "item_id"):
        test = test.join(train.select(key).distinct(), key, "left_semi")
    return test.select(*normalize_interactions(train).columns)


def encode_ids(df: DataFrame, column: str, index: str = "index") -> DataFrame:
    """Dense 0-based index of every distinct id in ascending order: ``(column, index)``."""
    ids = df.select(column).where(F.col(column).isNotNull()).distinct()
    return number_rows(ids, [F.col(column)], index)


def apply_encoding(df: DataFrame, encoding: DataFrame, column: str, index: str = "index") -> DataFrame:
    """``df`` with the id column replaced by its index."""
    return df.join(encoding, column).drop(column)


def decode_ids(df: DataFrame, encoding: DataFrame, column: str, index: str = "index") -> DataFrame:
    """``df`` with the index replaced by the id it stands for."""
    return df.join(encoding, index).drop(index)
