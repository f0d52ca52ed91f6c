"""Final lists: purchases removed, scored, cut to k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.config import PURCHASE_EVENT, SCORE_BUCKETS
from basketry.functions.ranking import top_n_per_group
from basketry.operators.cleaning import normalize_interactions
from basketry.operators.ranker import score_candidates

MOST_SERVED = 100  # fixed value: longest list that a request may ask for


def serve_batch(
    candidates: DataFrame,
    events: DataFrame,
    model: Model | None = None,
    users: DataFrame | Sequence[int] | None = None,
    top_k: int = 10,
) -> DataFrame:
    """Top-k lists for all users, or for ``users``, without items they ever bought.

    All purchases count, whenever they happened.  A user whose candidates are all bought,
    or who has none, gets no rows.  Without a ``model`` the candidates carry ``score``.
    ``top_k`` lies between 1 and MOST_SERVED.
    """
    if not 1 <= top_k <= MOST_SERVED:
        raise ValueError(f"top_k must lie between 1 and {MOST_SERVED}")
    bought = (
        normalize_interactions(events)
        .where(F.col("event") == PURCHASE_EVENT)
        .select("user_id", "item_id")
        .distinct()
    )
    if isinstance(users, DataFrame):
        wanted = users.select("user_id").distinct()
        candidates = candidates.join(wanted, "user_id", "left_semi")
    elif users is not None:
        candidates = candidates.where(F.col("user_id").isin(list(users)))
    open_pairs = candidates.join(bought, ["user_id", "item_id"], "left_anti")
    scored = open_pairs if model is None else score_candidates(model, open_pairs)
    order = [F.desc_nulls_last("score"), F.col("item_id")]
    return top_n_per_group(
        scored.select("user_id", "item_id", "score"), ["user_id"], order, top_k
    )


def score_histogram(
    recommendations: DataFrame, buckets: Sequence[float] = SCORE_BUCKETS
) -> DataFrame:
    """Cumulative number of scores up to each bound, the last bound being infinity."""
    score = F.col("score").cast("double")
    bounds = [*[float(b) for b in buckets], float("inf")]
    rows = [
        F.struct(
            F.lit(repr(b) if b != float("inf") else "+Inf").alias("le"),
            (F.count("score") if b == float("inf") else F.count_if(score <= b)).alias("count"),
        )
        for b in bounds
    ]
    return recommendations.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))
