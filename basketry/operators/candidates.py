"""Candidate pairs per user and their features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.config import EVENT_TYPES, CandidateConfig
from basketry.functions.columns import small_list
from basketry.functions.ranking import top_n_per_group
from basketry.operators.cleaning import normalize_interactions
from basketry.operators.splits import before
from basketry.schemas import CANDIDATES, conform

_PAIR = ("user_id", "item_id")


def als_candidates(personal_als: DataFrame) -> DataFrame:
    """Distinct (user, item) pairs of the factorisation."""
    return personal_als.select(
        F.col("visitorid").alias("user_id"), F.col("itemid").alias("item_id")
    ).distinct()


def user_history(
    events: DataFrame,
    bounds: DataFrame,
    n: int = 10,
    types: Sequence[str] = EVENT_TYPES,
) -> DataFrame:
    """The ``n`` items every user touched last before the ranker window.

    The last touch per (user, item) is a partial aggregate; the ranking afterwards is pruned
    to ``n`` rows per user on the map side.
    """
    touched = (
        before(normalize_interactions(events), bounds, "ranker_start")
        .where(F.col("event").isin(list(types)))
        .groupBy(*_PAIR)
        .agg(F.max("timestamp").alias("_last"))
    )
    recent = top_n_per_group(
        touched, ["user_id"], [F.desc("_last"), F.col("item_id")], n, "_place"
    )
    return recent.select("user_id", F.col("item_id").alias("source_item_id"))


def history_users(
    events: DataFrame, bounds: DataFrame, types: Sequence[str] = EVENT_TYPES
) -> DataFrame:
    """Users with a non-empty history: one partial aggregation of user ids, no ranking."""
    past = before(normalize_interactions(events), bounds, "ranker_start")
    return past.where(F.col("event").isin(list(types))).select("user_id").distinct()


def similar_features(history: DataFrame, similar: DataFrame, top_n: int = 50) -> DataFrame:
    """Per (user, candidate): best score, best rank and number of history items behind it.

    An item in a third of all histories makes its key hot.  Its neighbours are at most
    ``top_n`` rows, so adaptive execution can split the history side of that key and repeat
    those rows.  It only does so if nothing above relies on the join's partitioning: sources
    are therefore counted as rows of distinct (user, source) pairs and not with a distinct
    count, which would be computed inside the partitions of the join.  ``similar`` holds a
    pair of items once; the histories come partitioned by user, so making them distinct
    needs no shuffle.
    """
    near = similar.where(F.col("rank") <= top_n).select(
        F.col("itemid").alias("source_item_id"),
        F.col("similar_itemid").alias("item_id"),
        "score",
        "rank",
    )
    return (
        history.select("user_id", "source_item_id")
        .distinct()
        .join(near, "source_item_id")
        .groupBy(*_PAIR)
        .agg(
            F.max("score").cast("float").alias("similarity_score"),
            F.min("rank").cast("short").alias("similarity_rank"),
            F.count(F.lit(1)).cast("short").alias("similarity_sources"),
        )
    )


def popular_candidates(users: DataFrame, top_popular: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most popular items for every distinct user.

    The items are one array value of ``n`` entries that each user row expands.
    """
    best = small_list(top_popular.where(F.col("rank") <= n), "rank", "itemid")
    return (
        users.select("user_id")
        .distinct()
        .select("user_id", F.explode(best).alias("_item"))
        .select("user_id", F.col("_item.itemid").alias("item_id"))
    )


def union_candidates(*sources: DataFrame) -> DataFrame:
    """Distinct pairs over all sources."""
    pairs = [source.select(*_PAIR) for source in sources]
    return reduce(lambda a, b: a.unionByName(b), pairs).distinct()


def add_popular_features(candidates: DataFrame, top_popular: DataFrame) -> DataFrame:
    """Score and rank of items in the popularity table, whoever proposed the pair.

    The table has at most the top-n rows it was built with; Catalyst knows the bound from
    its limit (or the file size) and broadcasts it only below its own threshold.
    """
    popular = top_popular.select(
        F.col("itemid").alias("item_id"),
        F.col("score").cast("float").alias("popular_score"),
        F.col("rank").cast("short").alias("popular_rank"),
    )
    return candidates.join(popular, "item_id", "left").select(
        *candidates.columns, "popular_score", "popular_rank"
    )


def add_similar_features(candidates: DataFrame, features: DataFrame) -> DataFrame:
    """Similarity score, rank and sources of pairs that have them."""
    columns = ("similarity_score", "similarity_rank", "similarity_sources")
    return candidates.join(features.select(*_PAIR, *columns), list(_PAIR), "left").select(
        *candidates.columns, *columns
    )


def _als_features(personal_als: DataFrame) -> DataFrame:
    return personal_als.select(
        F.col("visitorid").alias("user_id"),
        F.col("itemid").alias("item_id"),
        F.col("score").cast("float").alias("als_score"),
        F.col("rank").cast("short").alias("als_rank"),
    )


def add_als_features(candidates: DataFrame, personal_als: DataFrame) -> DataFrame:
    """Factorisation score and rank of pairs that have them."""
    return candidates.join(_als_features(personal_als), list(_PAIR), "left").select(
        *candidates.columns, "als_score", "als_rank"
    )


def finalize_candidates(candidates: DataFrame) -> DataFrame:
    """Source flags, log popularity and the published column types.

    A flag says that the source knows the pair: ``from_popular`` spans the whole popularity
    table and not only the items proposed from it.
    """

    def known(score: str):
        return F.col(score).isNotNull().cast("byte")

    return conform(
        candidates.select(
            "*",
            known("als_score").alias("from_als"),
            known("popular_score").alias("from_popular"),
            known("similarity_score").alias("from_similar"),
            F.log1p(F.col("popular_score").cast("double")).alias("popular_score_log"),
        ),
        CANDIDATES,
    )


def candidate_stats(candidates: DataFrame) -> DataFrame:
    """One row: pairs, share per source flag and share of pairs with each score."""
    return candidates.agg(
        F.count(F.lit(1)).alias("candidates_count"),
        F.avg("from_als").alias("from_als_share"),
        F.avg("from_popular").alias("from_popular_share"),
        F.avg("from_similar").alias("from_similar_share"),
        *[
            F.avg(F.col(f"{s}_score").isNotNull().cast("double")).alias(f"{s}_score_notna_share")
            for s in ("als", "popular", "similarity")
        ],
        F.count_if(F.col("popular_score") > 0).alias("popular_count"),
        F.avg(F.coalesce(F.col("popular_score") > 0, F.lit(False)).cast("double")).alias(
            "popular_share"
        ),
    )


def build_candidates(
    events: DataFrame,
    bounds: DataFrame,
    top_popular: DataFrame,
    personal_als: DataFrame,
    similar: DataFrame,
    config: CandidateConfig = CandidateConfig(),
) -> DataFrame:
    """All candidates with all features, as one lazy plan.

    Same rows as union, three feature joins and finalisation one after the other, with one
    shuffle on (user, item) in place of four: every source already carries its features for
    exactly the pairs it proposes, so stacking the sources and taking the one non-null value
    per pair both removes duplicates and attaches the features.  (user, item) keys are
    unique per source, so no key is hot.
    """
    history = user_history(events, bounds, config.history_items)
    als = _als_features(personal_als)
    similarity = similar_features(history, similar, config.similar_top_n)
    # Everyone with a history event has a row of history, and it is already placed by user.
    users = history.select("user_id").distinct()
    popular = popular_candidates(users, top_popular, config.popular_top_n)
    features = (
        "als_score",
        "als_rank",
        "similarity_score",
        "similarity_rank",
        "similarity_sources",
    )
    stacked = als.unionByName(similarity, allowMissingColumns=True).unionByName(
        popular, allowMissingColumns=True
    )
    pairs = stacked.groupBy(*_PAIR).agg(*[F.max(c).alias(c) for c in features])
    return finalize_candidates(add_popular_features(pairs, top_popular))
