"""Offline metrics of recommendation lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.columns import ratio, single_value, small_list
from basketry.operators.cleaning import normalize_interactions
from basketry.operators.splits import before, positive_pairs, within

_PAIR = ("user_id", "item_id")
_BY = ("model",)


def ground_truth(events: DataFrame, bounds: DataFrame) -> DataFrame:
    """Distinct positive pairs of the evaluation window."""
    events = normalize_interactions(events)
    return positive_pairs(within(events, bounds, "evaluation_start", "data_end"))


def eval_users(truth: DataFrame, als: DataFrame, k: int = 10) -> DataFrame:
    """Users that have relevant items and factorisation recommendations."""
    known = als.where(F.col("rank") <= k).select(F.col("visitorid").alias("user_id"))
    return truth.select("user_id").intersect(known)


def truth_of(truth: DataFrame, users: DataFrame) -> DataFrame:
    """Relevant pairs of the evaluated users."""
    return truth.join(users.select("user_id"), "user_id", "left_semi")


def popular_as_recs(top_popular: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """The same ``k`` popular items for every user, ranked."""
    best = small_list(top_popular.where(F.col("rank") <= k), "rank", "itemid")
    return (
        users.select("user_id")
        .distinct()
        .select("user_id", F.explode(best).alias("_item"))
        .select("user_id", F.col("_item.itemid").alias("item_id"), F.col("_item.rank").alias("rank"))
    )


def recs_for_eval(recs: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best rows of a ranked list for the evaluated users."""
    canonical = recs.withColumnsRenamed({"visitorid": "user_id", "itemid": "item_id"})
    return (
        canonical.where(F.col("rank") <= k)
        .select(*_PAIR, "rank")
        .join(users.select("user_id"), "user_id", "left_semi")
    )


def catalog_size(props: DataFrame) -> DataFrame:
    """One row: items of the property table, not of the events."""
    return props.agg(F.countDistinct("itemid").alias("catalog_size"))


def novelty_map(events: DataFrame, bounds: DataFrame) -> DataFrame:
    """Self-information of every item among all events before the evaluation window.

    Their number is summed from the items' counts, so the events are read once.
    """
    past = before(normalize_interactions(events), bounds, "evaluation_start")
    counts = (
        past.where(F.col("item_id").isNotNull())
        .groupBy("item_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    total = counts.agg(F.sum("_n").alias("events")).scalar()
    return counts.select(
        "item_id", (-F.log2(F.col("_n").cast("double") / total)).alias("novelty")
    )


def _top(recs: DataFrame, k: int) -> DataFrame:
    return recs.where(F.col("rank") <= k).select(*_BY, *_PAIR).distinct()


def _user_hits(recs: DataFrame, truth: DataFrame, k: int, models: Sequence[str]) -> DataFrame:
    """Hits and relevant items of every model and user with relevant items.

    Both sides are stacked and grouped, so truth users without recommendations stay in with
    no hits and recommendations of other users drop out.
    """
    names = F.array(*[F.lit(m) for m in models])
    relevant = truth.select(F.explode(names).alias("model"), *_PAIR)
    both = (
        _top(recs, k)
        .select("*", F.lit(1).alias("_rec"), F.lit(0).alias("_true"))
        .unionByName(relevant.select("*", F.lit(0).alias("_rec"), F.lit(1).alias("_true")))
    )
    pairs = both.groupBy(*_BY, *_PAIR).agg(
        F.max("_rec").alias("_rec"), F.max("_true").alias("_true")
    )
    return (
        pairs.groupBy(*_BY, "user_id")
        .agg(F.sum(F.col("_rec") * F.col("_true")).alias("hits"), F.sum("_true").alias("relevant"))
        .where("relevant > 0")
    )


def _precision(k: int) -> Column:
    return F.avg(F.col("hits").cast("double") / F.lit(float(k))).alias("precision")


def _recall() -> Column:
    return F.avg(F.col("hits").cast("double") / F.col("relevant")).alias("recall")


def _recommended_items(recs: DataFrame, novelty: DataFrame, k: int) -> DataFrame:
    """How often a model recommends each item, with the item's novelty if it has one."""
    counted = _top(recs, k).groupBy(*_BY, "item_id").agg(F.count(F.lit(1)).alias("_n"))
    return counted.join(novelty, "item_id", "left")


def _mean_novelty() -> Column:
    known = F.when(F.col("novelty").isNotNull(), F.col("_n"))
    return F.try_divide(F.sum(F.col("novelty") * known), F.sum(known).cast("double")).alias(
        "novelty"
    )


def _coverage(catalog: DataFrame) -> Column:
    """Share of the catalog among rows that hold one recommended item each."""
    return ratio(F.count(F.lit(1)), single_value(catalog, "catalog_size")).alias("coverage")


def _one(recs: DataFrame) -> DataFrame:
    return recs.withColumn("model", F.lit(""))


def precision_at_k(recs: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    """One row: mean over truth users of hits / k, also when a user has fewer rows."""
    return _user_hits(_one(recs), truth, k, [""]).agg(_precision(k))


def recall_at_k(recs: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    """One row: mean over truth users of the share of relevant items that were found."""
    return _user_hits(_one(recs), truth, k, [""]).agg(_recall())


def coverage_at_k(recs: DataFrame, catalog: DataFrame, k: int = 10) -> DataFrame:
    """One row: different recommended items over catalog size."""
    size = single_value(catalog, "catalog_size")
    return (
        recs.where(F.col("rank") <= k)
        .agg(F.countDistinct("item_id").alias("_items"))
        .select(ratio(F.col("_items"), size).alias("coverage"))
    )


def novelty_at_k(recs: DataFrame, novelty: DataFrame, k: int = 10) -> DataFrame:
    """One row: mean novelty over recommended rows; items without novelty are skipped."""
    return _recommended_items(_one(recs), novelty, k).agg(_mean_novelty())


def evaluate_recommendations(
    recs: DataFrame, truth: DataFrame, catalog: DataFrame, novelty: DataFrame, k: int = 10
) -> DataFrame:
    """One row: precision, recall, coverage and novelty at ``k``.

    Hits count for truth users only; coverage and novelty look at every list given.
    """
    items = _recommended_items(_one(recs), novelty, k).agg(
        F.struct(_coverage(catalog), _mean_novelty()).alias("items")
    )
    return (
        _user_hits(_one(recs), truth, k, [""])
        .agg(_precision(k), _recall())
        .withColumn("_items", single_value(items, "items"))
        .select("precision", "recall", "_items.coverage", "_items.novelty")
    )


def compare_models(
    models: Mapping[str, DataFrame],
    truth: DataFrame,
    catalog: DataFrame,
    novelty: DataFrame,
    k: int = 10,
) -> DataFrame:
    """Metrics of several models, one row each.

    The lists are stacked with their model's name and measured together: the number of
    shuffles does not grow with the number of models.
    """
    names = list(models)
    recs = reduce(
        lambda a, b: a.unionByName(b),
        [df.select(F.lit(m).alias("model"), *_PAIR, "rank") for m, df in models.items()],
    )
    users = _user_hits(recs, truth, k, names).groupBy(*_BY).agg(_precision(k), _recall())
    items = (
        _recommended_items(recs, novelty, k)
        .groupBy(*_BY)
        .agg(_coverage(catalog), _mean_novelty())
    )
    listed = F.explode(F.array(*[F.lit(name) for name in names]))
    every = recs.sparkSession.range(1, numPartitions=1).select(listed.alias("model"))
    measured = every.join(users, "model", "left").join(items, "model", "left")
    return measured.select(
        "model", "precision", "recall", F.coalesce("coverage", F.lit(0.0)).alias("coverage"), "novelty"
    )
