"""Second stage: coverage checks, training rows, learned ranker and ranked lists."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.config import RANKER_FEATURES, RankerConfig
from basketry.functions.columns import ratio
from basketry.functions.ranking import rank_within, rank_within_large
from basketry.functions.stats import WIDE_PERCENTILES, describe_counts
from basketry.operators.grouped_ranker import boost, prediction
from basketry.session import cut_lineage

_PAIR = ["user_id", "item_id"]
_BIN = "_bin_{}"
_FLAGS = ("from_als", "from_popular", "from_similar")


def candidate_coverage(positives: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: positive pairs, those among the candidates, and their ratio (0 if none)."""
    return _coverage(positives, candidates, _PAIR, "positives", "found", "coverage")


def _coverage(positives, candidates, keys, total, found, share) -> DataFrame:
    wanted = positives.select(*keys).distinct()
    present = candidates.select(*keys).distinct().withColumn("_found", F.lit(1))
    return (
        wanted.join(present, keys, "left")
        .agg(F.count(F.lit(1)).alias(total), F.count("_found").alias(found))
        .withColumn(share, F.coalesce(ratio(F.col(found), F.col(total)), F.lit(0.0)))
    )


def entity_coverage(positives: DataFrame, candidates: DataFrame) -> DataFrame:
    """Two rows: share of positive users, and of positive items, seen among candidates."""
    rows = [
        _coverage(positives, candidates, [key], "positives", "found", "coverage").select(
            F.lit(entity).alias("entity"), "*"
        )
        for entity, key in (("user", "user_id"), ("item", "item_id"))
    ]
    return rows[0].unionByName(rows[1])


def _found_positives(positives: DataFrame, candidates: DataFrame) -> DataFrame:
    return candidates.select(*_PAIR, *_FLAGS).join(
        positives.select(*_PAIR).distinct(), _PAIR, "left_semi"
    )


def positives_by_source(positives: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: positive pairs found, and how many of them each source knows."""
    return _found_positives(positives, candidates).agg(
        F.count(F.lit(1)).alias("found"),
        *[F.coalesce(F.sum(f), F.lit(0)).cast("bigint").alias(f) for f in _FLAGS],
    )


def positives_by_combination(positives: DataFrame, candidates: DataFrame) -> DataFrame:
    """Positive pairs found per combination of source flags."""
    return (
        _found_positives(positives, candidates)
        .groupBy(*_FLAGS)
        .agg(F.count(F.lit(1)).alias("pairs"))
    )


def _of_users(candidates: DataFrame, users: DataFrame) -> DataFrame:
    return candidates.join(users.select("user_id").distinct(), "user_id", "left_semi")


def candidates_per_user(candidates: DataFrame, users: DataFrame) -> DataFrame:
    """Number of candidates of the given users, described over the users."""
    counts = _of_users(candidates.select("user_id"), users).groupBy("user_id").count()
    return describe_counts(counts, "count", WIDE_PERCENTILES)


def source_counts_per_user(candidates: DataFrame, users: DataFrame) -> DataFrame:
    """Candidates per user in total and per source flag, each described over the users."""
    counts = (
        _of_users(candidates.select("user_id", *_FLAGS), users)
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total_candidates"),
            F.sum("from_als").alias("als_candidates"),
            F.sum("from_popular").alias("popular_candidates"),
            F.sum("from_similar").alias("similar_candidates"),
        )
    )
    long = counts.unpivot(
        "user_id",
        ["total_candidates", "als_candidates", "popular_candidates", "similar_candidates"],
        "metric",
        "_value",
    )
    return describe_counts(long, "_value", WIDE_PERCENTILES, by=["metric"])


def audit_als_flag(
    candidates: DataFrame, personal_als: DataFrame, users: DataFrame | None = None
) -> DataFrame:
    """One row: candidates truly proposed by the factorisation against the flag."""
    if users is not None:
        candidates = _of_users(candidates, users)
    real = (
        personal_als.select(F.col("visitorid").alias("user_id"), F.col("itemid").alias("item_id"))
        .distinct()
        .withColumn("_real", F.lit(1))
    )
    return (
        candidates.select(*_PAIR, "from_als")
        .join(real, _PAIR, "left")
        .agg(
            F.count(F.lit(1)).alias("candidates"),
            F.count("_real").alias("real_from_als"),
            F.coalesce(F.sum("from_als"), F.lit(0)).cast("bigint").alias("from_als"),
            F.count_if(F.coalesce(F.col("_real"), F.lit(0)) != F.col("from_als")).alias(
                "mismatches"
            ),
        )
    )


def label_candidates(candidates: DataFrame, positives: DataFrame) -> DataFrame:
    """Candidates of users with a positive pair, with ``target`` 1 where the pair is one.

    Positives are made distinct, so the join never multiplies candidates.
    """
    positives = positives.select(*_PAIR).distinct()
    return (
        _of_users(candidates, positives)
        .join(positives.withColumn("_positive", F.lit(1)), _PAIR, "left")
        .select(
            *candidates.columns,
            F.coalesce(F.col("_positive"), F.lit(0)).cast("byte").alias("target"),
        )
    )


def valid_groups(train: DataFrame) -> DataFrame:
    """Rows of users with at least one positive and at least one negative.

    A window over the user, which labelled candidates are placed by already.
    """
    user = Window.partitionBy("user_id")
    return (
        train.withColumn("_best", F.max("target").over(user))
        .withColumn("_worst", F.min("target").over(user))
        .where("_best = 1 AND _worst = 0")
        .select(train.columns)
    )


def order_groups(train: DataFrame) -> DataFrame:
    """Rows sorted by user, then by factorisation rank with missing ranks last.

    A global sort is a range partitioning on the whole key: each user's rows stay together
    in order, and a very large user is spread over several partitions.
    """
    return train.orderBy("user_id", F.asc_nulls_last("als_rank"), "item_id")


def ranker_train_stats(train: DataFrame) -> DataFrame:
    """One row: rows, users, positive rows and their share."""
    positive = F.count_if(F.col("target") == 1)
    rows = F.count(F.lit(1))
    return train.agg(
        rows.alias("rows"),
        F.countDistinct("user_id").alias("users"),
        positive.alias("positives"),
        ratio(positive, rows).alias("positive_share"),
    )


def require_features(df: DataFrame, features: Sequence[str] = RANKER_FEATURES) -> DataFrame:
    """``df`` unchanged if it has every feature column."""
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    return df


def _binning(train: DataFrame, features: Sequence[str], bins: int) -> PipelineModel:
    """Every feature to one of at most ``bins`` quantile bins, null to a bin of its own."""
    shares = [i / bins for i in range(1, bins)]
    cuts = train.select(*[F.col(f).cast("double") for f in features]).approxQuantile(
        list(features), shares, 0.2 / bins
    )
    numbers = [f"COALESCE(CAST({f} AS DOUBLE), DOUBLE('NaN')) AS _x_{f}" for f in features]
    # A sum is a plain ordered number again; the bin itself would be taken for a category.
    ordered = [f"_b_{f} + 0.0D AS {_BIN.format(f)}" for f in features]
    stages = [
        SQLTransformer(statement=f"SELECT *, {', '.join(numbers)} FROM __THIS__"),
        Bucketizer(
            inputCols=[f"_x_{f}" for f in features],
            outputCols=[f"_b_{f}" for f in features],
            # A feature nobody has leaves no cut; any one will do.
            splitsArray=[[-math.inf, *(sorted(set(c)) or [0.0]), math.inf] for c in cuts],
            handleInvalid="keep",
        ),
        SQLTransformer(statement=f"SELECT *, {', '.join(ordered)} FROM __THIS__"),
    ]
    return PipelineModel(stages)


def train_ranker(train: DataFrame, config: RankerConfig = RankerConfig()) -> PipelineModel:
    """Boosted trees on the candidate features, every user weighing the same.

    With the grouped loss see ``_boost_groups``; the rest is the pointwise one.  A row's
    weight is one over the number of rows of its user, so that users with many candidates do
    not drown the others.  A missing value says which source knows a pair: it gets a bin of
    its own.

    Boosting reads its input hundreds of times.  Trees only see bins, so rows with equal
    bins and label are first merged and their weights added.  What is read again and again
    is that table, checkpointed once, and it stops growing long before the rows do.
    """
    require_features(train, config.features)
    if config.loss == "grouped":
        return _boost_groups(train, config)
    if config.loss != "pointwise":
        raise ValueError(f"unknown loss: {config.loss}")
    sizes = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("_size"))
    weighted = train.join(sizes, "user_id").select(
        *config.features,
        F.col("target").cast("double").alias("_label"),
        (F.lit(1.0) / F.col("_size")).alias("_weight"),
    )
    binning = _binning(train, config.features, config.bins)
    columns = [_BIN.format(f) for f in config.features]
    merged = (
        binning.transform(weighted)
        .groupBy(*columns, "_label")
        .agg(F.sum("_weight").alias("_weight"))
    )
    trees = GBTClassifier(
        featuresCol="_features",
        labelCol="_label",
        weightCol="_weight",
        maxIter=config.iterations,
        maxDepth=config.depth,
        stepSize=config.learning_rate,
        maxBins=config.bins + 2,
        seed=config.seed,
        checkpointInterval=10,
    )
    assembler = VectorAssembler(inputCols=columns, outputCol="_features")
    boosted = Pipeline(stages=[assembler, trees]).fit(cut_lineage(merged))
    return PipelineModel([*binning.stages, *boosted.stages])


def _boost_groups(train: DataFrame, config: RankerConfig) -> PipelineModel:
    """Boosted trees on the order within users, as an expression over the bins (see
    ``grouped_ranker``)."""
    binning = _binning(train, config.features, config.bins)
    columns = [_BIN.format(f) for f in config.features]
    trees = boost(
        binning.transform(train).select("user_id", "target", *columns),
        columns,
        config.bins + 1,  # the last one is null's
        config.iterations,
        config.depth,
        config.learning_rate,
        config.seed,
    )
    total = prediction(trees, columns, config.learning_rate)
    scoring = SQLTransformer(statement=f"SELECT *, {total} AS prediction FROM __THIS__")
    return PipelineModel([*binning.stages, scoring])


def score_candidates(
    model: Model, candidates: DataFrame, features: Sequence[str] = RANKER_FEATURES
) -> DataFrame:
    """Every candidate with its score: the margin of the trees, higher is better."""
    scored = model.transform(require_features(candidates, features))
    margin = F.col("prediction")
    if "rawPrediction" in scored.columns:
        margin = vector_to_array("rawPrediction")[1]
    return scored.select(*candidates.columns, margin.cast("float").alias("score"))


def rank_recommendations(scored: DataFrame, large_users: bool = False) -> DataFrame:
    """Every scored pair with its rank inside the user, best score first, ties by item.

    A user has at most as many rows as the generators propose (see ``CandidateConfig``), so
    one shuffle on the user is enough.  ``large_users`` ranks tables without that bound:
    a user is then spread over many tasks.
    """
    rank = rank_within_large if large_users else rank_within
    pairs = scored.select(*_PAIR, "score")
    ranked = rank(pairs, ["user_id"], [F.desc_nulls_last("score"), F.col("item_id")])
    return ranked.select(*_PAIR, "score", F.col("rank").cast("int"))


def save_ranker(model: PipelineModel, path: str) -> str:
    """Save under a path that must not exist yet: a crash never leaves half a ranker in
    place of a whole one."""
    model.write().save(path)
    return path


def load_ranker(path: str) -> PipelineModel:
    return PipelineModel.load(path)
