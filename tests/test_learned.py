"""Invariants of the learned parts."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from basketry.config import AlsConfig, RankerConfig
from basketry.operators import evaluation as M
from basketry.operators import generators as R
from basketry.operators import grouped_ranker as G
from basketry.operators import ranker as K

SHORT = AlsConfig(factors=6, iterations=6)


@pytest.fixture(scope="module")
def planted(spark):
    """Users and items in four groups; users interact inside their group only."""
    users = spark.range(80).select(F.col("id").cast("int").alias("user_id"))
    pairs = users.select("user_id", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("item_id"))
    pairs = pairs.where("user_id % 4 = item_id % 4").withColumn(
        "draw", F.pmod(F.xxhash64("user_id", "item_id"), F.lit(10))
    )
    train = pairs.where("draw < 6").select("user_id", "item_id", F.lit(1.0).alias("weight"))
    truth = pairs.where("draw >= 6").select("user_id", "item_id")
    return train.cache(), truth.cache()


@pytest.fixture(scope="module")
def model(planted):
    return R.train_als(planted[0], SHORT)


def test_ranks_have_no_gaps_and_scores_fall(model):
    recs = R.personal_als(model, 7)
    assert recs.count() == 80 * 7
    assert recs.select("visitorid", "itemid").distinct().count() == 80 * 7
    lists = recs.groupBy("visitorid").agg(
        F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("rows")
    )
    for row in lists.collect():
        assert [r["rank"] for r in row["rows"]] == list(range(1, 8))
        scores = [r["score"] for r in row["rows"]]
        assert scores == sorted(scores, reverse=True)


def test_more_than_the_catalog_gives_the_catalog(model):
    assert R.personal_als(model, 500).where("visitorid = 3").count() == 40


@pytest.mark.parametrize("block_rows", [4096, 13])
def test_lists_equal_the_built_in_ones(model, block_rows):
    mine = R.personal_als(model, 10, block_rows=block_rows).select(
        F.col("visitorid").alias("user_id"), F.col("rank").alias("place"), "itemid", "score"
    )
    built_in = model.recommendForAllUsers(10).select(
        "user_id", F.posexplode("recommendations").alias("at", "rec")
    ).select("user_id", (F.col("at") + 1).cast("short").alias("place"), "rec.item_id", "rec.rating")
    both = mine.join(built_in, ["user_id", "place"])
    assert both.count() == 80 * 10
    assert both.where("abs(score - rating) > 1e-5").count() == 0
    # Scores are equal where items are not: ties and the last bit of a 32-bit sum.
    other = both.where("itemid <> item_id")
    assert other.where("abs(score - rating) > 1e-6").count() == 0
    items = mine.join(built_in, (mine["user_id"] == built_in["user_id"]) & (mine["itemid"] == built_in["item_id"]))
    assert items.count() >= 80 * 10 - other.count()


def test_factors_have_as_many_blocks_as_asked(planted, spark):
    for blocks in (3, None):
        made = R.train_als(planted[0], AlsConfig(factors=2, iterations=1, blocks=blocks))
        expected = blocks or spark.sparkContext.defaultParallelism
        assert made.userFactors.rdd.getNumPartitions() == expected
        assert made.itemFactors.rdd.getNumPartitions() == expected


def test_user_subset_equals_full_lists(model, spark):
    users = spark.createDataFrame([(3,), (3,), (7,), (12345,)], "user_id int")
    some = R.recommend_for_users(model, users, 5)
    every = R.personal_als(model, 5).where("visitorid IN (3, 7)")
    assert rows_of(some) == rows_of(every)


def test_factorisation_beats_popularity(model, planted, spark):
    train, truth = planted
    users = truth.select("user_id").distinct()
    popular = (
        train.groupBy("item_id").count().orderBy(F.desc("count"), "item_id").limit(20)
        .select(F.col("item_id").alias("itemid"), F.col("count").alias("score"))
    )
    popular = spark.createDataFrame(
        [(r["itemid"], r["score"], i) for i, r in enumerate(popular.collect(), 1)],
        "itemid int, score bigint, rank int",
    )
    catalog = spark.createDataFrame([(40,)], "catalog_size bigint")
    novelty = spark.createDataFrame([], "item_id int, novelty double")
    als = R.personal_als(model, 10)
    rows = M.compare_models(
        {"popular": M.popular_as_recs(popular, users), "als": M.recs_for_eval(als, users)},
        truth, catalog, novelty,
    )
    recall = {r["model"]: r["recall"] for r in rows.collect()}
    assert recall["als"] > 2 * recall["popular"]


def test_loss_equals_the_sum_over_all_pairs(model, planted):
    train, _ = planted
    x = {r["id"]: r["features"] for r in model.userFactors.collect()}
    y = {r["id"]: r["features"] for r in model.itemFactors.collect()}
    seen = {(r["user_id"], r["item_id"]): r["weight"] for r in train.collect()}
    total = 0.0
    for u, xu in x.items():
        for i, yi in y.items():
            p = sum(a * b for a, b in zip(xu, yi))
            w = seen.get((u, i))
            total += p * p if w is None else (1 + SHORT.alpha * w) * (1 - p) ** 2
    row = R.als_training_loss(model, train, SHORT).first()
    assert row["pairs"] == len(seen)
    assert row["squared_error"] == pytest.approx(total, rel=1e-4)


def test_items_are_not_similar_to_themselves(model):
    similar = R.similar_items(model.itemFactors, 9)
    assert similar.where("itemid = similar_itemid").count() == 0
    assert similar.count() == 40 * 9
    inside = similar.where("itemid % 4 = similar_itemid % 4").count()
    assert inside > 0.9 * similar.count()


@pytest.fixture(scope="module")
def candidates(spark):
    """The better the factorisation rank, the likelier a positive; popularity is noise."""
    rows = spark.range(40).select(F.col("id").cast("int").alias("user_id")).select(
        "user_id", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("item_id")
    )
    draw = F.pmod(F.xxhash64("user_id", "item_id"), F.lit(20))
    known = F.col("item_id") <= 15
    return rows.select(
        "user_id",
        "item_id",
        F.when(known, 1.0 / F.col("item_id")).cast("float").alias("als_score"),
        F.when(known, F.col("item_id")).cast("short").alias("als_rank"),
        F.when(draw > 10, draw).cast("float").alias("popular_score"),
        F.when(draw > 10, draw).cast("short").alias("popular_rank"),
        F.lit(None).cast("float").alias("similarity_score"),
        F.lit(None).cast("short").alias("similarity_rank"),
        (known & (F.col("item_id") <= 1 + draw / 3)).cast("byte").alias("target"),
    ).cache()


@pytest.fixture(scope="module")
def ranker(candidates):
    return K.train_ranker(candidates, RankerConfig(iterations=6, depth=3, learning_rate=0.3))


def test_ranker_prefers_good_ranks_and_takes_nulls(ranker, candidates):
    scored = K.score_candidates(ranker, candidates)
    assert scored.count() == candidates.count()
    assert scored.where("score IS NULL").count() == 0
    mean = {r["target"]: r["m"] for r in scored.groupBy("target").agg(F.avg("score").alias("m")).collect()}
    assert mean[1] > mean[0]
    unknown = scored.where("als_rank IS NULL").agg(F.avg("score")).first()[0]
    assert unknown < mean[1]


def test_saved_ranker_scores_alike(ranker, candidates, tmp_path):
    path = K.save_ranker(ranker, str(tmp_path / "ranker"))
    again = K.score_candidates(K.load_ranker(path), candidates)
    assert rows_of(again, "user_id", "item_id", "score") == rows_of(
        K.score_candidates(ranker, candidates), "user_id", "item_id", "score"
    )


def test_scoring_needs_every_feature(ranker, candidates):
    with pytest.raises(ValueError, match="popular_rank"):
        K.score_candidates(ranker, candidates.drop("popular_rank"))


@pytest.fixture(scope="module")
def confounded(spark):
    """Popularity tells users with many positives from others and nothing within a user;
    the rank within a user is what counts."""
    rows = spark.range(60).select(F.col("id").cast("int").alias("user_id")).select(
        "user_id", F.explode(F.sequence(F.lit(1), F.lit(16))).alias("item_id")
    )
    noise = F.pmod(F.xxhash64("user_id", "item_id", F.lit(5)), F.lit(100))
    rich = F.col("user_id") % 2 == 0
    odds = F.when(rich, 75).otherwise(8) - 4 * F.col("item_id") + F.when(rich, 20).otherwise(30)
    return rows.select(
        "user_id",
        "item_id",
        F.lit(None).cast("float").alias("als_score"),
        F.col("item_id").cast("short").alias("als_rank"),
        (F.when(rich, 50).otherwise(10) + noise / 10).cast("float").alias("popular_score"),
        F.lit(None).cast("short").alias("popular_rank"),
        F.lit(None).cast("float").alias("similarity_score"),
        F.lit(None).cast("short").alias("similarity_rank"),
        (noise < odds).cast("byte").alias("target"),
    ).cache()


def mean_ndcg(scored, k=10):
    import math
    from collections import defaultdict

    users = defaultdict(list)
    for r in scored.collect():
        users[r["user_id"]].append((-r["score"], r["item_id"], r["target"]))
    total = []
    for rows in users.values():
        gains = [t for _, _, t in sorted(rows)]
        best = sorted(gains, reverse=True)
        if sum(gains):
            ideal = sum(g / math.log2(p + 2) for p, g in enumerate(best[:k]))
            total.append(sum(g / math.log2(p + 2) for p, g in enumerate(gains[:k])) / ideal)
    return sum(total) / len(total)


def test_grouped_loss_orders_within_users(confounded, tmp_path):
    sizes = {"iterations": 8, "depth": 3, "learning_rate": 0.3, "bins": 32}
    scores = {}
    for loss in ("pointwise", "grouped"):
        model = K.train_ranker(confounded, RankerConfig(loss=loss, **sizes))
        scores[loss] = mean_ndcg(K.score_candidates(model, confounded))
    assert scores["grouped"] > scores["pointwise"]
    path = K.save_ranker(model, str(tmp_path / "grouped"))
    again = K.score_candidates(K.load_ranker(path), confounded)
    assert rows_of(again, "user_id", "item_id", "score") == rows_of(
        K.score_candidates(model, confounded), "user_id", "item_id", "score"
    )
    with pytest.raises(ValueError, match="unknown loss"):
        K.train_ranker(confounded, RankerConfig(loss="x"))


def test_order_gradients_equal_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    sizes = np.array([5, 4, 1])
    y = np.array([1, 0, 0, 1, 0, 0, 1, 1, 0, 1])
    score = rng.normal(size=10)
    noises = [G.noise(np.array([7, 8, 9], np.uint64), sizes, seed) for seed in range(3)]
    got = G.order_gradients(score, y, sizes, noises)
    g, h = np.zeros(10), np.zeros(10)
    for around in noises:
        for lo, hi in ((0, 5), (5, 9), (9, 10)):
            order = sorted(range(lo, hi), key=lambda k: -(score + around)[k])
            worth = {k: 1 / np.log2(place + 2) for place, k in enumerate(order)}
            best = sum(1 / np.log2(k + 2) for k in range(int(y[lo:hi].sum())))
            for a in range(lo, hi):
                for b in range(lo, hi):
                    if y[a] > y[b]:
                        p = 1 / (1 + np.exp(score[a] - score[b]))
                        w = abs(worth[a] - worth[b]) / best / len(noises)
                        g[a] += w * p
                        g[b] -= w * p
                        h[a] += w * p * (1 - p)
                        h[b] += w * p * (1 - p)
    assert np.allclose(got, (g, h))
    alone = G.noise(np.array([8], np.uint64), np.array([4]), 1)
    assert np.array_equal(alone, noises[1][5:9])  # whatever users stand beside


def test_symmetric_split_equals_a_plain_search():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 4, (200, 3)).astype(np.uint16)
    g, h = rng.normal(size=200), rng.random(200)
    made = ((1, 2), (0, 0))
    leaf = G.leaves(x, made)
    best = max(
        (
            sum(
                g[m].sum() ** 2 / (h[m].sum() + 0.5)
                for k in range(4)
                for m in ((leaf == k) & (x[:, f] <= t), (leaf == k) & (x[:, f] > t))
            ),
            (f, t),
        )
        for f in range(3)
        for t in range(3)
    )
    assert G.best_split(G.histogram(x, g, h, made, 4), 0.5) == best[1]
    assert G.best_split(np.zeros((2, 1, 3, 4)), 0.5) is None


def test_grouped_trees_do_not_depend_on_tasks(confounded, monkeypatch):
    config = RankerConfig(loss="grouped", iterations=4, depth=3, learning_rate=0.3, bins=16)
    one = K.train_ranker(confounded, config).stages[-1].getStatement()
    monkeypatch.setattr(G, "CHUNK_ROWS", 50)
    monkeypatch.setattr(G, "REWRITE", 2)
    monkeypatch.setattr(G, "FAN_IN", 2)
    other = K.train_ranker(confounded.repartition(5), config).stages[-1].getStatement()
    assert [p.split("array(")[0] for p in one.split("+ IF(")] == [
        p.split("array(")[0] for p in other.split("+ IF(")
    ]
    nothing = K.train_ranker(confounded.where("target = 0"), config)
    assert K.score_candidates(nothing, confounded).where("score <> 0").isEmpty()
