"""What the stage tables of the registered queries hold."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from basketry.config import RankerConfig
from basketry.operators import candidates as C
from basketry.operators import evaluation as M
from basketry.operators import generators as R
from basketry.operators import ranker as K
from basketry.plans.inputs import CANDIDATES, SIMILAR_N, Inputs
from basketry.plans.registered import REGISTERED


def test_neighbours_are_of_touched_items_only_and_lose_no_candidate(spark, folder):
    x = Inputs(spark, folder)
    similar = x.similar()
    assert similar.join(x.touched_items(), similar["itemid"] == F.col("id"), "left_anti").isEmpty()
    history = C.user_history(x.shop_events(), x.bounds(), CANDIDATES.history_items)
    every = R.similar_items(x.embeddings(), SIMILAR_N)
    assert every.select("itemid").distinct().count() > similar.select("itemid").distinct().count()
    whole, part = (C.similar_features(history, s, CANDIDATES.similar_top_n) for s in (every, similar))
    keys = ["user_id", "item_id", "similarity_rank", "similarity_sources"]
    assert whole.select(keys).exceptAll(part.select(keys)).isEmpty()
    assert part.select(keys).exceptAll(whole.select(keys)).isEmpty()


def test_stages_take_events_apart_once(spark, folder, monkeypatch):
    plans, stage = {}, Inputs.stage

    def spy(self, name, build):
        rows = build()
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return stage(self, name, lambda: rows)

    monkeypatch.setattr(Inputs, "stage", spy)
    x = Inputs(spark, folder)
    plans["training"] = K.label_candidates(x.candidates(), x.positives())._jdf.queryExecution().toString()
    assert {"interactions", "popular", "personal", "touched", "candidates"} <= set(plans)
    assert [name for name, plan in plans.items() if "get_json_object" in plan] == ["interactions"]


def test_written_interactions_give_the_rows_of_the_events(spark, folder):
    x = Inputs(spark, folder)
    columns = ["timestamp", "user_id", "item_id", "event"]
    for whole, part in ((x.splits().history, x.stage_splits().history), (x.splits().ranker, x.stage_splits().ranker)):
        known = whole.where(F.col("event").isin("view", "addtocart", "transaction")).select(columns)
        assert known.count() == part.count() > 0
        assert known.exceptAll(part).isEmpty()


def test_the_ranker_is_trained_on_written_rows(spark, folder, monkeypatch):
    seen = []
    monkeypatch.setattr("basketry.plans.registered._RANKERS", {})
    train = K.train_ranker

    def spy(rows, *args):
        seen.append(rows)
        return train(rows, RankerConfig(iterations=1, depth=2))

    monkeypatch.setattr(K, "train_ranker", spy)
    for name in ("train_ranker", "train_ranker_grouped", "score_candidates"):
        REGISTERED[name](spark, folder)
    monkeypatch.undo()
    assert len(seen) == 3
    for rows in seen:
        # Neither the labels nor the groups are worked out again by each reader.
        assert not re.search(r"Join|Window|Exchange", rows._jdf.queryExecution().executedPlan().toString())
    x = Inputs(spark, folder)
    whole = K.valid_groups(K.label_candidates(x.candidates(), x.positives()))
    assert whole.exceptAll(seen[0]).isEmpty() and seen[0].exceptAll(whole).isEmpty()


def test_saved_ranker_is_compared_without_a_join(spark, folder, monkeypatch):
    saved = REGISTERED["save_and_load_ranker"](spark, folder)
    assert not re.search(r"Join|Window", final_plan(saved))
    rows = K.valid_groups(K.label_candidates(Inputs(spark, folder).candidates(), Inputs(spark, folder).positives()))
    assert saved.first().asDict() == {"rows": rows.count(), "different": 0}
    # A ranker that is another one is noticed.
    load = K.load_ranker
    other = K.train_ranker(rows, RankerConfig(iterations=1, depth=1, learning_rate=1.0))
    monkeypatch.setattr(K, "load_ranker", lambda path: load(path) and other)
    assert REGISTERED["save_and_load_ranker"](spark, folder).first()["different"] > 0


def test_metrics_read_events_and_properties_once(spark, folder):
    x = Inputs(spark, folder)
    items = x.item_properties().select("itemid").distinct()
    assert items.exceptAll(x.property_items().distinct()).isEmpty()
    assert x.property_items().distinct().exceptAll(items).isEmpty()
    novelty = M.novelty_map(x.shop_events(), spark.createDataFrame(x.bounds().collect(), x.bounds().schema))
    # One scan of the events: the total is a sum over the same exchange.
    assert "ReusedExchange" in final_plan(novelty)
    catalog = final_plan(REGISTERED["catalog_size"](spark, folder))
    assert sum("FileScan" in line and "l_partkey" in line for line in catalog.splitlines()) == 1


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
