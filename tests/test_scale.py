"""Plans hold at scale: hot keys are split, filters reach the scan, no pair explosion."""

from __future__ import annotations

import re

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

import __spark_entry__ as entry
from basketry.functions.ranking import rank_within, rank_within_large, top_n_per_group
from basketry.operators import candidates as C
from basketry.operators import ranker as K
from basketry.operators import reports as E
from basketry.plans.inputs import Inputs
from basketry.plans.registered import REGISTERED

# Vectors meet as matrix products, which have no built-in expression.
PYTHON = {
    "similar_items",
    "similar_for_items",
    "similar_items_als",
    "personal_als",
    "personal_fixed",
    "recommend_for_users",
    "recommend_fixed",
    "train_als",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    text = plan_of(df)
    cut = text.find("== Initial Plan ==")
    return text if cut < 0 else text[:cut]


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & set(REGISTERED)))
def test_no_cross_join_and_no_python(name, spark, folder):
    plan = plan_of(entry.queries()[name](spark, folder))
    assert "CartesianProduct" not in plan
    # A branch whose property is a constant only asks whether one row of that name is there.
    nested = re.findall(r"BroadcastNestedLoopJoin (.*)", plan)
    assert all(kind.startswith("BuildRight, LeftAnti") for kind in nested)
    assert not nested or name == "clean_item_properties"
    if name not in PYTHON:
        assert not re.search(r"EvalPython|MapInArrow|MapInPandas|FlatMapGroups", plan)


@pytest.fixture
def skewed_session(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_ids(spark, rows, hot):
    """``rows`` rows, a third of which carry the key ``hot``."""
    return spark.range(0, rows, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id") % 997).cast("int").alias("key")
    )


def test_hot_history_item_is_split(skewed_session):
    spark = skewed_session
    history = hot_ids(spark, 40_000, 5).select(
        F.col("id").cast("int").alias("user_id"), F.col("key").alias("source_item_id")
    )
    similar = spark.range(997).select(
        F.col("id").cast("int").alias("itemid"),
        (F.col("id") + 1).cast("int").alias("similar_itemid"),
        F.lit(0.5).cast("float").alias("score"),
        F.lit(1).cast("smallint").alias("rank"),
    )
    features = C.similar_features(history, similar)
    assert "skew=true" in final_plan(features)
    assert features.count() == 40_000


def test_hot_event_item_is_split(skewed_session):
    spark = skewed_session
    events = hot_ids(spark, 40_000, 5).select(
        F.col("id").cast("int").alias("visitorid"), F.col("key").alias("itemid")
    )
    latest = spark.range(900).select(
        F.col("id").cast("int").alias("itemid"), (F.col("id") % 50).cast("short").alias("categoryid")
    )
    joined = E.events_with_category(events, latest)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 40_000


def test_top_n_prunes_before_the_shuffle(spark):
    df = hot_ids(spark, 3_000, 5)
    top = top_n_per_group(df, ["key"], [F.desc("id")], 2)
    plan = plan_of(top)
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert rows_of(top.where("key = 5"), "id") == [(2996,), (2997,)]


def test_large_groups_rank_alike(spark):
    df = hot_ids(spark, 9_000, 5).withColumn("score", (F.col("id") * 7919) % 101)
    order = [F.desc("score"), F.col("id")]
    small = rank_within(df, ["key"], order)
    large = rank_within_large(df, ["key"], order)
    assert rows_of(small) == rows_of(large)


def test_large_group_is_spread_over_partitions(spark):
    df = hot_ids(spark, 40_000, 5)
    ordered = df.repartitionByRange(8, "key", F.desc("id"))
    held = ordered.where("key = 5").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(held) >= 3


def test_window_edges_reach_the_scan(spark, folder):
    inputs = Inputs(spark, folder)
    text = inputs.splits().ranker._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    hosts = re.findall(r"Hosting operator id = (\d+)", text)
    scan = re.search(r"\((\d+)\) Scan parquet", text).group(1)
    assert scan in hosts


def test_only_needed_columns_are_read(spark, folder):
    plan = plan_of(Inputs(spark, folder).bounds())
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_one_property_scans_one_branch(spark, folder):
    """A report on categories reads neither brands nor types."""
    plan = plan_of(E.item_categories(Inputs(spark, folder).item_properties()))
    assert "p_brand" not in plan and "p_type" not in plan and plan.count("FileScan") == 2


def test_candidates_take_one_shuffle_on_pairs(spark, folder):
    plan = final_plan(Inputs(spark, folder).build_candidates())
    pairs = re.findall(r"Exchange hashpartitioning\(user_id#\d+, item_id#\d+, \d+\)", plan)
    # history, similarity features, and the one that merges all sources
    assert len(set(pairs)) <= 3


def test_labelled_groups_take_one_shuffle_of_the_candidates(skewed_session, spark, folder):
    """By user, for the users with positives, the join on pairs and the window alike."""
    x = Inputs(spark, folder)
    plan = plan_of(K.valid_groups(K.label_candidates(x.candidates(), x.positives())))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # candidates; users with positives; positive pairs made distinct, then placed by user
    assert len(exchanges) == 4
    assert sum("item_id" in keys for keys in exchanges) == 1
