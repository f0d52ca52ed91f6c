"""The whole batch run on the given tables, from CSV to metrics."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry import schemas
from basketry.config import AlsConfig, CandidateConfig, GeneratorConfig, RankerConfig
from basketry.plans.inputs import Inputs
from basketry.plans.stages import Settings, Stages

SETTINGS = Settings(
    als=AlsConfig(factors=8, iterations=4),
    generators=GeneratorConfig(top_n=15, similar_n=8),
    candidates=CandidateConfig(history_items=5, similar_top_n=5, popular_top_n=5),
    ranker=RankerConfig(iterations=3, depth=3),
)


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    inputs = Inputs(spark, folder)
    first, changes = inputs.raw_property_parts()
    raw = {
        "events": inputs.raw_events(),
        "first": first,
        "changes": changes,
        "tree": inputs.raw_category_tree(),
    }
    for name, df in raw.items():
        df.write.option("header", True).csv(str(base / "csv" / name))
    run = Stages(spark, str(base / "tables"), SETTINGS)
    csv = base / "csv"
    quality = run.clean(
        str(csv / "events"), [str(csv / "first"), str(csv / "changes")], str(csv / "tree")
    )
    assert {r["dataset"] for r in quality.collect()} == {"events", "item_properties", "category_tree"}
    for stage in (run.generate, run.assemble, run.rank):
        assert stage().count() == 1
    return run


def test_published_tables_have_their_schemas(stages):
    for name, schema in (
        ("events", schemas.EVENTS),
        ("item_properties", schemas.ITEM_PROPERTIES),
        ("category_tree", schemas.CATEGORY_TREE),
        ("top_popular", schemas.TOP_POPULAR),
        ("personal_als", schemas.PERSONAL_ALS),
        ("similar", schemas.SIMILAR),
        ("candidates", schemas.CANDIDATES),
        ("recommendations", schemas.RECOMMENDATIONS),
    ):
        schemas.require_schema(stages.read(name), schema)


def test_constant_property_is_gone(stages):
    assert stages.read("item_properties").where("property = '159'").count() == 0


def test_every_candidate_is_ranked_once(stages):
    recs = stages.read("recommendations")
    assert recs.count() == stages.read("candidates").count()
    window = Window.partitionBy("user_id").orderBy("rank")
    broken = recs.select(
        "rank",
        F.row_number().over(window).alias("place"),
        "score",
        F.lag("score").over(window).alias("better"),
    ).where("rank <> place OR score > better")
    assert broken.count() == 0


def test_served_lists_hold_nothing_bought(stages):
    histogram = dict(stages.serve().collect())
    served = stages.read("served")
    bought = stages.read("events").where("event = 'transaction'").select(
        F.col("visitorid").alias("user_id"), F.col("itemid").alias("item_id")
    )
    assert served.count() == histogram["+Inf"] > 0
    assert served.join(bought, ["user_id", "item_id"], "left_semi").count() == 0
    assert served.agg(F.max("rank")).first()[0] <= 10


def test_metrics_are_given_for_every_model(stages):
    rows = {r["model"]: r for r in stages.evaluate().collect()}
    assert set(rows) == {"Top Popular", "ALS", "Final Ranker"}
    for row in rows.values():
        assert 0 <= row["precision"] <= 1 and 0 <= row["recall"] <= 1 and row["novelty"] > 0


def test_settings_come_from_file_and_command_line(tmp_path):
    from basketry.jobs.run_stage import read_settings

    path = tmp_path / "settings.json"
    path.write_text('{"als": {"factors": 8, "alpha": 2.0}, "serving": {"top_k": 3}}')
    settings = read_settings(str(path), ["als.factors=9", "split.ranker_days=2"])
    assert (settings.als.factors, settings.als.alpha, settings.serving.top_k) == (9, 2.0, 3)
    assert settings.split.ranker_days == 2 and settings.als.iterations == AlsConfig().iterations
    for bad in (["als.speed=1"], ["cheese.x=1"]):
        with pytest.raises(ValueError, match="unknown"):
            read_settings(None, bad)
    with pytest.raises(ValueError, match="form"):
        read_settings(None, ["als"])


def test_job_starts_from_another_folder(tmp_path):
    import os
    import subprocess
    import sys
    from pathlib import Path

    script = Path(__file__).resolve().parents[1] / "basketry" / "jobs" / "run_stage.py"
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(script), "--help"], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0 and "--settings" in done.stdout, done.stderr


def test_windows_stay_when_events_come_later(stages):
    before = stages.read("bounds").first()
    assert stages.read("bounds").count() == 1
    assert before["ranker_start"] < before["evaluation_start"] < before["data_end"]
    assert stages._bounds().first() == before
