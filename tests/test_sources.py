"""Conversion, pruned reads, gates and publication."""

from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from basketry import schemas
from basketry.sources import tables as T


@pytest.fixture
def events(frame):
    return frame(
        [(1, 10, "view", 5, None), (2, 10, "transaction", 5, 77)], schemas.RAW_EVENTS
    )


def test_csv_round_trip_keeps_nulls(spark, events, tmp_path):
    csv, parquet = str(tmp_path / "csv"), str(tmp_path / "parquet")
    events.write.option("header", True).csv(csv)
    converted = T.csv_to_parquet(spark, csv, parquet, schemas.RAW_EVENTS)
    assert rows_of(converted) == rows_of(events)
    assert any(p.name.endswith(".snappy.parquet") for p in (tmp_path / "parquet").iterdir())


def test_bad_csv_row_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("timestamp,visitorid,event,itemid,transactionid\nx,1,view,1,\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        T.read_csv(spark, str(tmp_path / "bad.csv"), schemas.RAW_EVENTS).collect()


def test_wrong_csv_header_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("time,visitorid,event,itemid,transactionid\n1,1,view,1,\n")
    with pytest.raises(Exception, match="header"):
        T.read_csv(spark, str(tmp_path / "bad.csv"), schemas.RAW_EVENTS).collect()


def test_read_checks_prunes_and_filters(spark, frame, tmp_path):
    path = str(tmp_path / "popular")
    frame([(1, 9, 1), (2, 8, 2)], schemas.TOP_POPULAR).write.parquet(path)
    best = T.read_dataset(spark, path, schemas.TOP_POPULAR, ["itemid"], F.col("rank") <= 1)
    assert rows_of(best) == [(1,)]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(rank,1)" in plan and "score" not in plan.split("ReadSchema")[1]
    with pytest.raises(ValueError, match="schema mismatch"):
        T.read_dataset(spark, path, schemas.SIMILAR)


def test_gate_names_the_small_dataset(events):
    assert rows_of(T.validate_outputs({"events": events})) == [("events", 2)]
    with pytest.raises(ValueError, match="empty"):
        T.validate_outputs({"events": events, "empty": events.limit(0)})


def test_publication_switches_versions(spark, events, tmp_path):
    uri = str(tmp_path / "events")
    with pytest.raises(FileNotFoundError):
        T.read_published(spark, uri)
    T.publish_dataset(events.limit(1), uri)
    first = T.published_version(spark, uri)
    T.publish_dataset(events, uri)
    assert T.published_version(spark, uri) > first
    assert rows_of(T.read_published(spark, uri, schemas.RAW_EVENTS)) == rows_of(events)
    # A failed publication leaves the current version in place.
    with pytest.raises(ValueError):
        T.publish_dataset(events.limit(0), uri)
    assert T.read_published(spark, uri).count() == 2
    # The failed version is gone; a reader of the version before the current one can finish.
    assert len(list((tmp_path / "events" / "versions").iterdir())) == 2
    reader = T.read_published(spark, uri)
    T.publish_dataset(events.limit(1), uri, drop_previous=True, keep=2)
    assert reader.count() == 2
    assert len(list((tmp_path / "events" / "versions").iterdir())) == 2
    with pytest.raises(ValueError, match="must be kept"):
        T.drop_versions(spark, uri, 0)


def test_a_clock_that_goes_back_hides_nothing(spark, events, tmp_path, monkeypatch):
    import time

    uri = str(tmp_path / "events")
    T.publish_dataset(events.limit(1), uri)
    monkeypatch.setattr(time, "time_ns", lambda: 0)
    monkeypatch.setattr(time, "time", lambda: 0.0)
    T.publish_dataset(events, uri)
    assert T.read_published(spark, uri).count() == 2


def test_layout_gives_files_ranges_that_do_not_overlap(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(5000).selectExpr("(id * 7919) % 5000 AS t", "id % 3 AS kind")
    # Otherwise so few rows are merged into one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        T.publish_dataset(df, str(tmp_path / "t"), layout=["t"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ranges = []
    for path in (tmp_path / "t" / "versions").glob("*/part-*"):
        meta = pq.ParquetFile(path).metadata
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(0).statistics
            ranges.append((stats.min, stats.max))
    assert len(ranges) > 1
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_sizes_come_from_the_files(spark, events, tmp_path):
    path = tmp_path / "parquet"
    events.coalesce(1).write.parquet(str(path))
    size = sum(p.stat().st_size for p in path.iterdir() if p.name.startswith("part-"))
    assert tuple(T.dataset_bytes(spark, str(path)).first()) == (1, size)


def test_interleaved_writers_both_get_an_entry(spark, events, tmp_path, monkeypatch):
    uri = str(tmp_path / "events")
    T.publish_dataset(events, uri)
    slow = T.new_version(spark, uri)
    events.limit(1).write.parquet(slow)
    # Written, but not committed: as after a crash, readers keep the old version.
    assert T.read_published(spark, uri).count() == 2
    T.publish_dataset(events.unionAll(events), uri)
    # The slow writer looked at the log before the other one committed.
    seen, numbers = [[1]], T._numbers
    monkeypatch.setattr(T, "_numbers", lambda s, u: seen.pop() if seen else numbers(s, u))
    assert T.point_to(spark, uri, slow, 1) == 3
    assert T.published_path(spark, uri) == slow
    assert [T._read_entry(spark, f"{uri}/log/{k:012d}")["rows"] for k in (1, 2, 3)] == [2, 4, 1]


def test_writers_at_the_same_time(spark, events, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    uri = str(tmp_path / "events")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: T.publish_dataset(events.limit(1 + k % 2), uri), range(6)))
    assert sorted(T._numbers(spark, uri)) == [1, 2, 3, 4, 5, 6]
    versions = {T._read_entry(spark, f"{uri}/log/{k:012d}")["version"] for k in range(1, 7)}
    assert len(versions) == 6 and T.published_version(spark, uri) in versions
    assert not [p for p in (tmp_path / "events" / "log").iterdir() if p.name.startswith(".") and p.suffix != ".crc"]
