"""Numbers of ids over several appends."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

import pytest

from basketry.operators import splits as S
from basketry.sources import dictionary as D
from basketry.sources import tables as T


def batch(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id long")


def numbers(df):
    return {r["user_id"]: r["index"] for r in df.collect()}


def test_numbers_stay_and_new_ids_get_the_next(spark, tmp_path):
    uri = str(tmp_path / "users")
    first = numbers(D.append_ids(batch(spark, [30, 10, None, 10]), "user_id", uri))
    assert first == {10: 0, 30: 1}
    second = numbers(D.append_ids(batch(spark, [5, 30, 20]), "user_id", uri))
    assert second == first | {5: 2, 20: 3}
    # A repeated batch, and one without ids, add nothing, not even an entry.
    again = D.append_ids(batch(spark, [5, 30, 20]), "user_id", uri)
    assert numbers(again) == second == numbers(D.append_ids(batch(spark, [None]), "user_id", uri))
    assert len(T._numbers(spark, uri)) == 2
    third = D.append_ids(batch(spark, [7, 1]), "user_id", uri)
    assert numbers(third) == second | {1: 4, 7: 5} == numbers(D.read_dictionary(spark, uri))
    # Encoding and decoding with it.
    rows = batch(spark, [7, 10, 7])
    coded = S.apply_encoding(rows, third, "user_id")
    assert sorted(r["index"] for r in coded.collect()) == [0, 5, 5]
    assert sorted(r["user_id"] for r in S.decode_ids(coded, third, "user_id").collect()) == [7, 7, 10]


def test_a_writer_that_was_overtaken_numbers_again(spark, tmp_path, monkeypatch):
    uri = str(tmp_path / "users")
    D.append_ids(batch(spark, [1, 2]), "user_id", uri)
    put = T._put_if_absent

    def overtaken(session, path, text):
        monkeypatch.setattr(T, "_put_if_absent", put)
        D.append_ids(batch(spark, [3, 9]), "user_id", uri)
        assert json.loads(text)["first"] == 2
        return put(session, path, text)

    monkeypatch.setattr(T, "_put_if_absent", overtaken)
    found = numbers(D.append_ids(batch(spark, [2, 3, 4]), "user_id", uri))
    assert found == {1: 0, 2: 1, 3: 2, 9: 3, 4: 4}


def test_writers_at_the_same_time_and_lost_ones(spark, tmp_path):
    uri = str(tmp_path / "users")
    # Written and never committed, as after a crash.
    spark.createDataFrame([(99, 0)], "user_id long, index long").write.parquet(T.new_version(spark, uri))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: D.append_ids(batch(spark, range(5 * k, 5 * k + 10)), "user_id", uri), range(4)))
    found = numbers(D.read_dictionary(spark, uri))
    assert sorted(found) == list(range(25)) and sorted(found.values()) == list(range(25))


def test_an_empty_start_and_another_type(spark, tmp_path):
    uri = str(tmp_path / "users")
    with pytest.raises(FileNotFoundError):
        D.read_dictionary(spark, uri)
    assert D.append_ids(batch(spark, []), "user_id", uri).count() == 0
    assert numbers(D.append_ids(batch(spark, [4]), "user_id", uri)) == {4: 0}
    with pytest.raises(TypeError):
        D.append_ids(spark.createDataFrame([("a",)], "user_id string"), "user_id", uri)
