"""Item similarity against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import generators as R


def brute_force(ids, vectors, n):
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors / np.where(norms == 0, 1, norms)
    scores = (unit @ unit.T).astype(np.float32)
    found = set()
    for i, item in enumerate(ids):
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-scores[i, j], ids[j]))
        for rank, j in enumerate(order[:n], start=1):
            found.add((item, ids[j], rank))
    return found


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    values = rng.normal(size=(60, 8)).astype(np.float32)
    values[10:30] = values[10]  # a third of the items are copies of one
    values[40] = 0.0
    ids = [int(i) for i in rng.permutation(1000)[:60]]
    return ids, values


@pytest.mark.parametrize("block_rows,n", [(1000, 5), (7, 5), (7, 2), (16, 40), (13, 100)])
def test_same_as_brute_force(spark, vectors, block_rows, n):
    ids, values = vectors
    df = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in zip(ids, values)], "id int, features array<float>"
    )
    got = R.similar_items(df, n, block_rows=block_rows, task_blocks=2).collect()
    found = {(r["itemid"], r["similar_itemid"], r["rank"]) for r in got}
    assert len(found) == len(got)
    assert found == brute_force(ids, values.astype(np.float64), n)


def test_subset_has_the_same_neighbours(spark, vectors):
    ids, values = vectors
    df = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in zip(ids, values)], "id int, features array<float>"
    )
    wanted = spark.createDataFrame([(ids[3],), (ids[12],), (12345,)], "id int")
    some = set(map(tuple, R.similar_for_items(df, wanted, 6, block_rows=11).collect()))
    every = set(map(tuple, R.similar_items(df, 6).where(f"itemid IN ({ids[3]}, {ids[12]})").collect()))
    assert some == every and len(some) == 12


def lists_by_hand(users, items, n):
    scores = (users.astype(np.float64) @ items.astype(np.float64).T).astype(np.float32)
    return [sorted(range(len(items)), key=lambda j: (-row[j], j))[:n] for row in scores]


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e-6, 1e6])
def test_scaling_a_user_changes_no_list(spark, scale):
    rng = np.random.default_rng(3)
    users = (rng.normal(size=(40, 8)) * scale).astype(np.float32)
    items = (rng.normal(size=(300, 8)) * 0.1).astype(np.float32)
    frames = [
        spark.createDataFrame(
            [(k, [float(x) for x in v]) for k, v in enumerate(rows)], "id int, features array<float>"
        )
        for rows in (users, items)
    ]
    got = R.best_products(*frames, 10, block_rows=64, task_blocks=3).collect()
    lists = [[None] * 10 for _ in users]
    for r in got:
        lists[r["visitorid"]][r["rank"] - 1] = r["itemid"]
    assert lists == lists_by_hand(users, items, 10)


def test_skipped_candidates_and_parts_change_nothing():
    rng = np.random.default_rng(5)
    items = rng.normal(size=(900, 6)) * rng.lognormal(0, 2, (900, 1))
    items[100:300] = items[100]
    users = rng.normal(size=(70, 6))
    users[3] = 0.0
    whole = R._Lists(np.arange(70), users, 15, False)
    whole.offer(np.arange(900), items)
    parts = R._Lists(np.arange(70), users, 15, False)
    for part in np.array_split(rng.permutation(900), 9):
        parts.offer(part, items[part])
    assert np.array_equal(whole.matches, parts.matches)
    assert whole.matches.tolist() == lists_by_hand(users, items, 15)


def test_every_task_has_its_own_partition(spark):
    rows = [(k, [float(k), 1.0]) for k in range(500)]
    df = spark.createDataFrame(rows, "id int, features array<float>")
    best = R._best_matches(df, df, 3, True, block_rows=10, task_blocks=2)
    spread = best.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(spread) == 25


def clustered(seed, rows, groups=12, size=8):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, size)) * 3
    values = middles[rng.integers(0, groups, rows)] + rng.normal(size=(rows, size)) * 0.05
    return values.astype(np.float32)


def framed(spark, values, ids=None):
    ids = range(len(values)) if ids is None else ids
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, values, strict=True)]
    return spark.createDataFrame(rows, "id int, features array<float>")


@pytest.mark.parametrize("n", [1, 6, 100])
def test_cells_give_the_same_lists(spark, monkeypatch, vectors, n):
    ids, values = vectors
    extra = clustered(1, 300)
    every = np.concatenate((values, extra, np.full((2, 8), np.nan, np.float32)))
    names = [*ids, *range(5000, 5302)]
    df = framed(spark, every, names)
    plain = set(map(tuple, R.similar_items(df, n).collect()))
    monkeypatch.setattr(R, "CELL_ROWS", 20)
    assert set(map(tuple, R.similar_items(df, n, block_rows=16, task_blocks=2).collect())) == plain
    finite = every[:-2]
    expected = brute_force(names[:-2], finite.astype(np.float64), n)
    assert {(a, b, r) for a, b, _, r in plain} == expected


def test_cells_give_the_same_products(spark, monkeypatch):
    users, items = clustered(2, 90) * 0.3, clustered(3, 500)
    items[100:200] = items[100]
    frames = framed(spark, users), framed(spark, items)
    plain = set(map(tuple, R.best_products(*frames, 10).collect()))
    monkeypatch.setattr(R, "CELL_ROWS", 25)
    assert set(map(tuple, R.best_products(*frames, 10, block_rows=20, task_blocks=2).collect())) == plain
    empty = framed(spark, users[:0])
    assert R.best_products(empty, frames[1], 10).isEmpty()


def test_cells_send_less_of_clustered_vectors(spark, monkeypatch):
    df = framed(spark, clustered(4, 4000, groups=40))
    sent = {}
    meet = R._meet

    def counted(asked, offered, wanted, n, same_table, task_blocks, only_worst=False):
        tasks = -(-asked.blocks // task_blocks)
        cells = asked.frame.select((F.col("block") * tasks / asked.blocks).cast("int").alias("t"), "cell")
        rows = {r["t"]: set() for r in cells.collect()}
        for r in cells.collect():
            rows[r["t"]] |= set(np.flatnonzero(wanted[r["cell"]]))
        sent[only_worst] = sum(int(offered.rows[list(c)].sum()) for c in rows.values())
        sent["all"] = len(rows) * int(offered.rows.sum())
        return meet(asked, offered, wanted, n, same_table, task_blocks, only_worst)

    monkeypatch.setattr(R, "_meet", counted)
    monkeypatch.setattr(R, "CELL_ROWS", 80)
    got = R.similar_items(df, 5, block_rows=64, task_blocks=1)
    assert got.count() == 5 * 4000
    assert sent[True] + sent[False] < sent["all"] / 3


@pytest.mark.parametrize("n", [1, 6, 100])
def test_few_queries_send_every_candidate_once(spark, monkeypatch, vectors, n):
    ids, values = vectors
    every = np.concatenate((values, clustered(1, 300), np.full((2, 8), np.nan, np.float32)))
    names = [*ids, *range(5000, 5302)]
    df = framed(spark, every, names)
    wanted = spark.createDataFrame([(i,) for i in [*ids[5:25], ids[40], 5301, 5100, 12345]], "id int")
    plain = set(map(tuple, R.similar_for_items(df, wanted, n).collect()))
    monkeypatch.setattr(R, "CELL_ROWS", 20)
    monkeypatch.setattr(R, "_matches_by_cells", None)
    got = R.similar_for_items(df, wanted, n, block_rows=30, task_blocks=2).collect()
    assert len(got) == len(plain)
    # A product's last bit depends on the shape of its block.
    assert {(r["itemid"], r["similar_itemid"], r["rank"]) for r in got} == {(a, b, r) for a, b, _, r in plain}
    assert len({r["itemid"] for r in got}) == 22
