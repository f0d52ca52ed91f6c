"""Factorisation by blocks against a plain one over all pairs."""

from __future__ import annotations

import os
from dataclasses import replace

import numpy as np
import pytest

from basketry.config import AlsConfig
from basketry.operators import factorisation as A
from basketry.operators import generators as R

CONFIG = AlsConfig(factors=5, iterations=4, regularization=0.3, alpha=4.0, blocks=3)
SCHEMA = "user_id int, item_id int, weight double"


@pytest.fixture(scope="module")
def links(spark):
    """Item 7 has a link from every user; weights differ."""
    rng = np.random.default_rng(5)
    seen = {(int(u), int(i)) for u, i in zip(rng.integers(0, 60, 500), rng.zipf(1.4, 500) % 40)}
    seen |= {(u, 7) for u in range(60)}
    rows = [(u, i, float(1 + (u * i) % 3)) for u, i in sorted(seen)]
    return rows, spark.createDataFrame(rows, SCHEMA).cache()


def table(factors):
    rows = {r["id"]: r["features"] for r in factors.collect()}
    return sorted(rows), np.array([rows[k] for k in sorted(rows)])


def plain(rows, start, item_ids, config):
    """Vectors and squared error after every iteration, from dense matrices."""
    user_ids = sorted({u for u, _, _ in rows})
    c = np.ones((len(user_ids), len(item_ids)))
    p = np.zeros_like(c)
    for u, i, w in rows:
        c[user_ids.index(u), item_ids.index(i)] += config.alpha * w
        p[user_ids.index(u), item_ids.index(i)] = 1
    ridge = config.regularization * np.eye(config.factors)
    y, losses = start.astype(float), []
    for _ in range(config.iterations):
        x = np.array([np.linalg.solve((y.T * c[u]) @ y + ridge, (y.T * c[u]) @ p[u]) for u in range(len(c))])
        y = np.array(
            [np.linalg.solve((x.T * c[:, i]) @ x + ridge, (x.T * c[:, i]) @ p[:, i]) for i in range(c.shape[1])]
        )
        penalty = config.regularization * ((x * x).sum() + (y * y).sum())
        losses.append(((c * (p - x @ y.T) ** 2).sum(), penalty))
    return x, y, losses


@pytest.mark.parametrize("size", [A.LINKS, 60])
def test_factors_and_losses_equal_a_plain_solution(links, size):
    rows, frame = links
    start = A.factorise(frame, replace(CONFIG, iterations=0))
    item_ids, y = table(start.itemFactors)
    assert start.userFactors.count() == start.loss.count() == 0
    x, y, losses = plain(rows, y, item_ids, CONFIG)
    # 60 links to a block: item 7 and busy users are solved from sums over blocks.
    got = A.factorise(frame, CONFIG, links=size)
    assert np.allclose(table(got.userFactors)[1], x, atol=1e-4)
    assert table(got.itemFactors)[0] == item_ids and np.allclose(table(got.itemFactors)[1], y, atol=1e-4)
    found = [(r["squared_error"], r["penalty"]) for r in got.loss.orderBy("step").collect()]
    assert np.allclose(found, losses, rtol=1e-5)
    sums = [sum(f) for f in found]
    assert sums == sorted(sums, reverse=True) and sums[0] > sums[-1]
    last = R.als_training_loss(got, frame, CONFIG).first()
    assert last["squared_error"] == pytest.approx(found[-1][0], rel=1e-4)
    assert last["pairs"] == len(rows)


def test_a_run_goes_on_behind_its_last_whole_iteration(links, tmp_path):
    _, frame = links
    folder = str(tmp_path)
    A.factorise(frame, replace(CONFIG, iterations=2), folder)
    (root,) = tmp_path.iterdir()
    # The third iteration was cut off: its users are there, its loss is not.
    half = root / "step-00003" / "users" / "blocks"
    half.mkdir(parents=True)
    (half / "part-0.parquet").write_bytes(b"cut off")
    before = {p: os.stat(p).st_mtime_ns for p in root.rglob("*.parquet") if "step-00003" not in str(p)}
    got = A.factorise(frame, replace(CONFIG, iterations=3), folder)
    assert all(os.stat(p).st_mtime_ns == t for p, t in before.items())
    whole = A.factorise(frame, replace(CONFIG, iterations=3))
    assert np.allclose(table(got.itemFactors)[1], table(whole.itemFactors)[1], atol=1e-5)
    assert [r["step"] for r in got.loss.orderBy("step").collect()] == [1, 2, 3]


def test_odd_interactions(spark):
    rows = [(1, 1, 1.0), (1, 1, 2.0), (2, 1, 1.0), (None, 1, 1.0), (1, None, 1.0), (3, 3, None), (3, 3, 0.0)]
    config = replace(CONFIG, iterations=2)
    got = A.factorise(spark.createDataFrame(rows, SCHEMA), config)
    once = A.factorise(spark.createDataFrame([(1, 1, 3.0), (2, 1, 1.0)], SCHEMA), config)
    assert table(got.userFactors)[0] == [1, 2] and table(got.itemFactors)[0] == [1]
    assert np.allclose(table(got.userFactors)[1], table(once.userFactors)[1], atol=1e-6)
    none = A.factorise(spark.createDataFrame([], SCHEMA), config)
    assert none.userFactors.count() == none.itemFactors.count() == 0
    assert [r["squared_error"] for r in none.loss.collect()] == [0.0, 0.0]
    lists = R.personal_als(got, 5).collect()
    assert sorted((r["visitorid"], r["itemid"]) for r in lists) == [(1, 1), (2, 1)]


def test_vectors_stay_where_they_are_for_ids_with_many_links(spark, tmp_path, monkeypatch):
    """Three items that 300 users have: one vector of each user goes to its own block only."""
    monkeypatch.setattr(A, "GATHER", 2)  # of three blocks: sums are added in two rounds
    rows = [(u, i, float(1 + (u * i) % 3)) for u in range(300) for i in (3, 5, 8)]
    frame = spark.createDataFrame(rows, SCHEMA)
    start = A.factorise(frame, replace(CONFIG, iterations=0))
    item_ids, y = table(start.itemFactors)
    x, y, losses = plain(rows, y, item_ids, CONFIG)
    got = A.factorise(frame, CONFIG, str(tmp_path))
    assert np.allclose(table(got.userFactors)[1], x, atol=1e-4)
    assert np.allclose(table(got.itemFactors)[1], y, atol=1e-4)
    found = [(r["squared_error"], r["penalty"]) for r in got.loss.orderBy("step").collect()]
    assert np.allclose(found, losses, rtol=1e-5)
    (root,) = tmp_path.iterdir()
    routes = spark.read.parquet(f"{root}/packed-item_id").where("kind = 'route'").collect()
    assert len(routes) == CONFIG.blocks and all(r["block"] == r["other"] for r in routes)
    assert sum(len(r["ids"]) // 8 for r in routes) == 300


def test_padded_sums_are_those_of_every_id():
    rng = np.random.default_rng(2)
    other, place, extra = rng.normal(size=(30, 4)), rng.integers(0, 30, 50), rng.random(50)
    starts, counts = np.array([3, 0, 20]), np.array([1, 3, 17])
    a, b, confidence = A._padded_sums(other, place, extra, starts, counts)
    each = [A._sums(other, place, extra, lo, lo + n) for lo, n in zip(starts, counts, strict=True)]
    assert np.allclose(a, [s[0] for s in each]) and np.allclose(b, [s[1] for s in each])
    assert confidence == pytest.approx(sum(s[2] for s in each))
