"""Whitening against NumPy's eigenvectors, and its solver on awkward matrices."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from basketry.llm import bidiagonal, whitening
from basketry.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows: list[tuple], components: int = 16) -> dict:
    """Everything the query returns, by plain NumPy; vectors up to their sign."""
    good = [
        (i, [float(np.float32(c)) for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    most = max((len(v) for _, v in good), default=0)
    xs = [
        (i, tuple(math.floor(64 * c) + 1_000_000 for c in [*v, *[0.0] * (most - len(v))]))
        for i, v in good
    ]
    fit = np.array(sorted({x for _, x in xs}), dtype=object).reshape(-1, most)
    n, sums = len(fit), fit.sum(axis=0)
    centred = ((fit * n - sums) / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()) if values[0] > 0 else 0)
    return {
        "n": n,
        "k": k,
        "rows": Counter(i for i, _ in xs),
        "explained": values / values.sum() if values.sum() else values,
        "deviation": Counter((i, int(((np.array(x, object) * n - sums) ** 2).sum())) for i, x in xs),
        "whitened": [
            (i, ((np.array(x, object) * n - sums) / n).astype(float) @ vectors[:, :k] / np.sqrt(values[:k]))
            for i, x in xs
        ],
    }


def check(got: list, rows: list[tuple], distinct_values: bool = True) -> None:
    expected = plain(rows)
    k = expected["k"]
    assert Counter(r["vec_id"] for r in got) == Counter({i: c * k for i, c in expected["rows"].items()})
    assert {r["component"] for r in got} == set(range(1, k + 1))
    assert all(r["n"] == expected["n"] for r in got)
    assert Counter((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1) == expected["deviation"]
    for r in got:
        assert math.isclose(r["explained"], expected["explained"][r["component"] - 1], rel_tol=1e-9)
        assert r["identity_error"] < 1e-9
    if distinct_values:
        for c in range(1, k + 1):
            mine = sorted((r["vec_id"] or 0, abs(r["whitened"])) for r in got if r["component"] == c)
            theirs = sorted((i or 0, abs(w[c - 1])) for i, w in expected["whitened"])
            assert np.allclose([w for _, w in mine], [w for _, w in theirs], atol=1e-6)


def test_whole_table(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    check(
        QUERIES["op12_embedding_whitening"](spark, folder).collect(),
        [(r["vec_id"], r["embedding"]) for r in table.collect()],
    )


def odd_vectors() -> list[tuple]:
    r = np.random.default_rng(3)
    rows = [(k, (r.standard_normal(5) * [1, 2, 3, 4, 9]).tolist()) for k in range(30)]
    return [
        *rows, rows[0], (None, rows[1][1]), (None, None), (41, [1.0, None, 2.0, 3.0, 4.0]),
        (42, [math.nan] * 5), (43, [math.inf, 0.0, 0.0, 0.0, 0.0]), (44, [0.5, 0.25]), (45, []),
        (46, rows[2][1]), (0, [7.0, 7.0, 7.0, 7.0, 7.0]),
    ]


@pytest.mark.parametrize("block", [3, 2048])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", block)
    rows = odd_vectors()
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(7)
    table = table.selectExpr("*", "1 AS x", "2 AS key", "3 AS v")
    check(whitening.whiten(table).collect(), rows)


def test_fewer_components_than_asked(spark):
    flat = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 4.0, 6.0]), (3, [3.0, 6.0, 9.0]), (4, [3.0, 6.0, 9.0])]
    check(whitening.whiten(spark.createDataFrame([(*r, 0) for r in flat], SCHEMA)).collect(), flat)
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, [])], [(1, None)]):
        table = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
        got = whitening.whiten(table)
        assert got.isEmpty() and got.columns[0] == "vec_id"


def test_numbers_beyond_64_bits_stay_exact(spark):
    rows = [(1, [2.0**50, 1.0]), (2, [-(2.0**50), 2.0]), (3, [0.0, 5.0]), (4, [2.0**56, 0.0])]
    table = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = whitening.whiten(table).collect()
    assert {r["vec_id"] for r in got} == {1, 2, 3} and {r["n"] for r in got} == {3}
    xs = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows[:3]], object)
    d = xs * 3 - xs.sum(axis=0)
    for r in got:
        exact = int((d[r["vec_id"] - 1] ** 2).sum())
        assert r["deviation"] == (exact if exact < 1 << 63 else None)


def matrices() -> dict[str, np.ndarray]:
    r = np.random.default_rng(0)
    q1, q2 = (np.linalg.qr(r.standard_normal((48, 48)))[0] for _ in range(2))
    holes = r.standard_normal((200, 30))
    holes[:, 7], holes[:, 9] = 0, holes[:, 8]
    return {
        "plain": r.standard_normal((300, 48)),
        "graded": r.standard_normal((300, 48)) * np.logspace(0, -9, 48),
        "equal values": np.eye(24),
        "repeated values": np.kron(np.eye(8), np.ones((3, 6))),
        "a cluster": (q1 * (1 + 1e-10 * np.arange(48))) @ q2,
        "pairs": np.diag(np.abs(np.arange(41) - 20.0)) + np.diag(np.ones(40), 1),
        "deficient": holes,
        "one row": r.standard_normal((1, 6)),
        "one column": r.standard_normal((9, 1)),
        "zero": np.zeros((4, 5)),
    }


@pytest.mark.parametrize("name", matrices())
def test_solver_gives_eigenvectors(name):
    a = matrices()[name]
    n = a.shape[1]
    r = np.linalg.qr(np.vstack((a, np.zeros((n, n)))), "r")
    values, vectors, trace = bidiagonal.leading(r, 16)
    exact = np.linalg.svd(a, compute_uv=False) ** 2
    k = len(values)
    assert k == min(16, int((exact > exact[0] * 1e-26).sum()) if exact[0] else 0)
    assert np.allclose(values, exact[:k], rtol=1e-12, atol=0)
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-10)
    assert np.abs(a.T @ (a @ vectors) - vectors * values).max(initial=0) <= 1e-12 * max(exact[0], 1)
    assert math.isclose(trace, exact.sum(), rel_tol=1e-12)


def test_values_of_small_size_keep_their_digits():
    diagonal, above = np.array([1.0, 1e-6, 1e-12]), np.array([1e-3, 1e-9])
    got = bidiagonal.squared_values(diagonal, above)
    product = math.prod(diagonal) ** 2
    assert math.isclose(math.prod(got), product, rel_tol=1e-12)
