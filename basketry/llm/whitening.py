"""Whitening of embeddings: centred, turned to the eigenvectors of their covariance, scaled to
variance one.

Vectors become whole numbers, and each distinct one counts once. Blocks of centred rows are
reduced by QR inside tasks, and the triangular factors meet in a tree; the last one, of the
dimension squared, is solved by :mod:`basketry.llm.bidiagonal`. All sums are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import bidiagonal
from basketry.session import scratch_path, ship_package

SCALE, OFFSET = 64, 1_000_000
# Entries beyond this have no whole number of 64 bits; they count as not finite.
LIMIT = float(1 << 55)
BLOCK_ROWS = 2048
FAN_IN = 16
_SPLIT = 1 << 24
_LONG = (1 << 63) - 1


class Whitening(NamedTuple):
    """What the fit list determines. ``directions`` has a column for each component."""

    dimension: int
    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    directions: np.ndarray
    trace: float


def usable(vector: Column) -> Column:
    """Neither null nor with an entry that is null, not a number or infinite."""
    plain = F.forall(
        vector,
        lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < LIMIT), F.lit(False)),
    )
    return F.coalesce(vector.isNotNull() & plain, F.lit(False))


def whole_numbers(vector: Column, dimension: int) -> Column:
    """floor(64 c) + 1000000 of every entry; a shorter vector ends in zeros."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)
    missing = F.greatest(F.lit(dimension) - F.size(vector), F.lit(0))
    return F.concat(x, F.array_repeat(F.lit(OFFSET).cast("long"), missing))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _sums(rows: DataFrame, run, kind: str, length: int) -> list:
    """The sums of the arrays of ``length`` entries that ``run`` yields, place by place."""
    parts = rows.mapInArrow(run, f"part array<{kind}>")
    found = parts.select(F.posexplode("part").alias("place", "v")).groupBy("place")
    got = {r["place"]: r["s"] for r in found.agg(F.sum("v").alias("s")).collect()}
    return [got.get(k, 0) for k in range(length)]


def exact_sums(fit: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Rows and the sum of every dimension. High and low halves are added apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * dimension + 1, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dimension)
            low = x & (_SPLIT - 1)
            total[0] += len(x)
            total[1 : dimension + 1] += (x >> 24).sum(axis=0)
            total[dimension + 1 :] += low.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], names=["part"])

    total = _sums(fit, run, "long", 2 * dimension + 1)
    high, low = total[1 : dimension + 1], total[dimension + 1 :]
    return total[0], [h * _SPLIT + v for h, v in zip(high, low, strict=True)]


def scaled_deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n x - S, exact: 64-bit numbers where they are enough, else Python's."""
    most = int(np.abs(x).max(initial=0))
    if n * most + max((abs(s) for s in sums), default=0) < _LONG:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _squares(d: np.ndarray) -> list[int | None]:
    """Sum of squares of each row; None beyond 64 bits."""
    most = int(np.abs(d).max(initial=0))
    if most * most * max(d.shape[1], 1) <= _LONG and d.dtype != object:
        return (d * d).sum(axis=1).tolist()
    found = [sum(int(v) ** 2 for v in row) for row in d]
    return [v if v <= _LONG else None for v in found]


def triangular_factor(fit: DataFrame, dimension: int, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """R of the centred rows: of blocks, of tasks, and of ``FAN_IN`` factors at a time."""
    spark = fit.sparkSession
    wide = dimension * dimension

    def reduced(r: np.ndarray, more: np.ndarray) -> np.ndarray:
        r = np.linalg.qr(np.vstack((r, more)), "r")
        return np.vstack((r, np.zeros((dimension - len(r), dimension)))) if len(r) < dimension else r

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, rows = np.zeros((dimension, dimension)), 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                x = _matrix(batch.column(0).slice(at, BLOCK_ROWS), dimension)
                r = reduced(r, (scaled_deviations(x, n, sums) / n).astype(float))
                rows += len(x)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()])], names=["r"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, some = np.zeros((dimension, dimension)), False
        for batch in batches:
            for given in batch.column(1):
                more = np.frombuffer(given.as_py(), float, wide).reshape(dimension, dimension)
                r, some = reduced(r, more), True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()])], names=["r"])

    level = fit.select("x").mapInArrow(blocks, "r binary")
    while True:
        path = scratch_path(spark, "factors")
        level.write.parquet(path)
        kept = spark.read.parquet(path)
        left = kept.count()
        if left <= 1:
            break
        # Numbers dealt round to as many tasks as the next level has.
        dealt = kept.select(F.monotonically_increasing_id().alias("k"), "r")
        level = dealt.repartition(-(-left // FAN_IN)).mapInArrow(merged, "r binary")
    row = kept.first()
    if row is None:
        return np.zeros((dimension, dimension))
    return np.frombuffer(bytes(row["r"]), float, wide).reshape(dimension, dimension)


def fit_whitening(fit: DataFrame, dimension: int, components: int) -> Whitening:
    """From a table whose column ``x`` holds each distinct vector once."""
    ship_package(fit.sparkSession)
    n, sums = exact_sums(fit, dimension)
    if not n:
        return Whitening(dimension, 0, tuple(sums), np.zeros(0), np.zeros((dimension, 0)), 0.0)
    r = triangular_factor(fit, dimension, n, tuple(sums))
    values, directions, trace = bidiagonal.leading(r / np.sqrt(n), components)
    return Whitening(dimension, n, tuple(sums), values, directions, trace)


def _whitened(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    d = scaled_deviations(x, model.n, model.sums)
    return d, (d / model.n).astype(float) @ (model.directions / np.sqrt(model.eigenvalues))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry, without sign, of the covariance of the whitened fit list minus one."""
    k = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                x = _matrix(batch.column(0).slice(at, BLOCK_ROWS), model.dimension)
                w = _whitened(x, model)[1]
                total += np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], names=["part"])

    total = np.array(_sums(fit.select("x"), run, "double", k + k * k)) / model.n
    mean, square = total[:k], total[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def whiten(
    vectors: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = 16
) -> DataFrame:
    """``key``, component, n, deviation, whitened, explained, identity_error of every usable row
    and each of its first ``components`` components.

    Rows without a usable vector go: null, or with an entry that is null, not finite or of 2^55
    and more. Shorter vectors end in zeros. Repeated rows and ids stay, and count once in the
    fit. There are only as many components as the covariance has eigenvalues above rounding,
    so none, and no rows, where all vectors are equal or empty or there are none. deviation is
    null beyond 64 bits. Other columns are ignored.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(key).alias("key"), F.col(column).alias("v"))
    rows = rows.where(usable(F.col("v")))
    dimension = rows.agg(F.max(F.size("v")).alias("most")).first()["most"] or 0
    rows = rows.select("key", whole_numbers(F.col("v"), dimension).alias("x"))
    kind = dict(rows.dtypes)["key"]
    schema = (
        f"`{key}` {kind}, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    if dimension == 0:
        return spark.createDataFrame([], schema)
    path = scratch_path(spark, "vectors")
    # A frequent vector is combined before the shuffle.
    rows.select("x").distinct().write.parquet(path)
    fit = spark.read.parquet(path)
    model = fit_whitening(fit, dimension, components)
    k = len(model.eigenvalues)
    if k == 0:
        return spark.createDataFrame([], schema)
    error = identity_error(fit, model)
    explained = model.eigenvalues / model.trace
    n = model.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                m = part.num_rows
                d, w = _whitened(_matrix(part.column(1), dimension), model)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, np.int64)),
                        pa.array(_squares(d), pa.int64()).take(each),
                        pa.array(w.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=[
                        key, "component", "n", "deviation", "whitened", "explained",
                        "identity_error",
                    ],
                )

    return rows.select("key", "x").mapInArrow(run, schema)
