"""Implicit-feedback factorisation by alternating solves of blocks, with its loss.

Every user and item belongs to a block by the hash of its id. Links are packed once: a block of
one side knows its links and, per block of the other side, which vectors it needs (its
route). A half step sends along the routes only those vectors, once each, and solves the
block; no row of the links is joined. Links of an id that has many stay where their vectors
are: every block sends its sums of them. What all solves share, the Gram matrix of the other
side, is summed by Spark, and the loss comes out of the same solves.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.config import AlsConfig
from basketry.session import scratch_path, ship_package

LINKS = 500_000  # to a block, about
BATCH = 256  # systems that are solved together, at most,
PADDED = 65_536  # if their links, padded to the longest, are no more than this
ALONE, SUMMED = -1, -2  # blocks without ids that have many links, and with some
GATHER = 64  # sums of one id that are added at a time
DEAR = 16  # how many times the rows of its sums an id's links may be before the sums travel
PACKED = "kind string, block int, other int, ids binary, ends binary, places binary, weights binary, many binary"
VECTORS = "kind string, block int, id long, ids binary, vectors binary, squared double, norm double"
MESSAGE = "block int, other int, vectors binary"


class Factorisation(NamedTuple):
    userFactors: DataFrame
    itemFactors: DataFrame
    loss: DataFrame  # step, squared_error, penalty


class Totals(NamedTuple):
    """Of one side's vectors: Gram matrix, squared error and squared norms."""

    gram: np.ndarray
    squared: float
    norm: float


@dataclass(frozen=True)
class _Run:
    spark: SparkSession
    folder: str
    config: AlsConfig
    links: int
    blocks: int


def factorise(
    interactions: DataFrame,
    config: AlsConfig = AlsConfig(),
    folder: str | None = None,
    links: int = LINKS,
) -> Factorisation:
    """Factors of users and items (id, features) and the loss after every iteration.

    Minimised is the sum over all pairs of confidence * (preference - product)^2 plus
    ``regularization`` times the squared entries of all vectors, not scaled by counts. An
    observed pair has preference 1 and confidence 1 + ``alpha`` * weight, any other 0 and 1.
    Repeated pairs add their weights; rows with a null, or without a positive weight, are no
    observation. Without any, the tables are empty and the loss is 0.

    Every iteration is written under ``folder``; called again with the same folder, settings
    and input, the work goes on behind the last whole iteration. An id with many links (see
    ``_most``) is solved from sums over several blocks.
    """
    spark = interactions.sparkSession
    ship_package(spark)
    settings = json.dumps([asdict(replace(config, iterations=0)), links])
    root = folder or scratch_path(spark, "factorisation")
    root = f"{root.rstrip('/')}/{hashlib.sha256(settings.encode()).hexdigest()[:12]}"
    pairs = _written(
        spark,
        f"{root}/pairs",
        lambda: interactions.where("user_id IS NOT NULL AND item_id IS NOT NULL AND weight > 0")
        .groupBy(F.col("user_id").cast("long").alias("user_id"), F.col("item_id").cast("long").alias("item_id"))
        .agg(F.sum(F.col("weight").cast("double")).alias("weight")),
    )
    blocks = config.blocks or spark.sparkContext.defaultParallelism
    # The number of blocks stays what it was when a run goes on elsewhere.
    size = _written(
        spark,
        f"{root}/size",
        lambda: pairs.agg(
            F.greatest(F.lit(blocks).cast("long"), F.ceil(F.count(F.lit(1)) / links)).alias("blocks")
        ),
    )
    run = _Run(spark, root, config, links, size.first()["blocks"])
    users = _packed(run, pairs, "user_id", "item_id")
    items = _packed(run, pairs, "item_id", "user_id")
    users_summed, items_summed = (not p.where(F.col("other") == SUMMED).isEmpty() for p in (users, items))
    item_vectors = _written(spark, f"{root}/start", lambda: _start(run, pairs))
    item_totals = _totals(item_vectors, config.factors)
    user_vectors = item_vectors.limit(0)
    for step in range(1, config.iterations + 1):
        here = f"{root}/step-{step:05d}"
        if not _whole(spark, f"{here}/loss"):
            user_vectors = _half(run, users, users_summed, item_vectors, item_totals, f"{here}/users")
            user_totals = _totals(user_vectors, config.factors)
            item_vectors = _half(run, items, items_summed, user_vectors, user_totals, f"{here}/items")
            item_totals = _totals(item_vectors, config.factors)
            penalty = config.regularization * (item_totals.norm + user_totals.norm)
            row = [(step, float(item_totals.squared), float(penalty))]
            loss = spark.createDataFrame(row, "step int, squared_error double, penalty double")
            loss.coalesce(1).write.mode("overwrite").parquet(f"{here}/loss")
            continue
        user_vectors = _vectors(spark, f"{here}/users")
        item_vectors = _vectors(spark, f"{here}/items")
        if not _whole(spark, f"{root}/step-{step + 1:05d}/loss"):
            item_totals = _totals(item_vectors, config.factors)
    losses = spark.createDataFrame([], "step int, squared_error double, penalty double")
    if config.iterations:
        steps = [f"{root}/step-{k:05d}/loss" for k in range(1, config.iterations + 1)]
        losses = spark.read.schema(losses.schema).parquet(*steps)
    last = f"{root}/step-{config.iterations:05d}"
    users, items = (
        _written(spark, f"{last}/{name}-rows", lambda v=vectors: _rows(v, config.factors))
        for name, vectors in (("user", user_vectors), ("item", item_vectors))
    )
    return Factorisation(users, items, losses)


# Tables of a run ----------------------------------------------------------------------------


def _whole(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def _written(spark: SparkSession, path: str, build) -> DataFrame:
    if not _whole(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _vectors(spark: SparkSession, path: str) -> DataFrame:
    """Solved blocks, and the ids solved from sums, which have a table beside them if any."""
    solved = spark.read.schema(VECTORS).parquet(f"{path}/blocks").where("kind = 'solved'")
    if not _whole(spark, f"{path}/summed"):
        return solved
    return solved.unionByName(spark.read.schema(VECTORS).parquet(f"{path}/summed"))


def _block(run: _Run, column: Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(run.blocks)).cast("int")


def _most(links: int, factors: int, blocks: int) -> int:
    """Links of an id up to which its block gets their vectors.

    The sums of an id are ``factors`` rows from each block, a link at most one row. Ids with
    more links are few, at most the larger of ``links`` / (DEAR * ``factors``) and four to a
    block, and a source has no more links to them than that.
    """
    return min(links // 4, DEAR * factors * blocks)


def _packed(run: _Run, pairs: DataFrame, target: str, source: str) -> DataFrame:
    """Blocks of links by target, and their routes by block of the source.

    Links of a target that has many are dealt to the blocks of their sources, whose vectors
    then go to no other block on its account.
    """

    def build() -> DataFrame:
        most = _most(run.links, run.config.factors, run.blocks)
        many = pairs.groupBy(target).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
        linked = pairs.join(many.select(target, F.lit(True).alias("many")), target, "left").select(
            F.coalesce("many", F.lit(False)).alias("many"),
            F.col(target).alias("target"),
            F.col(source).alias("source"),
            F.col("weight"),
            _block(run, F.col(source)).alias("other"),
        )
        block = F.when(F.col("many"), F.col("other")).otherwise(_block(run, F.col("target")))
        return linked.withColumn("block", block).groupBy("block").applyInArrow(_pack, PACKED)

    return _written(run.spark, f"{run.folder}/packed-{target}", build)


def _pack(links: pa.Table) -> pa.Table:
    """One row of links, sorted by target, and one row per route, its ids sorted."""
    links = links.combine_chunks()
    target, source, other, weight, many, block = (
        links.column(c).to_numpy() for c in ("target", "source", "other", "weight", "many", "block")
    )
    order = np.lexsort((source, other))
    new = np.ones(len(order), bool)
    new[1:] = source[order][1:] != source[order][:-1]
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    needed, home = source[order][new], other[order][new]
    by_target = np.lexsort((place, target))
    ids, first = np.unique(target[by_target], return_index=True)
    rows = [
        {
            "kind": "links",
            "block": int(block[0]),
            "other": SUMMED if many.any() else ALONE,
            "ids": ids.astype(np.int64).tobytes(),
            "ends": np.append(first, len(target)).astype(np.int64).tobytes(),
            "places": place[by_target].astype(np.int32).tobytes(),
            "weights": weight[by_target].astype(np.float64).tobytes(),
            "many": many[by_target][first].astype(bool).tobytes(),
        }
    ]
    for one in np.unique(home):
        wanted = needed[home == one].astype(np.int64).tobytes()
        rows.append({"kind": "route", "block": int(block[0]), "other": int(one), "ids": wanted})
    return pa.Table.from_pylist(rows, _arrow(PACKED))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {
        "string": pa.string(),
        "int": pa.int32(),
        "long": pa.int64(),
        "double": pa.float64(),
        "binary": pa.binary(),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def _start(run: _Run, pairs: DataFrame) -> DataFrame:
    """First vectors of the items: entries from the hash of id, place and seed."""
    factors, seed = run.config.factors, run.config.seed

    def fill(items: pa.Table) -> pa.Table:
        ids = np.sort(items.column("item_id").to_numpy().astype(np.int64))
        with np.errstate(over="ignore"):
            x = ids.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
            x = x + np.arange(1, factors + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(seed)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        drawn = (x >> np.uint64(11)).astype(np.float64) / 2.0**53 - 0.5
        return _solved(items.column("block")[0].as_py(), ids, drawn / np.sqrt(factors), 0.0)

    items = pairs.select("item_id").distinct().withColumn("block", _block(run, F.col("item_id")))
    return items.groupBy("block").applyInArrow(fill, VECTORS)


def _solved(block: int, ids: np.ndarray, vectors: np.ndarray, squared: float) -> pa.Table:
    row = {
        "kind": "solved",
        "block": block,
        "ids": ids.tobytes(),
        "vectors": vectors.astype(np.float64).tobytes(),
        "squared": float(squared),
        "norm": float((vectors * vectors).sum()),
    }
    return pa.Table.from_pylist([row], _arrow(VECTORS))


def _rows(vectors: DataFrame, factors: int) -> DataFrame:
    """id, features of every vector."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                numbers = np.frombuffer(ids, np.int64)
                flat = np.frombuffer(data, np.float64).astype(np.float32)
                offsets = np.arange(len(numbers) + 1, dtype=np.int32) * factors
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers), pa.ListArray.from_arrays(offsets, pa.array(flat))],
                    names=["id", "features"],
                )

    return vectors.select("ids", "vectors").mapInArrow(unpack, "id long, features array<float>")


def _totals(vectors: DataFrame, factors: int) -> Totals:
    """Sums over all vectors: tasks add their own, Spark adds those of the tasks."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(factors * factors + 2)
        for batch in batches:
            for data, squared, norm in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = np.frombuffer(data, np.float64).reshape(-1, factors)
                total += np.concatenate(((rows.T @ rows).ravel(), [squared, norm]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["cell", "v"]
        )

    summed = np.zeros(factors * factors + 2)
    parts = vectors.select("vectors", "squared", "norm").mapInArrow(cells, "cell int, v double")
    for row in parts.groupBy("cell").agg(F.sum("v").alias("v")).collect():
        summed[row["cell"]] = row["v"]
    return Totals(summed[:-2].reshape(factors, factors), summed[-2], summed[-1])


# One half step ------------------------------------------------------------------------------


def _half(
    run: _Run, packed: DataFrame, summed: bool, vectors: DataFrame, totals: Totals, path: str
) -> DataFrame:
    """The best vectors of one side, given those of the other and their sums."""
    config, gram = run.config, totals.gram
    factors, alpha = config.factors, config.alpha
    system = gram + config.regularization * np.eye(factors)

    def send(routes: pa.Table, own: pa.Table) -> pa.Table:
        ids = np.concatenate([np.frombuffer(b, np.int64) for b in own.column("ids").to_pylist()])
        flat = [np.frombuffer(b, np.float64) for b in own.column("vectors").to_pylist()]
        order = np.argsort(ids)
        rows, ids = np.concatenate(flat).reshape(-1, factors)[order], ids[order]
        columns = zip(*(routes.column(c).to_pylist() for c in ("block", "other", "ids")), strict=True)
        sent = [
            {
                "block": block,
                "other": other,
                "vectors": rows[np.searchsorted(ids, np.frombuffer(wanted, np.int64))].tobytes(),
            }
            for block, other, wanted in columns
        ]
        return pa.Table.from_pylist(sent, _arrow(MESSAGE))

    def solve(links: pa.Table, got: pa.Table) -> pa.Table:
        (row,) = links.to_pylist()
        order = np.argsort(got.column("other").to_numpy())
        messages = got.column("vectors")
        other = np.concatenate([np.frombuffer(messages[int(k)].as_py(), np.float64) for k in order])
        other = other.reshape(-1, factors)
        ids, ends = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["ends"], np.int64)
        place = np.frombuffer(row["places"], np.int32)
        extra = alpha * np.frombuffer(row["weights"], np.float64)
        many = np.frombuffer(row["many"], bool)
        out = []
        alone = np.flatnonzero(~many)
        alone = alone[np.argsort(ends[alone + 1] - ends[alone], kind="stable")]
        solved, squared, lo = np.zeros((len(alone), factors)), 0.0, 0
        while lo < len(alone):
            part = alone[lo : lo + BATCH]
            counts = ends[part + 1] - ends[part]
            # In order of length, so what is left out of a batch is its longest.
            fits = max(1, int((counts * np.arange(1, len(part) + 1) <= PADDED).sum()))
            sums = _padded_sums(other, place, extra, ends[part[:fits]], counts[:fits])
            solved[lo : lo + fits], error = _solve(*sums, system, gram)
            squared, lo = squared + error, lo + fits
        if len(alone):
            by_id = np.argsort(alone)
            out.append(_solved(row["block"], ids[alone[by_id]], solved[by_id], squared))
        for k in np.flatnonzero(many):
            a, b, confidence = _sums(other, place, extra, ends[k], ends[k + 1])
            summed = np.concatenate((a.ravel(), b)).tobytes()
            out.append(_partial(row["block"], int(ids[k]), summed, confidence))
        return pa.concat_tables(out)

    def add(parts: pa.Table) -> pa.Table:
        summed = sum(np.frombuffer(b, np.float64) for b in parts.column("vectors").to_pylist())
        confidence = sum(parts.column("squared").to_pylist())
        block, own = (parts.column(c)[0].as_py() for c in ("block", "id"))
        return _partial(block, own, summed.tobytes(), confidence)

    def finish(parts: pa.Table) -> pa.Table:
        (row,) = add(parts).to_pylist()
        sums = np.frombuffer(row["vectors"], np.float64)
        a, b = sums[:-factors].reshape(1, factors, factors), sums[None, -factors:]
        solved, error = _solve(a, b, row["squared"], system, gram)
        return _solved(row["block"], np.array([row["id"]], np.int64), solved, error)

    routes = packed.where("kind = 'route'").select("block", "other", "ids")
    sent = (
        routes.groupBy("other")
        .cogroup(vectors.select("block", "ids", "vectors").groupBy("block"))
        .applyInArrow(send, MESSAGE)
    )
    links = packed.where("kind = 'links'").drop("kind", "other")
    solved = links.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(solve, VECTORS)
    solved.write.mode("overwrite").parquet(f"{path}/blocks")
    blocks = run.spark.read.schema(VECTORS).parquet(f"{path}/blocks")
    if not summed:
        return _vectors(run.spark, path)
    parts = blocks.where("kind = 'sums'")
    if run.blocks > GATHER:
        # In two rounds, as an id with a large share of all links has sums of every block.
        parts = parts.withColumn("part", F.floor(F.col("block") / GATHER))
        parts = parts.groupBy("id", "part").applyInArrow(add, VECTORS)
    parts = parts.withColumn("block", _block(run, F.col("id")))
    parts.groupBy("id").applyInArrow(finish, VECTORS).write.mode("overwrite").parquet(f"{path}/summed")
    return _vectors(run.spark, path)


def _partial(block: int, own: int, summed: bytes, confidence: float) -> pa.Table:
    row = {"kind": "sums", "block": block, "id": own, "vectors": summed}
    row |= {"squared": float(confidence), "norm": 0.0}
    return pa.Table.from_pylist([row], _arrow(VECTORS))


def _sums(
    other: np.ndarray, place: np.ndarray, extra: np.ndarray, lo: int, hi: int
) -> tuple[np.ndarray, np.ndarray, float]:
    """What the links of one id add to its system and right side, and their confidence."""
    rows, more = other[place[lo:hi]], extra[lo:hi]
    confidence = 1 + more
    return (rows * more[:, None]).T @ rows, confidence @ rows, confidence.sum()


def _padded_sums(
    other: np.ndarray, place: np.ndarray, extra: np.ndarray, starts: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    """``_sums`` of several ids at once, their links padded to the longest with zeros."""
    inside = np.arange(counts.max()) < counts[:, None]
    links = np.where(inside, starts[:, None] + np.arange(counts.max()), 0)
    rows, more = other[place[links]], np.where(inside, extra[links], 0.0)
    confidence = inside + more
    a = np.matmul((rows * more[:, :, None]).transpose(0, 2, 1), rows)
    return a, np.matmul(confidence[:, None, :], rows)[:, 0], float(confidence.sum())


def _solve(
    a: np.ndarray, b: np.ndarray, confidence: float, system: np.ndarray, gram: np.ndarray
) -> tuple[np.ndarray, float]:
    """Best vectors, and the squared error of all pairs that they are part of."""
    x = np.linalg.solve(a + system, b[:, :, None])[:, :, 0]
    fitted = (np.matmul(x[:, None, :], a + gram)[:, 0] * x).sum()
    return x, float(confidence - 2 * (x * b).sum() + fitted)
