"""Candidate generators: popularity, implicit-feedback factorisation, item similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.config import POSITIVE_EVENTS, AlsConfig
from basketry.functions.ranking import top_n_per_group
from basketry.operators.splits import positive_pairs
from basketry.session import checkpoint_root, scratch_path, ship_package

BLOCK_ROWS = 4096  # vectors that travel as one row, and columns of one matrix product
TASK_BLOCKS = 8  # blocks of queries that one task holds while the candidates pass
CHUNK = 512  # queries of one matrix product
CELL_ROWS = 8192  # candidates to a cell, if that leaves two cells at least
CELLS = 1024  # at most, however many candidates
CELL_SAMPLE = 16  # vectors to a cell from which centres are found
NOBODY = np.iinfo(np.int64).max  # id of a place that no match has taken yet


def top_popular(
    train: DataFrame, n: int = 100, types: Sequence[str] = POSITIVE_EVENTS
) -> DataFrame:
    """The ``n`` items with most users who put them in the cart or bought them.

    Pairs are made distinct first, so one busy user counts once and a hot item reaches the
    count as one partial sum per map task.  Only the ``n`` winners are numbered.
    """
    scored = positive_pairs(train, types).groupBy("item_id").agg(F.count(F.lit(1)).alias("score"))
    best = scored.orderBy(F.desc("score"), "item_id").limit(n)
    place = F.row_number().over(Window.orderBy(F.desc("score"), "item_id"))
    return best.select(F.col("item_id").alias("itemid"), "score", place.alias("rank"))


def train_als(interactions: DataFrame, config: AlsConfig = AlsConfig()) -> ALSModel:
    """Implicit-feedback factorisation of the weighted interactions."""
    spark = interactions.sparkSession
    checkpoint_root(spark)  # ALS cuts its own lineage there
    blocks = config.blocks or spark.sparkContext.defaultParallelism
    als = ALS(
        rank=config.factors,
        regParam=config.regularization,
        alpha=config.alpha,
        maxIter=config.iterations,
        seed=config.seed,
        implicitPrefs=True,
        userCol="user_id",
        itemCol="item_id",
        ratingCol="weight",
        checkpointInterval=5,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
    )
    return als.fit(interactions.select("user_id", "item_id", F.col("weight").cast("float")))


def als_training_loss(
    model: ALSModel, interactions: DataFrame, config: AlsConfig = AlsConfig()
) -> DataFrame:
    """One row: the weighted squared error the factorisation minimises, over all pairs.

    Unseen pairs have preference 0 and confidence 1.  Their part is the sum of the entrywise
    product of the two Gram matrices, so no pair beyond the observed ones is formed.
    """

    def gram(factors: DataFrame) -> DataFrame:
        cells = factors.select("features").mapInArrow(_gram_cells, "i int, j int, g double")
        return cells.groupBy("i", "j").agg(F.sum("g").alias("g"))

    ship_package(interactions.sparkSession)
    users, items = model.userFactors, model.itemFactors
    everything = (
        gram(users)
        .join(gram(items).withColumnRenamed("g", "h"), ["i", "j"])
        .agg(F.sum(F.col("g") * F.col("h")).alias("v"))
        .scalar()
    )
    seen = (
        interactions.join(users.select(F.col("id").alias("user_id"), F.col("features").alias("x")), "user_id")
        .join(items.select(F.col("id").alias("item_id"), F.col("features").alias("y")), "item_id")
        .select(
            (F.lit(1.0) + F.col("weight") * config.alpha).alias("c"),
            F.aggregate(
                F.zip_with("x", "y", lambda a, b: a.cast("double") * b.cast("double")),
                F.lit(0.0),
                lambda total, v: total + v,
            ).alias("p"),
        )
    )
    p = F.col("p")
    return seen.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.sum(F.col("c") * (1 - p) * (1 - p) - p * p).alias("_observed"),
    ).select("pairs", (F.col("_observed") + everything).alias("squared_error"))


def _gram_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of the Gram matrix of the factor rows one task reads, summed over the task."""
    total = None
    for batch in batches:
        if batch.num_rows:
            values = batch.column("features").flatten().to_numpy(zero_copy_only=False)
            rows = values.reshape(batch.num_rows, -1).astype(np.float64)
            total = rows.T @ rows + (0.0 if total is None else total)
    if total is not None:
        i, j = np.indices(total.shape, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())],
            names=["i", "j", "g"],
        )


def personal_als(model: ALSModel, n: int = 100, **sizes: int) -> DataFrame:
    """The ``n`` best items of every user, items already seen included."""
    return best_products(model.userFactors, model.itemFactors, n, **sizes)


def recommend_for_users(
    model: ALSModel, users: DataFrame, n: int = 10, **sizes: int
) -> DataFrame:
    """The ``n`` best items of the given users; unknown users get no rows."""
    keys = users.select(F.col("user_id").alias("id")).distinct()
    wanted = model.userFactors.join(keys, "id", "left_semi")
    return best_products(wanted, model.itemFactors, n, **sizes)


def best_products(users: DataFrame, items: DataFrame, n: int, **sizes: int) -> DataFrame:
    """The ``n`` items with the largest inner products of every user's vector.

    Both tables have ``id`` and ``features``. The score is the product as a 32-bit float and
    the list is ordered by that value, ties by item, so scaling a user changes no list.
    """
    best = _best_matches(users, items, n, same_table=False, **sizes)
    return best.select(
        F.col("query").cast("int").alias("visitorid"),
        F.col("match").cast("int").alias("itemid"),
        "score",
        F.col("rank").cast("short"),
    )


def similar_items(
    vectors: DataFrame,
    n: int = 50,
    items: DataFrame | None = None,
    id_column: str = "id",
    vector_column: str = "features",
    **sizes: int,
) -> DataFrame:
    """The ``n`` most similar other items of every item by cosine, rank 1..n.

    Exact.  Blocks are cut by a hash of the id, so equal vectors do not pile up in one of
    them.  ``items`` limits whose neighbours are looked for, not the neighbours.
    """
    vectors = vectors.select(
        F.col(id_column).alias("id"), F.col(vector_column).alias("features")
    )
    wanted = vectors
    if items is not None:
        keys = items.select(F.col(id_column).alias("id")).distinct()
        wanted = vectors.join(keys, "id", "left_semi")
    best = _best_matches(wanted, vectors, n, same_table=True, **sizes)
    return best.select(
        F.col("query").cast("int").alias("itemid"),
        F.col("match").cast("int").alias("similar_itemid"),
        "score",
        F.col("rank").cast("short"),
    )


def similar_for_items(
    vectors: DataFrame, items: DataFrame, n: int = 10, **options: object
) -> DataFrame:
    """``similar_items`` for the given items only."""
    return similar_items(vectors, n=n, items=items, **options)


def _best_matches(
    queries: DataFrame,
    candidates: DataFrame,
    n: int,
    same_table: bool,
    block_rows: int = BLOCK_ROWS,
    task_blocks: int = TASK_BLOCKS,
) -> DataFrame:
    """For every query vector its ``n`` best candidates: ``(query, match, score, rank)``.

    Both tables are packed into hashed blocks of about ``block_rows``.  A task first reads
    its own blocks of queries, at most ``task_blocks``, and then streams every candidate
    block past them once, as matrix products of at most CHUNK x BLOCK_ROWS.  No pair of
    vectors ever becomes a row; the lists leave the task ranked.  A candidate block is
    ordered by norm: from where norm times norm cannot reach the worst kept score, its rest
    is skipped.  Many candidates are first cut into cells, see ``_matches_by_cells``; of few,
    every task gets all.  If one block holds all queries, that block goes to the candidates
    instead, see ``_matches_of_few``.

    Scores are products in double precision, rounded to 32-bit floats and ordered by those,
    ties by id.  Within one table (``same_table``) the measure is the cosine and a vector is
    no match for itself.
    """
    spark = queries.sparkSession
    ship_package(spark)
    cells = min(CELLS, candidates.count() // CELL_ROWS)
    if cells > 1:
        if queries.limit(block_rows + 1).count() <= block_rows:
            return _matches_of_few(queries, candidates, n, same_table, block_rows, task_blocks)
        return _matches_by_cells(queries, candidates, n, same_table, cells, block_rows, task_blocks)
    asked = _pack(queries, block_rows, at_least=spark.sparkContext.defaultParallelism)
    offered = _pack(candidates, block_rows)
    tasks = max(
        math.ceil(asked.blocks / task_blocks),
        min(asked.blocks, spark.sparkContext.defaultParallelism),
    )
    task_of = F.floor(F.col("block") * F.lit(tasks) / F.lit(asked.blocks)).cast("int")
    every_task = F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))
    rows = asked.frame.select(
        task_of.alias("task"), F.lit(0).alias("kind"), "ids", "matrix"
    ).unionByName(
        offered.frame.select(every_task.alias("task"), F.lit(1).alias("kind"), "ids", "matrix")
    )
    # By number and not by hash: every task has its own partition.
    dealt = rows.repartitionById(tasks, "task").sortWithinPartitions("kind")

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _stream_matches(batches, n, same_table)

    return dealt.mapInArrow(matches, "query bigint, match bigint, score float, rank int")


def _matches_of_few(
    queries: DataFrame, candidates: DataFrame, n: int, same_table: bool, block_rows: int, task_blocks: int
) -> DataFrame:
    """The same lists, of queries that fit into one block.

    Every task gets that block and its own blocks of candidates, so a candidate travels once
    and the work grows with the candidates alone.  The lists of the tasks are merged; a task
    sends at most ``n`` rows per query.
    """
    asked = _pack(queries, block_rows)
    offered = _pack(candidates, block_rows, at_least=candidates.sparkSession.sparkContext.defaultParallelism)
    tasks = math.ceil(offered.blocks / task_blocks)
    tasks = max(tasks, min(offered.blocks, candidates.sparkSession.sparkContext.defaultParallelism))
    task_of = F.floor(F.col("block") * F.lit(tasks) / F.lit(offered.blocks)).cast("int")
    every_task = F.explode(F.sequence(F.lit(0), F.lit(tasks - 1)))
    rows = asked.frame.select(every_task.alias("task"), F.lit(0).alias("kind"), "ids", "matrix").unionByName(
        offered.frame.select(task_of.alias("task"), F.lit(1).alias("kind"), "ids", "matrix")
    )
    # By number and not by hash: every task has its own partition.
    dealt = rows.repartitionById(tasks, "task").sortWithinPartitions("kind")

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _stream_matches(batches, n, same_table)

    found = dealt.mapInArrow(matches, "query bigint, match bigint, score float, rank int").drop("rank")
    return top_n_per_group(found, ["query"], [F.desc("score"), F.col("match")], n)


def _unit(matrix: np.ndarray, unit: bool) -> np.ndarray:
    """``unit``: scaled to length 1, zeros stay."""
    matrix = matrix.astype(np.float64)
    if not unit:
        return matrix
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * (vectors @ centres.T), axis=1)


def _centres(vectors: DataFrame, cells: int, unit: bool, rounds: int = 6) -> np.ndarray:
    """Means of groups in a sample of ``CELL_SAMPLE`` vectors to a cell, chosen by hash."""
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(cells * CELL_SAMPLE).select("features")
    found = _unit(np.array([r["features"] for r in sample.collect()], np.float32), unit)
    found = np.unique(found[np.isfinite(found).all(axis=1)], axis=0)
    if not len(found):
        return np.zeros((1, 1))
    centres = found[np.random.default_rng(cells).permutation(len(found))[:cells]]
    for _ in range(rounds):
        cell = _nearest(found, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, found)
        size = np.bincount(cell, minlength=len(centres))[:, None]
        centres = np.where(size > 0, sums / np.maximum(size, 1), centres)
    return centres


class _Celled(NamedTuple):
    """Vectors with their cells, in written blocks, and of every cell rows and radius."""

    frame: DataFrame  # block, cell, ids, matrix
    blocks: int
    rows: np.ndarray
    radius: np.ndarray


def _in_cells(vectors: DataFrame, centres: np.ndarray, unit: bool, block_rows: int, at_least: int) -> _Celled:
    """Blocks of one cell each, cut by a hash of the id, so that a crowded cell has many."""
    spark = vectors.sparkSession

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            matrix = _unit(values.reshape(batch.num_rows, -1), unit)
            plain = np.isfinite(matrix).all(axis=1)
            matrix = np.where(plain[:, None], matrix, 0.0)
            cell = _nearest(matrix, centres)
            # What is not finite matches nothing, so it makes no cell larger.
            away = np.where(plain, np.linalg.norm(matrix - centres[cell], axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)],
                names=["id", "features", "cell", "away"],
            )

    path = scratch_path(spark, "cells")
    assigned = vectors.mapInArrow(assign, "id bigint, features array<float>, cell int, away double")
    assigned.write.parquet(path)
    kept = spark.read.parquet(path)
    rows, radius = np.zeros(len(centres), np.int64), np.zeros(len(centres))
    for r in kept.groupBy("cell").agg(F.count("cell").alias("n"), F.max("away").alias("far")).collect():
        rows[r["cell"]], radius[r["cell"]] = r["n"], r["far"]
    most = min(block_rows, max(512, -(-int(rows.sum()) // at_least)))
    parts = -(-rows // most)
    start = np.cumsum(parts) - parts
    first, count = (F.element_at(F.array(*map(F.lit, v.tolist())), F.col("cell") + 1) for v in (start, parts))
    packed = (
        kept.withColumn("block", first + F.pmod(F.xxhash64("id"), count))
        .groupBy("cell", "block")
        .agg(F.array_sort(F.collect_list(F.struct("id", "features"))).alias("rows"))
        .select("block", "cell", F.col("rows.id").alias("ids"), F.flatten("rows.features").alias("matrix"))
    )
    path = scratch_path(spark, "blocks")
    packed.write.parquet(path)
    return _Celled(spark.read.parquet(path), int(parts.sum()), rows, radius)


def _matches_by_cells(
    queries: DataFrame, candidates: DataFrame, n: int, same_table: bool, cells: int, block_rows: int, task_blocks: int
) -> DataFrame:
    """The same lists; but a block of candidates only goes to tasks that it can matter to.

    Vectors belong to the cell of their nearest centre, and a cell has a radius.  Centres and
    radii bound every product of two cells.  In a first round each cell of queries meets the
    cells of highest bounds that hold ``n`` others; the worst score kept there is a threshold,
    and in the second round it meets all cells whose bound reaches it.  Centres, radii and
    the table of cells that meet have at most ``CELLS`` squared entries, whatever the rows.
    """
    spark = queries.sparkSession
    at_least = spark.sparkContext.defaultParallelism
    typed = [
        df.select(F.col("id").cast("bigint"), F.col("features").cast("array<float>").alias("features"))
        for df in (candidates, queries)
    ]
    centres = _centres(typed[0], cells, same_table)
    offered = _in_cells(typed[0], centres, same_table, block_rows, 1)
    asked = _in_cells(typed[1], centres, same_table, block_rows, at_least)
    norms = np.linalg.norm(centres, axis=1)
    bound = centres @ centres.T + np.outer(norms, offered.radius)
    bound += np.outer(asked.radius, norms + offered.radius)
    bound += 1e-6 * np.outer(norms + asked.radius, norms + offered.radius)
    used = (asked.rows > 0)[:, None] & (offered.rows > 0)[None, :]
    bound[~used] = -np.inf
    order = np.argsort(-bound, axis=1, kind="stable")
    before = np.cumsum(offered.rows[order], axis=1) - offered.rows[order]
    first = np.zeros_like(used)
    np.put_along_axis(first, order, before < n + 1, axis=1)
    worst = np.full(len(centres), np.inf)
    least = _meet(asked, offered, first & used, n, same_table, task_blocks, only_worst=True)
    for r in least.groupBy("cell").agg(F.min("worst").alias("worst")).collect():
        worst[r["cell"]] = r["worst"]
    return _meet(asked, offered, used & (bound >= worst[:, None]), n, same_table, task_blocks)


def _meet(
    asked: _Celled, offered: _Celled, wanted: np.ndarray, n: int, same_table: bool, task_blocks: int,
    only_worst: bool = False,
) -> DataFrame:
    """Lists of all queries from the cells that theirs wants, or the worst score that any full
    list of a cell keeps (minus infinity if one is not full)."""
    spark = asked.frame.sparkSession
    tasks = max(
        math.ceil(asked.blocks / task_blocks), min(asked.blocks, spark.sparkContext.defaultParallelism), 1
    )
    task_of = F.floor(F.col("block") * F.lit(tasks) / F.lit(max(asked.blocks, 1))).cast("int")
    own = asked.frame.select(task_of.alias("task"), F.lit(0).alias("kind"), "cell", "ids", "matrix")
    pairs = spark.createDataFrame(
        pa.table(dict(zip(("query_cell", "cell"), map(pa.array, np.nonzero(wanted)), strict=True)))
    )
    sends = own.select("task", F.col("cell").alias("query_cell")).distinct().join(pairs, "query_cell")
    sends = sends.select("task", F.col("cell").cast("int").alias("cell")).distinct()
    sent = offered.frame.join(sends, "cell").select("task", F.lit(1).alias("kind"), "cell", "ids", "matrix")
    # By number and not by hash: every task has its own partition.
    dealt = own.unionByName(sent).repartitionById(tasks, "task").sortWithinPartitions("kind")
    meeting = spark.sparkContext.broadcast(wanted)

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _stream_matches(batches, n, same_table, meeting.value, only_worst)

    schema = "cell int, worst double" if only_worst else "query bigint, match bigint, score float, rank int"
    return dealt.mapInArrow(matches, schema)


class _Packed(NamedTuple):
    frame: DataFrame
    blocks: int


def _pack(vectors: DataFrame, block_rows: int, at_least: int = 1) -> _Packed:
    """One row per block: ids in ascending order and their vectors end to end.

    Blocks are smaller than ``block_rows`` if that gives ``at_least`` of them, down to 512.
    """
    typed = vectors.select(
        F.col("id").cast("bigint"), F.col("features").cast("array<float>").alias("features")
    )
    rows = typed.count()
    blocks = max(1, math.ceil(rows / block_rows), min(at_least, math.ceil(rows / 512)))
    packed = (
        typed.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        .groupBy("block")
        .agg(F.array_sort(F.collect_list(F.struct("id", "features"))).alias("rows"))
        .select(
            "block",
            F.col("rows.id").alias("ids"),
            F.flatten(F.col("rows.features")).alias("matrix"),
        )
    )
    return _Packed(packed, blocks)


def _vectors(batch: pa.RecordBatch, row: int, unit: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a packed row; ``unit``: scaled to length 1, zeros stay."""
    ids, values = (
        batch.column(name).slice(row, 1).flatten().to_numpy(zero_copy_only=False)
        for name in ("ids", "matrix")
    )
    return ids, _unit(values.reshape(len(ids), -1), unit)


class _Lists:
    """The ``n`` best matches so far of a block of queries, best first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, n: int, same_table: bool):
        self.ids, self.vectors, self.n, self.same_table = ids, vectors, n, same_table
        self.norms = np.linalg.norm(vectors, axis=1)
        self.scores = np.full((len(ids), n), -np.inf, np.float32)
        self.matches = np.full((len(ids), n), NOBODY)

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Let candidates, in any order, improve the lists."""
        norms = np.linalg.norm(vectors, axis=1)
        order = np.argsort(-norms, kind="stable")
        ids, vectors, norms = ids[order], vectors[order], norms[order]
        for first in range(0, len(self.ids), CHUNK):
            rows = np.arange(first, min(first + CHUNK, len(self.ids)))
            for at in range(0, len(ids), BLOCK_ROWS):
                worst = self.scores[rows, -1].astype(np.float64)
                bound = self.norms[rows] * norms[at] * (1 + 1e-6)
                # Longest first, so nothing behind this place can reach such a row, either.
                open_rows = rows[bound >= worst]
                if not len(open_rows):
                    break
                some = slice(at, at + BLOCK_ROWS)
                self._take(open_rows, ids[some], vectors[some])

    def _take(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        products = (self.vectors[rows] @ vectors.T).astype(np.float32)
        products[np.isnan(products)] = -np.inf
        if self.same_table:
            products[self.ids[rows][:, None] == ids[None, :]] = -np.inf
        least = self.scores[rows, -1]
        if products.shape[1] > self.n:
            # Rows that are not full yet would let everything pass.
            new = np.flatnonzero(np.isneginf(least))
            kth = np.partition(products[new], -self.n, axis=1)[:, -self.n]
            least = least.copy()
            least[new] = kth
        place, column = np.nonzero((products >= least[:, None]) & (products > -np.inf))
        if not len(place):
            return
        touched, local = np.unique(place, return_inverse=True)
        own = rows[touched]
        owner = np.concatenate([np.repeat(np.arange(len(own)), self.n), local])
        score = np.concatenate([self.scores[own].ravel(), products[place, column]])
        match = np.concatenate([self.matches[own].ravel(), ids[column]])
        order = np.lexsort((match, -score, owner))
        best = order[np.searchsorted(owner[order], np.arange(len(own)))[:, None] + np.arange(self.n)]
        self.scores[own], self.matches[own] = score[best], match[best]

    def rows(self) -> pa.RecordBatch:
        taken = self.matches != NOBODY
        query = np.broadcast_to(self.ids[:, None], taken.shape)
        rank = np.broadcast_to(np.arange(1, self.n + 1, dtype=np.int32), taken.shape)
        columns = [query[taken], self.matches[taken], self.scores[taken], rank[taken]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], names=["query", "match", "score", "rank"]
        )


def _stream_matches(
    batches: Iterator[pa.RecordBatch],
    n: int,
    same_table: bool,
    wanted: np.ndarray | None = None,
    only_worst: bool = False,
) -> Iterator[pa.RecordBatch]:
    """Lists of the queries of a task, which come before all candidates."""
    lists: list[tuple[int, _Lists]] = []
    for batch in batches:
        kinds = batch.column("kind").to_pylist()
        cells = [0] * len(kinds) if wanted is None else batch.column("cell").to_pylist()
        for row, (kind, cell) in enumerate(zip(kinds, cells, strict=True)):
            ids, vectors = _vectors(batch, row, same_table)
            if kind == 0:
                lists.append((cell, _Lists(ids, vectors, n, same_table)))
                continue
            for own, block in lists:
                if wanted is None or wanted[own, cell]:
                    block.offer(ids, vectors)
    for own, block in lists:
        if only_worst:
            # A query that is not finite has no list, whatever it meets.
            kept = block.scores[np.isfinite(block.norms), -1]
            worst = float(kept.min()) if len(kept) else float("inf")
            yield pa.RecordBatch.from_arrays(
                [pa.array([own], pa.int32()), pa.array([worst])], names=["cell", "worst"]
            )
        else:
            yield block.rows()
