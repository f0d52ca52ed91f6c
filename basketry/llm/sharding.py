"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``nodes`` points of a ring; a row belongs to the first point clockwise of its
hash. A shard takes no more rows than its capacity: what overflows continues clockwise to
the next point whose shard has room. The assignment is worked out on counts of arcs (one per
virtual node, so their number is a parameter), and rows only learn their rank within their
arc, from counts of small cells of the arc. No row is sent through a single task.
"""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.small import small_table

RING = 1 << 60  # places on the ring: 15 hexadecimal digits of a digest
CELL_ROWS = 256  # rows that a cell holds on average


def ring_points(shards: int, nodes: int) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node, clockwise; shards keep theirs when more come."""
    points = []
    for shard in range(shards):
        for k in range(nodes):
            digest = hashlib.md5(f"shard {shard} node {k}".encode()).hexdigest()
            points.append((int(digest[:15], 16), shard))
    return sorted(points)


def capacities(rows: int, shards: int, load: float = 1.0) -> list[int]:
    """Most rows of each shard. A load of 1 leaves no room to spare: counts differ by one."""
    if load <= 1:
        return [rows // shards + (k < rows % shards) for k in range(shards)]
    return [math.ceil(load * rows / shards)] * shards


def fill(
    counts: dict[int, int], points: list[tuple[int, int]], room: list[int]
) -> list[tuple[int, int, int, int, int]]:
    """Segments (arc, from rank, to rank, shard, first slot) of the bounded-load walk.

    Arc k ends at point k; the last arc runs from the last point to the end of the ring and
    belongs to point 0. Every arc first fills its own shard; then, clockwise from arc 0,
    what is left over goes on to the next shards with room. Rows of an arc that overflow are
    those of highest rank, so rows move only when their own shard is full.
    """
    free, used = list(room), [0] * len(room)
    segments, over = [], []

    def take(arc: int, rank: int, n: int, shard: int) -> int:
        n = min(n, free[shard])
        if n:
            segments.append((arc, rank, rank + n, shard, used[shard]))
            free[shard] -= n
            used[shard] += n
        return n

    for arc in range(len(points) + 1):
        n = counts.get(arc, 0)
        done = take(arc, 0, n, points[arc % len(points)][1])
        if done < n:
            over.append((arc, done, n - done))
    for arc, rank, left in over:
        for step in range(arc + 1, arc + len(points)):
            done = take(arc, rank, left, points[step % len(points)][1])
            rank, left = rank + done, left - done
        if left:
            raise ValueError("the shards have no room for all rows")
    return segments


def arc_of(place: Column, points: list[tuple[int, int]]) -> Column:
    """Number of points before a place: a table of blocks of the ring, then a short list."""
    blocks = 4096
    width = RING // blocks
    listed = [[] for _ in range(blocks)]
    for p, _ in points:
        listed[p // width].append(p)
    before, n = [], 0
    for block in listed:
        before.append(n)
        n += len(block)
    block = F.shiftright(place, 48).cast("int") + 1
    base = F.from_json(F.lit(json.dumps(before)), "array<int>")
    inner = F.from_json(F.lit(json.dumps(listed)), "array<array<bigint>>")
    here = F.filter(F.element_at(inner, block), lambda p: p < place)
    return F.element_at(base, block) + F.size(here)


def bounded_ring(
    docs: DataFrame, shards: int = 8, nodes: int = 64, load: float = 1.0
) -> DataFrame:
    """Columns of ``docs`` (doc_id, text) plus size, text_crc32, shard and slot.

    size: UTF-8 bytes of the text plus 1, a null text has none; text_crc32: of those bytes.
    slot: gapless from 0 in each shard. A null id has a place of its own on the ring. Rows
    with one id stand together and are told apart by their text; equal rows are
    interchangeable. An empty table gives no rows. Columns of ``docs`` with the name of a
    new one are replaced.
    """
    if shards < 1 or nodes < 1 or load < 1:
        raise ValueError("shards and nodes must be at least 1, load at least 1")
    new = ("size", "text_crc32", "shard", "slot")
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"))
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    points = ring_points(shards, nodes)
    rows = docs.count()
    cells = 1 << max(0, min(48, math.ceil(math.log2(max(1, rows / CELL_ROWS)))))
    sized = (
        docs.withColumns({"size": (F.octet_length(body) + 1).cast("long"), "text_crc32": F.crc32(body)})
        .withColumn("__place", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
        .withColumn("__arc", arc_of(F.col("__place"), points))
        .withColumn("__cell", F.shiftright("__place", 60 - cells.bit_length() + 1))
    )
    per_cell = sized.groupBy("__arc", "__cell").agg(F.count(F.lit(1)).alias("__n"))
    counts = {
        r["__arc"]: r["n"] for r in per_cell.groupBy("__arc").agg(F.sum("__n").alias("n")).collect()
    }
    segments = fill(counts, points, capacities(rows, shards, load))
    plan = small_table(
        docs.sparkSession,
        segments,
        "s_arc int, s_from long, s_to long, s_shard int, s_slot long",
    )
    earlier = Window.partitionBy("__arc").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    before = per_cell.select(
        F.col("__arc").alias("c_arc"),
        F.col("__cell").alias("c_cell"),
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("c_before"),
    )
    in_cell = Window.partitionBy("__arc", "__cell").orderBy(
        "__place", "doc_id", "text_crc32", "size"
    )
    ranked = (
        sized.withColumn("__row", F.row_number().over(in_cell))
        .join(before, (F.col("__arc") == F.col("c_arc")) & (F.col("__cell") == F.col("c_cell")))
        .withColumn("__rank", F.col("c_before") + F.col("__row") - 1)
    )
    within = (F.col("__rank") >= F.col("s_from")) & (F.col("__rank") < F.col("s_to"))
    return ranked.join(plan, (F.col("__arc") == F.col("s_arc")) & within).select(
        *[c for c in docs.columns if c not in new],
        "size",
        "text_crc32",
        F.col("s_shard").alias("shard"),
        (F.col("s_slot") + F.col("__rank") - F.col("s_from")).alias("slot"),
    )
