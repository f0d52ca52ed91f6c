"""Homomorphic multiset fingerprints of documents.

A paragraph (a non-empty line) is hashed to a wide vector; the fingerprint of a text is the
sum of the vectors of its paragraphs, lane by lane modulo a power of two. So it does not
depend on the order of paragraphs, and one can be put in or taken out by adding or
subtracting its vector alone. ``EXACT`` lanes (modulo 2**64) are uniform and tell multisets
of paragraphs apart; ``NEAR`` lanes (modulo 2**32) hold a signed count of the paragraph's
runs of three words, so that the inner product of two fingerprints estimates what they share.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.session import ship_package

EXACT, NEAR, RUN = 8, 256, 3
_LANES = texts.mixed(np.arange(1, EXACT + 1, dtype=np.uint64))
_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
_LINE = np.ones(256, bool)
_LINE[10] = False


def fingerprints(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(EXACT lanes uint64, NEAR lanes uint32) of every text of a column; null is empty."""
    exact = np.zeros((len(column), EXACT), np.uint64)
    near = np.zeros((len(column), NEAR), np.uint32)
    for piece in texts.slices(column):
        n = len(piece.bounds) - 1
        lines = texts.words(piece, _LINE)
        rows = exact[piece.first : piece.first + n]
        for lane in range(EXACT):
            np.add.at(rows[:, lane], lines.text, texts.mixed(lines.hash ^ _LANES[lane]))
        # Words of a line, and runs within it: a line stands in for a text.
        found = texts.words(piece, _NOT_SPACE)
        if not len(found.start):
            continue
        line = np.searchsorted(lines.start, found.start, "right") - 1
        owner, value = texts.shingles(found._replace(text=line), len(lines.start), RUN)
        sign = np.where((value >> np.uint64(20)) & np.uint64(1), 1, -1)
        cell = lines.text[owner] * NEAR + (value & np.uint64(NEAR - 1)).astype(np.int64)
        sums = np.bincount(cell, weights=sign, minlength=n * NEAR).astype(np.int64)
        near[piece.first : piece.first + n] = sums.reshape(n, NEAR).astype(np.uint32)
    return exact, near


def combined(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], sign: int = 1):
    """Fingerprint of the paragraphs of a with those of b put in (1) or taken out (-1)."""
    with np.errstate(over="ignore"):
        return (a[0] + b[0], a[1] + b[1]) if sign > 0 else (a[0] - b[0], a[1] - b[1])


def encoded(exact: np.ndarray, near: np.ndarray) -> list[str]:
    data = np.concatenate((exact.astype("<u8").view(np.uint8), near.astype("<u4").view(np.uint8)), 1)
    return [base64.b64encode(row.tobytes()).decode() for row in data]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Estimated share of common runs, 2ab / (aa + bb), from 0 to 1; equal fingerprints: 1."""
    x, y = a[1].view(np.int32).astype(np.float64), b[1].view(np.int32).astype(np.float64)
    total = (x * x).sum(1) + (y * y).sum(1)
    share = 2 * (x * y).sum(1) / np.maximum(total, 1)
    same = (a[0] == b[0]).all(1) & (a[1] == b[1]).all(1)
    return np.where(same, 1.0, np.clip(share, 0.0, 1.0))


OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, one row for each row of ``docs``.

    Edited: the last floor(n/2) code points are replaced by as many first ones, or all, of
    the next row in ascending (doc_id, text), after the last row by those of the first. A
    null text is empty; a null id comes first. With one row, that row follows itself. An empty
    table gives none.
    Other columns than doc_id and text are ignored.

    Rows move once, to ranges of ids cut at ids of the table; the first row of a range also
    goes to the range before it, so no range needs to see another.
    """
    spark = docs.sparkSession
    ship_package(docs.sparkSession)
    if ranges is None:
        ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / ranges for k in range(1, ranges)]
    seen = docs.agg(
        F.percentile_approx("doc_id", shares or [0.5], 20 * max(ranges, 50)).alias("cuts"),
        F.min("doc_id").alias("least"),
        F.count_if(F.col("doc_id").isNull()).alias("nulls"),
    ).first()
    cuts = sorted(set(seen["cuts"] or [])) if shares else []
    first = F.col("doc_id").isNull() if seen["nulls"] else F.col("doc_id") == F.lit(seen["least"])
    last = len(cuts)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("own", F.coalesce(_range_of(F.col("doc_id"), cuts), F.lit(0)))
    places = F.array(
        F.struct(F.col("own").alias("part"), F.lit(0).alias("tail")),
        F.struct(
            F.when(F.col("doc_id").isin(cuts), F.col("own") - 1).alias("part"),
            F.lit(1).alias("tail"),
        ),
        F.struct(F.when(first, F.lit(last)).alias("part"), F.lit(1).alias("tail")),
    )
    sent = (
        rows.withColumn("place", F.explode(places))
        .where("place.part is not null")
        .select("place.part", "place.tail", "doc_id", "text")
    )
    ordered = sent.repartitionById(last + 1, F.col("part").cast("int")).sortWithinPartitions(
        "part", "tail", "doc_id", "text"
    )
    return ordered.mapInArrow(_compare, OUT)


def _range_of(value: Column, cuts: list[int]) -> Column:
    """How many cuts are at or below the value: a coarse list first, then one fine list."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[k : k + step] for k in range(0, len(cuts), step)]
    coarse = F.size(F.filter(F.lit([g[0] for g in groups]), lambda c: c <= value))
    fine = F.array(*[F.lit(g) for g in groups])
    within = F.size(F.filter(F.element_at(fine, coarse), lambda c: c <= value))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * F.lit(step) + within).cast("int")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: pa.RecordBatch | None = None
    for batch in batches:
        rows = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks()
        rows = rows.to_batches()[0] if rows.num_rows else batch
        if rows.num_rows > 1:
            yield from _pairs(rows)
        held = rows.slice(rows.num_rows - 1, 1)


def _pairs(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Results of all rows but the last, each with the row after it."""
    tail = rows.column(1).to_numpy(zero_copy_only=False)
    bodies = rows.column(3)
    own = fingerprints(bodies)
    chosen = np.flatnonzero(tail[:-1] == 0)
    for at in range(0, len(chosen), 512):
        some = chosen[at : at + 512]
        lengths, digests, edits = [], [], []
        for k in some:
            text = bodies[k].as_py()
            edit = edited_text(text, bodies[k + 1].as_py())
            lengths.append(len(text))
            edits.append(edit)
            digests.append(hashlib.sha256(edit.encode()).hexdigest())
        changed = fingerprints(pa.array(edits, pa.large_string()))
        here = (own[0][some], own[1][some])
        after = (own[0][some + 1], own[1][some + 1])
        yield pa.RecordBatch.from_arrays(
            [
                rows.column(2).take(pa.array(some)),
                pa.array(lengths, pa.int64()),
                pa.array(digests),
                pa.array(encoded(*here)),
                pa.array(encoded(*changed)),
                pa.array(likeness(here, changed)),
                pa.array(likeness(here, after)),
            ],
            names=[column.split()[0] for column in OUT.split(", ")],
        )
