"""Benchmark decontamination with a positional inverted index of the training documents.

The index holds, for every document, the positions of its words that any benchmark item may
contain; it is written once to the shared folder. Benchmark windows then look for themselves:
each starts from the postings of its rarest term, moves them by the term's place in the
window, and intersects them with the postings of its other terms from rare to frequent.
The benchmark is taken in blocks of bounded size against the whole index.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.llm.bitmaps import bitmap_of, holds
from basketry.llm.memory import returning
from basketry.session import scratch_path, ship_package

WINDOW = 10
BLOCK_WORDS = 500_000  # words of the benchmark that one pass over the index looks for
FILTER_BITS = 22  # the vocabulary filter has 2**22 places whatever the benchmark's size
SLICE_WORDS = 1 << 20
WORD = np.zeros(256, bool)
WORD[np.r_[48:58, 97:123, 128:256]] = True


def _words(column: pa.Array) -> Iterator[tuple[texts.Slice, texts.Words]]:
    for piece in texts.slices(column):
        yield piece, texts.words(piece, WORD, texts.lower_ascii(piece.data))


def benchmark_words(benchmark: DataFrame) -> DataFrame:
    """item_id (as string) and the hashes of its words, in order; null has no words."""
    ship_package(benchmark.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                found.hash[lo:hi].astype(np.int64)
                for piece, found in _words(batch.column(1))
                for lo, hi in _ranges(found, len(piece.bounds) - 1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["item", "words"]
            )

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return items.mapInArrow(returning(run), "item string, words array<long>")


def _ranges(found: texts.Words, n: int) -> Iterator[tuple[int, int]]:
    bounds = np.searchsorted(found.text, np.arange(n + 1))
    return zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)


def build_index(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Postings of every row of ``docs``: row (a number of its own), doc_id, n_words, at, term.

    ``at`` and ``term`` are the positions, ascending, and hashes of the words for which the
    filter ``vocabulary`` (a bitmap of 2**FILTER_BITS places) holds. Written and reread, so
    that the row numbers stay.
    """
    spark = docs.sparkSession
    ship_package(spark)
    wanted = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for piece, found in _words(batch.column(1)):
                n = len(piece.bounds) - 1
                counts = texts.word_counts(found, n)
                begin = np.concatenate(([0], np.cumsum(counts)))
                place = (found.hash & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
                kept = np.flatnonzero(holds(wanted.value, place))
                owner = found.text[kept]
                offsets = pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32())
                at = pa.array((kept - begin[owner]).astype(np.int32))
                term = pa.array(found.hash[kept].astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + n)),
                        batch.column(0).slice(piece.first, n),
                        pa.array(counts.astype(np.int64)),
                        pa.ListArray.from_arrays(offsets, at),
                        pa.ListArray.from_arrays(offsets, term),
                    ],
                    names=["row", "doc_id", "n_words", "at", "term"],
                )
                row += n

    schema = "row long, doc_id long, n_words long, at array<int>, term array<long>"
    path = scratch_path(spark, "postings")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows.mapInArrow(returning(run), schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@dataclass(frozen=True)
class Windows:
    """Distinct windows of a block: term numbers in place, their order from rare to frequent."""

    terms: np.ndarray  # sorted hashes; a term's number is its place here
    place: np.ndarray  # windows x WINDOW, -1 behind the end of a short one
    length: np.ndarray
    order: np.ndarray  # windows x WINDOW, offsets from the rarest term to the most frequent
    first: np.ndarray  # windows by rarest term: those of term t are by_pivot[first[t]:first[t + 1]]
    by_pivot: np.ndarray
    item_first: np.ndarray  # items of window w are item_of[item_first[w]:item_first[w + 1]]
    item_of: np.ndarray
    items: list[str]


def make_windows(items: list[tuple[str, np.ndarray]], counts: dict[int, int], size: int) -> Windows:
    """``counts``: occurrences of each term in the index, by its number."""
    terms = np.unique(np.concatenate([w for _, w in items]).astype(np.uint64))
    names = sorted({i for i, _ in items})
    number = {i: k for k, i in enumerate(names)}
    rows, owners = [], []
    for item, hashes in items:
        ids = np.searchsorted(terms, hashes.astype(np.uint64))
        if len(ids) < size:
            rows.append(np.concatenate((ids, np.full(size - len(ids), -1)))[None, :])
        else:
            rows.append(np.lib.stride_tricks.sliding_window_view(ids, size))
        owners.append(np.full(len(rows[-1]), number[item]))
    place, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    pairs = np.unique(np.stack((which.ravel(), np.concatenate(owners)), 1), axis=0)
    frequency = np.array([counts.get(k, 0) for k in range(len(terms))] + [np.iinfo(np.int64).max])
    order = np.argsort(frequency[place], axis=1, kind="stable")
    pivot = place[np.arange(len(place)), order[:, 0]]
    by_pivot = np.argsort(pivot, kind="stable")
    return Windows(
        terms,
        place,
        (place >= 0).sum(1),
        order,
        np.searchsorted(pivot[by_pivot], np.arange(len(terms) + 1)),
        by_pivot,
        np.searchsorted(pairs[:, 0], np.arange(len(place) + 1)),
        pairs[:, 1],
        names,
    )


def _expand(first: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every key the places first[key] to first[key + 1]: (which key, place)."""
    n = first[keys + 1] - first[keys]
    which = np.repeat(np.arange(len(keys)), n)
    begin = np.concatenate(([0], np.cumsum(n)))[:-1]
    return which, first[keys][which] + np.arange(len(which)) - begin[which]


def find(
    w: Windows, n_words: np.ndarray, owner: np.ndarray, at: np.ndarray, term: np.ndarray, slop: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, window, first position) of all matches in some documents.

    ``n_words``: of each document; ``owner``, ``at``, ``term``: its postings (term numbers).
    ``slop`` 0 finds exact phrases; more finds windows whose terms each stand within so many
    words of their place, counted from the rarest term.
    """
    begin = np.concatenate(([0], np.cumsum(n_words)))
    line = np.full(begin[-1] + 1, -2, np.int64)  # the last place belongs to no document
    line[begin[owner] + at] = term
    key, slot = _expand(w.first, term)
    window = w.by_pivot[slot]
    doc = owner[key]
    start = begin[doc] + at[key] - w.order[window, 0]
    inside = slop > 0 or (start >= begin[doc]) & (start + w.length[window] <= begin[doc + 1])
    keep = np.flatnonzero(np.broadcast_to(inside, start.shape))
    doc, window, start = doc[keep], window[keep], start[keep]
    for k in range(1, w.place.shape[1]):
        if not len(window):
            break
        offset = w.order[window, k]
        wanted = w.place[window, offset]
        ok = wanted < 0
        for move in range(-slop, slop + 1):
            where = start + offset + move
            legal = (where >= begin[doc]) & (where < begin[doc + 1])
            ok |= line[np.where(legal, where, len(line) - 1)] == wanted
        doc, window, start = doc[ok], window[ok], start[ok]
    return doc, window, np.maximum(start - begin[doc], 0)


def search(index: DataFrame, items: list[tuple[str, np.ndarray]], size: int, slop: int = 0) -> DataFrame:
    """Rows with a match: row, hits (alternating first and last-plus-one positions), items."""
    spark = index.sparkSession
    terms = np.unique(np.concatenate([w for _, w in items]).astype(np.uint64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            hashes = batch.column(0).flatten().to_numpy().view(np.uint64)
            k = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
            total += np.bincount(k[terms[k] == hashes], minlength=len(terms))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    counted = index.select("term").mapInArrow(returning(count), "term long, n long").groupBy("term")
    counts = {r["term"]: r["n"] for r in counted.agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(make_windows(items, counts, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            n_words = batch.column(1).to_numpy()
            ends = np.cumsum(n_words)
            first = 0
            while first < len(n_words):
                done = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, done + SLICE_WORDS, "right")))
                yield _matches(w, batch.slice(first, last - first), slop)
                first = last

    schema = "row long, hits array<int>, items array<string>"
    return index.select("row", "n_words", "at", "term").mapInArrow(returning(run), schema)


def _matches(w: Windows, batch: pa.RecordBatch, slop: int) -> pa.RecordBatch:
    n_words = batch.column(1).to_numpy()
    n = len(n_words)
    lengths = np.diff(batch.column(2).offsets.to_numpy())
    owner = np.repeat(np.arange(n), lengths)
    at = batch.column(2).flatten().to_numpy().astype(np.int64)
    hashes = batch.column(3).flatten().to_numpy().view(np.uint64)
    term = np.minimum(np.searchsorted(w.terms, hashes), len(w.terms) - 1)
    known = w.terms[term] == hashes
    doc, window, start = find(w, n_words, owner[known], at[known], term[known], slop)
    rows, hits, items = [], [], []
    order = np.lexsort((start, doc))
    doc, window, start = doc[order], window[order], start[order]
    stop = np.minimum(start + w.length[window], n_words[doc])
    bounds = np.flatnonzero(np.diff(doc, prepend=-1, append=-1))
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        rows.append(batch.column(0)[int(doc[lo])].as_py())
        hits.append(merged(start[lo:hi], stop[lo:hi]))
        _, place = _expand(w.item_first, np.unique(window[lo:hi]))
        items.append([w.items[k] for k in np.unique(w.item_of[place])])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rows, pa.int64()),
            pa.array(hits, pa.list_(pa.int32())),
            pa.array(items, pa.list_(pa.string())),
        ],
        names=["row", "hits", "items"],
    )


def merged(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Maximal disjoint ranges of ranges sorted by their start, as one alternating list."""
    reach = np.maximum.accumulate(stop)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    last = np.concatenate((np.flatnonzero(new)[1:], [len(start)])) - 1
    return np.stack((start[new], reach[last]), 1).ravel().astype(np.int32)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    slop: int = 0,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, hits and items.

    A word is hit if it lies in an occurrence of ``size`` consecutive words of an item, or of
    all words of an item that has fewer. Null texts have no words; items without words match
    nothing; items of one id are one item; a null item_id counts as "null". Repeated rows
    stay; columns other than doc_id, item_id and text are ignored; empty tables give no rows
    or no hits. Words are compared by 64-bit hashes. ``slop`` over 0 also finds windows by
    proximity, see ``find``.
    """
    spark = docs.sparkSession
    items = benchmark_words(benchmark).withColumn("n", F.size("words")).where("n > 0")
    items = items.withColumn("item", F.coalesce("item", F.lit("null")))
    places = items.select(F.explode("words").alias("h")).select(
        F.expr(f"h & {(1 << FILTER_BITS) - 1}").alias("place")
    )
    index = build_index(docs, bitmap_of(places, FILTER_BITS))
    total = items.agg(F.sum("n").alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(total / block_words))
    part = F.pmod(F.xxhash64("item", "words"), F.lit(blocks))
    found = None
    for k in range(blocks):
        block = [(r["item"], np.array(r["words"], np.int64)) for r in items.where(part == k).collect()]
        if block:
            some = search(index, block, size, slop)
            found = some if found is None else found.unionByName(some)
    if found is None:
        found = spark.createDataFrame([], "row long, hits array<int>, items array<string>")
    whole = found.groupBy("row").agg(
        F.collect_list("hits").alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            spans = []
            for lists in frame["hits"]:
                pairs = np.concatenate([np.asarray(x) for x in lists]).reshape(-1, 2)
                pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
                spans.append(merged(pairs[:, 0], pairs[:, 1]))
            frame["hits"] = spans
            frame["n_hit"] = np.array([int((s[1::2] - s[::2]).sum()) for s in spans], np.int64)
            yield frame

    merged_rows = whole.mapInPandas(count, "row long, hits array<int>, items array<string>, n_hit long")
    joined = index.select("row", "doc_id", "n_words").join(merged_rows, "row", "left")
    no_items = F.expr("cast(array() as array<string>)")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", no_items), ","), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        F.coalesce("hits", F.expr("cast(array() as array<int>)")).alias("hits"),
        F.coalesce("items", no_items).alias("items"),
    ).withColumn("n_items", F.size("items").cast("long"))
