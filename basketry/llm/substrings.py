"""Removal of repeated byte strings, exact, over all documents, with suffix arrays.

Every window of ``WINDOW`` bytes has an anchor chosen by its content, so equal windows meet
in one bucket. Three steps settle which windows began earlier:

1. Contexts (neighbouring windows with one anchor) go to buckets as hashes. Of contexts with
   equal content all but the first are repeated as a whole. An anchor with one content only
   is settled; contexts that share an anchor but not their content, or whose own windows may
   be equal, need a closer look.
2. Only those contexts send their bytes. A bucket sorts their suffixes into an enhanced
   suffix array, and a stack scan of its common-prefix intervals gives the maximal repeats
   with all occurrences; all but the earliest are removed.
3. Ranges meet their documents, which are cut.

Copies within a task are settled before anything is shuffled, and contexts of very frequent
anchors are dealt out window by window, so no bucket grows with one hot passage. Records
move as packed columns, many to a row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import texts
from basketry.llm.anchors import contexts
from basketry.llm.memory import returning
from basketry.llm.suffixes import maximal_repeats
from basketry.session import scratch_path, ship_package

WINDOW, GRAM, MOST = 100, 32, 96
PART_DOCS = 2000  # documents, and buckets of contexts, that one task gets on average
HOT = 2048  # contents of one anchor beyond which its windows are dealt out one by one
ARRAY_SUFFIXES = 200_000  # suffixes sorted at once, whole anchors together

NO_ID = -(1 << 63)
RANGE = [("doc", "<i8"), ("digest", "<u8"), ("start", "<u4"), ("length", "<u4")]
SENT = [
    ("doc", "<i8"),
    ("digest", "<u8"),
    ("start", "<u4"),
    ("windows", "u1"),
    ("low", "<u4"),  # with "high" 40 bits of the anchor's hash
    ("high", "u1"),
]
RECORD = [*SENT, ("content", "<u8"), ("loops", "u1")]
ASKED = [*SENT, ("bucket", "<i4"), ("hot", "u1")]
REPEATED, LOOK, BYTES = 0, 1, 2  # kinds of packed rows


def pack(layout: list[tuple[str, str]], columns: dict[str, np.ndarray], tail: bytes = b"") -> bytes:
    """Columns one after the other behind their length; equal neighbours then compress well."""
    n = len(columns[layout[0][0]])
    body = [columns[name].astype(kind).tobytes() for name, kind in layout]
    return b"".join([np.array(n, "<u4").tobytes(), *body, tail])


def unpack(layout: list[tuple[str, str]], blobs: list[bytes]) -> dict[str, np.ndarray]:
    """Columns of some packed rows together; "tail" has what follows them."""
    parts: dict[str, list[np.ndarray]] = {name: [] for name, _ in layout}
    tails = []
    for blob in blobs:
        n, at = int(np.frombuffer(blob, "<u4", 1)[0]), 4
        for name, kind in layout:
            parts[name].append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
        tails.append(np.frombuffer(blob, np.uint8, offset=at))
    out = {
        name: np.concatenate(parts[name]) if blobs else np.zeros(0, kind) for name, kind in layout
    }
    out["tail"] = np.concatenate(tails) if tails else np.zeros(0, np.uint8)
    return out


def part_of(doc: np.ndarray, parts: int) -> np.ndarray:
    return (texts.mixed(doc.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def keys_of(ids: pa.Array, bodies: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(id, digest of the text): what tells rows apart; a null id comes before all others."""
    import xxhash

    doc = ids.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
    digest = np.array([xxhash.xxh3_64_intdigest(b.as_py() or "") for b in bodies], np.uint64)
    return doc, digest ^ ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint64)


Rows = list[tuple[int, int, bytes]]  # part, kind, packed columns
ROWS = "part int, kind int, data binary"


def _batch(rows: Rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int32()),
            pa.array([r[1] for r in rows], pa.int32()),
            pa.array([r[2] for r in rows], pa.binary()),
        ],
        names=["part", "kind", "data"],
    )


def _by_part(part: np.ndarray, layout, columns: dict[str, np.ndarray], kind: int) -> Rows:
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-2))
    columns = {name: columns[name][order] for name, _ in layout}
    return [
        (int(part[lo]), kind, pack(layout, {n: c[lo:hi] for n, c in columns.items()}))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)
    ]


def _ranges(doc, digest, start, length, parts: int) -> Rows:
    columns = {"doc": doc, "digest": digest, "start": start, "length": length}
    order = np.lexsort((start, digest, doc))
    columns = {k: v[order] for k, v in columns.items()}
    return _by_part(part_of(columns["doc"], parts), RANGE, columns, REPEATED)


def _earliest(
    group: list[np.ndarray], doc: np.ndarray, digest: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by group and place; where groups begin; whether a record is its group's first.

    Records at the place of the first, as of repeated rows, are first, too.
    """
    order = np.lexsort((start, digest, doc, *group[::-1]))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([g[order][1:] != g[order][:-1] for g in group])
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    first = np.logical_and.reduce([v[order] == v[head] for v in (doc, digest, start)])
    return order, new, first


def send_contexts(docs: DataFrame, parts: int) -> DataFrame:
    """Records of all contexts to their buckets; those settled within a batch as ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(1)
            doc, digest = keys_of(batch.column(0), bodies)
            found = [
                (piece.first, contexts(piece, WINDOW, GRAM, MOST)) for piece in texts.slices(bodies)
            ]
            if not found:
                continue
            row = np.concatenate([first + c.text for first, c in found])
            start, windows, anchor, content, loops = (
                np.concatenate([getattr(c, name) for _, c in found])
                for name in ("start", "windows", "anchor", "content", "loops")
            )
            d, g = doc[row], digest[row]
            order, _, first = _earliest([anchor, content], d, g, start)
            again, kept = order[~first], order[first]
            rows = _ranges(d[again], g[again], start[again], windows[again] + WINDOW - 1, parts)
            bucket = (anchor[kept] % np.uint64(parts)).astype(np.int64)
            rest = anchor[kept] // np.uint64(parts)
            columns = {
                "doc": d[kept],
                "digest": g[kept],
                "start": start[kept],
                "windows": windows[kept],
                "low": rest & np.uint64(0xFFFFFFFF),
                "high": (rest >> np.uint64(32)) & np.uint64(0xFF),
                "content": content[kept],
                "loops": loops[kept],
            }
            by_place = np.lexsort((columns["start"], columns["digest"], columns["doc"]))
            columns = {k: v[by_place] for k, v in columns.items()}
            yield _batch(rows + _by_part(bucket[by_place], RECORD, columns, LOOK))

    return docs.select("doc_id", "text").mapInArrow(returning(run), ROWS)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[bytes]]]]:
    """Packed rows by kind, part by part; a task has one part, of bounded size."""
    held: dict[int, dict[int, list[bytes]]] = {}
    for batch in batches:
        for part, kind, data in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            held.setdefault(part, {}).setdefault(kind, []).append(data)
    yield from held.items()


def settle_contexts(sent: DataFrame, parts: int, hot: int = HOT) -> DataFrame:
    """Per document: ranges known to be repeated, and contexts to look at more closely."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _parts(batches):
            out = [(part, REPEATED, data) for data in rows.get(REPEATED, [])]
            r = unpack(RECORD, rows.get(LOOK, []))
            anchor = (r["high"].astype(np.int64) << 32) | r["low"]
            order, new, first = _earliest([anchor, r["content"]], r["doc"], r["digest"], r["start"])
            again = order[~first]
            length = r["windows"][again].astype(np.int64) + WINDOW - 1
            out += _ranges(r["doc"][again], r["digest"][again], r["start"][again], length, parts)
            # Contents of each anchor, counted at the first record of each content.
            sorted_anchor = anchor[order]
            turn = np.ones(len(order), bool)
            turn[1:] = sorted_anchor[1:] != sorted_anchor[:-1]
            number = np.cumsum(turn) - 1
            contents = np.bincount(number[new], minlength=number[-1] + 1 if len(number) else 0)
            several = contents[number] if len(number) else number
            chosen = first & ((several > 1) | (r["loops"][order] > 0))
            look = order[chosen]
            columns = {name: r[name][look] for name, _ in SENT}
            columns["bucket"] = np.full(len(look), part)
            columns["hot"] = (several[chosen] > hot).astype(np.uint8)
            by_doc = np.lexsort((columns["start"], columns["digest"], columns["doc"]))
            columns = {k: v[by_doc] for k, v in columns.items()}
            out += _by_part(part_of(columns["doc"], parts), ASKED, columns, LOOK)
            if out:
                yield _batch(out)

    return sent.repartitionById(parts, "part").mapInArrow(returning(run), ROWS)


def _with_documents(docs: DataFrame, rows: DataFrame, parts: int, kept: list[str]) -> DataFrame:
    """Packed rows and compressed documents of each part in one task, the rows first."""
    schema = T.StructType().add("part", T.IntegerType()).add("kind", T.IntegerType())
    schema.add("data", T.BinaryType()).add("digest", T.LongType()).add("doc", T.LongType())
    for k, name in enumerate(kept):
        schema.add(f"kept{k}", docs.schema[name].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            bodies = batch.column(1)
            doc, digest = keys_of(batch.column(0), bodies)
            data = [squeeze.compress((b.as_py() or "").encode()) for b in bodies]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part_of(doc, parts).astype(np.int32)),
                    pa.array(np.full(len(doc), 9, np.int32)),
                    pa.array(data, pa.binary()),
                    pa.array(digest.view(np.int64)),
                    pa.array(doc),
                    *[batch.column(2 + k) for k in range(len(kept))],
                ],
                names=schema.names,
            )

    carried = [F.col(c).alias(f"kept{k}") for k, c in enumerate(kept)]
    bodies = docs.select("doc_id", "text", *carried)
    both = bodies.mapInArrow(returning(run), schema).unionByName(rows, allowMissingColumns=True)
    return both.repartitionById(parts, "part").sortWithinPartitions("part", "kind")


class Ranges:
    """Packed rows of one part by document, filled before the documents come."""

    def __init__(self, layout, kind: int):
        self.layout, self.kind, self.blobs = layout, kind, []
        self.at: dict[tuple[int, int], tuple[int, int]] | None = None

    def add(self, kind: int, data: bytes) -> None:
        if kind == self.kind:
            self.blobs.append(data)

    def of(self, doc: int, digest: int) -> slice:
        if self.at is None:
            r = unpack(self.layout, self.blobs)
            order = np.lexsort((r["start"], r["digest"], r["doc"]))
            self.columns = {name: r[name][order] for name, _ in self.layout}
            d, g = self.columns["doc"], self.columns["digest"]
            new = np.ones(len(d), bool)
            new[1:] = (d[1:] != d[:-1]) | (g[1:] != g[:-1])
            cuts = np.append(np.flatnonzero(new), len(d)).tolist()
            heads = zip(d[new].tolist(), g[new].tolist(), strict=True)
            self.at = {k: (lo, hi) for k, lo, hi in zip(heads, cuts[:-1], cuts[1:], strict=True)}
        return slice(*self.at.get((doc, digest), (0, 0)))


def send_bytes(docs: DataFrame, settled: DataFrame, parts: int) -> DataFrame:
    """Bytes of the contexts to look at, to the buckets of their anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor()
        part, asked = None, Ranges(ASKED, LOOK)
        for batch in batches:
            picked: dict[str, list[np.ndarray]] = {name: [] for name, _ in ASKED}
            bodies: list[bytes] = []
            columns = [batch.column(k).to_pylist() for k in range(5)]
            for p, kind, data, digest, doc in zip(*columns, strict=True):
                if p != part:
                    part, asked = p, Ranges(ASKED, LOOK)
                if kind != 9:
                    asked.add(kind, data)
                    continue
                at = asked.of(doc, digest % (1 << 64))
                if at.start == at.stop:
                    continue
                text = expand.decompress(data)
                for name in picked:
                    picked[name].append(asked.columns[name][at])
                starts = asked.columns["start"][at].tolist()
                for s, w in zip(starts, asked.columns["windows"][at].tolist(), strict=True):
                    bodies.append(text[s : s + w + WINDOW - 1])
            if bodies:
                columns = {k: np.concatenate(v) for k, v in picked.items()}
                yield _batch(_contexts_out(columns, bodies, parts))

    schema = settled.where(F.col("kind") == LOOK)
    return _with_documents(docs, schema, parts, []).mapInArrow(returning(run), ROWS)


def _contexts_out(r: dict[str, np.ndarray], bodies: list[bytes], parts: int) -> Rows:
    out: Rows = []
    plain = np.flatnonzero(r["hot"] == 0)
    plain = plain[np.argsort(r["bucket"][plain], kind="stable")]
    cuts = np.flatnonzero(np.diff(r["bucket"][plain], prepend=-1, append=-2))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        some = plain[lo:hi]
        tail = b"".join([bodies[k] for k in some.tolist()])
        columns = {name: r[name][some] for name, _ in SENT}
        out.append((int(r["bucket"][some[0]]), BYTES, pack(SENT, columns, tail)))
    hot = np.flatnonzero(r["hot"])
    if len(hot):
        out += _windows_out(r, hot, bodies, parts)
    return out


def _windows_out(
    r: dict[str, np.ndarray], hot: np.ndarray, bodies: list[bytes], parts: int
) -> Rows:
    """Every window of hot contexts by itself, to a bucket by its own hash; of equal windows
    of these documents only the first is sent."""
    data = np.frombuffer(b"".join([bodies[k] for k in hot.tolist()]), np.uint8)
    windows = r["windows"][hot].astype(np.int64)
    base = np.cumsum(windows + WINDOW - 1) - (windows + WINDOW - 1)
    owner = np.repeat(np.arange(len(hot)), windows)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = base[owner] + within
    h = texts.range_hashes(data, place, place + WINDOW)
    doc, digest = r["doc"][hot][owner], r["digest"][hot][owner]
    start = r["start"][hot][owner].astype(np.int64) + within
    order, _, first = _earliest([h], doc, digest, start)
    again, kept = order[~first], order[first]
    out = _ranges(doc[again], digest[again], start[again], np.full(len(again), WINDOW), parts)
    bucket = (h[kept] % np.uint64(parts)).astype(np.int64)
    by_bucket = np.argsort(bucket, kind="stable")
    kept, bucket = kept[by_bucket], bucket[by_bucket]
    rest = h[kept] // np.uint64(parts)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-2))
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        some = kept[lo:hi]
        columns = {
            "doc": doc[some],
            "digest": digest[some],
            "start": start[some],
            "windows": np.ones(len(some), np.uint8),
            "low": rest[lo:hi] & np.uint64(0xFFFFFFFF),
            "high": (rest[lo:hi] >> np.uint64(32)) & np.uint64(0xFF),
        }
        tail = data[(place[some][:, None] + np.arange(WINDOW)).ravel()].tobytes()
        out.append((int(bucket[lo]), BYTES, pack(SENT, columns, tail)))
    return out


def find_repeats(sent: DataFrame, parts: int) -> DataFrame:
    """Ranges of all occurrences but the first of the maximal repeats of every bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _parts(batches):
            out = [(part, REPEATED, data) for data in rows.get(REPEATED, [])]
            r = unpack(SENT, rows.get(BYTES, []))
            for found in _bucket_repeats(r):
                out += _ranges(*found, parts)
            if out:
                yield _batch(out)

    return sent.repartitionById(parts, "part").mapInArrow(returning(run), ROWS)


def _bucket_repeats(r: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
    """(doc, digest, start, length) of repeats, some whole anchors at a time."""
    if not len(r["doc"]):
        return
    windows = r["windows"].astype(np.int64)
    size = windows + WINDOW - 1
    base = np.cumsum(size) - size
    anchor = (r["high"].astype(np.int64) << 32) | r["low"]
    order = np.argsort(anchor, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = anchor[order][1:] != anchor[order][:-1]
    heads = np.append(np.flatnonzero(new), len(order))
    filled = np.concatenate(([0], np.cumsum(windows[order])))
    lo = 0
    while lo < len(order):
        # As many whole anchors as fit, one at least.
        k = np.searchsorted(filled[heads], filled[lo] + ARRAY_SUFFIXES, "right") - 1
        hi = int(heads[max(k, np.searchsorted(heads, lo, "right"))])
        some = order[lo:hi]
        owner = np.repeat(some, windows[some])
        run = np.cumsum(windows[some]) - windows[some]
        within = np.arange(len(owner)) - np.repeat(run, windows[some])
        yield _removed(r, owner, within, base[owner] + within, size[owner] - within)
        lo = hi


def _removed(r, owner, within, place, length) -> tuple[np.ndarray, ...]:
    data = r["tail"]
    # Windows that occur once cannot repeat.
    h = texts.range_hashes(data, place, place + WINDOW) if len(data) < 1 << 26 else None
    if h is not None:
        _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(counts[inverse] > 1)
        owner, within, place, length = owner[twice], within[twice], place[twice], length[twice]
    doc, digest = r["doc"][owner], r["digest"][owner]
    start = r["start"][owner].astype(np.int64) + within
    order = np.lexsort((start, digest, doc))
    new = np.ones(len(order), np.int64)
    new[1:] = np.logical_or.reduce([v[order][1:] != v[order][:-1] for v in (doc, digest, start)])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    before = np.where(within > 0, data[np.maximum(place - 1, 0)].astype(np.int64), -1)
    longest = np.zeros(len(place), np.int64)
    for depth, members in maximal_repeats(data, place, length, before, WINDOW):
        ranks = rank[members]
        later = members[ranks > ranks.min()]
        longest[later] = np.maximum(longest[later], depth)
    hit = np.flatnonzero(longest)
    return doc[hit], digest[hit], start[hit], longest[hit]


def cut(text: bytes, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed runs (from, to) of ranges in any order."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = start.astype(np.int64)
    end = np.minimum(begin + length, len(text))
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:], len(begin)) - 1
    return begin[new], reach[last]


def whole_characters(
    text: bytes, begin: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Runs made smaller so that no character of several bytes is cut."""
    data = np.append(np.frombuffer(text, np.uint8), 0)
    begin, end = begin.copy(), end.copy()
    for _ in range(3):
        begin += (data[begin] & 0xC0) == 0x80
        end -= (data[end] & 0xC0) == 0x80
    keep = begin < end
    return begin[keep], end[keep]


def remove_repeats(
    docs: DataFrame, kept: list[str] | None = None, with_text: bool = False, hot: int = HOT
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Removed is every byte covered by a string of ``WINDOW`` UTF-8 bytes that also starts
    earlier, at a smaller id or before in the same document. A null text is empty, a null id
    comes before all others, rows of one id are ordered by a digest of their text, and equal
    rows of one id count as one document. Texts shorter than the window keep all. An empty
    table gives no rows. ``kept`` names further columns to carry, under their names;
    ``with_text`` adds ``kept_text``, for which removed runs shrink to whole characters.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kept = list(kept or [])
    parts = max(1, math.ceil(docs.count() / PART_DOCS))
    carried = [c for c in kept if c != "doc_id"]
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carried)
    settled = _written(settle_contexts(send_contexts(source, parts), parts, hot), "settled")
    repeats = find_repeats(send_bytes(source, settled, parts), parts)
    ranges = settled.where(F.col("kind") == REPEATED).unionByName(repeats)
    schema = T.StructType([T.StructField("doc_id", T.LongType())])
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema.add(name, T.LongType())
    schema.add("kept_sha256", T.StringType())
    if with_text:
        schema.add("kept_text", T.StringType())
    for c in carried:
        schema.add(source.schema[c])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor()
        part, found = None, Ranges(RANGE, REPEATED)
        for batch in batches:
            out: list[tuple] = []
            picked: list[int] = []
            columns = [batch.column(k).to_pylist() for k in range(5)]
            for row, (p, kind, data, digest, doc) in enumerate(zip(*columns, strict=True)):
                if p != part:
                    part, found = p, Ranges(RANGE, REPEATED)
                if kind != 9:
                    found.add(kind, data)
                    continue
                digest %= 1 << 64
                text = expand.decompress(data)
                at = found.of(doc, digest)
                begin, end = cut(text, found.columns["start"][at], found.columns["length"][at])
                rest = _outside(text, begin, end)
                given = None if _is_null(doc, digest, text) else doc
                result = [given, len(text), int((end - begin).sum()), len(begin)]
                result.append(hashlib.sha256(rest).hexdigest())
                if with_text:
                    result.append(_outside(text, *whole_characters(text, begin, end)).decode())
                out.append(tuple(result))
                picked.append(row)
            if out:
                values = zip(*out, strict=True)
                made = [pa.array(c, _arrow(f)) for c, f in zip(values, schema, strict=False)]
                made += [batch.column(5 + k).take(pa.array(picked)) for k in range(len(carried))]
                yield pa.RecordBatch.from_arrays(made, names=schema.names)

    return _with_documents(source, ranges, parts, carried).mapInArrow(returning(run), schema)


def _arrow(field: T.StructField) -> pa.DataType:
    return pa.string() if isinstance(field.dataType, T.StringType) else pa.int64()


def _is_null(doc: int, digest: int, text: bytes) -> bool:
    import xxhash

    return doc == NO_ID and digest != xxhash.xxh3_64_intdigest(text)


def _outside(text: bytes, begin: np.ndarray, end: np.ndarray) -> bytes:
    at, parts = 0, []
    for lo, hi in zip(begin.tolist(), end.tolist(), strict=True):
        parts.append(text[at:lo])
        at = hi
    parts.append(text[at:])
    return b"".join(parts)


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
