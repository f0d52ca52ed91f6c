"""Exact join of documents by the Jaccard distance of their word shingles.

1. Region keys. The universe of shingles is divided into k classes by hash. Sets that are
   near enough differ in fewer shingles than there are classes, so in some class they are
   equal: the part of a set in a class, hashed, is a region that both are replicated to. k
   follows from the triangle inequality on set sizes, per level of size. Shingles that many
   documents share are left out of these parts, so a common passage makes no region; only a
   set with too few others has regions of all its shingles, too.
2. Regions that share documents are merged into areas, and the sets of an area meet once.
3. In an area, pivots are taken one after another. What is within the threshold of the
   pivot is linked to it (its Voronoi cell); of the others, and of those linked sets that
   the triangle inequality allows to be near one of the others, the join goes on. Areas too
   large for a task take their pivots across tasks, are divided by their rarest shingles and
   then join within tasks.

Sets are compared by 64-bit hashes of shingles; equal sets are joined as one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.llm.bitmaps import bitmap_of, holds
from basketry.llm.components import components
from basketry.llm.memory import returning
from basketry.llm.substrings import ROWS, _batch, _by_part, _parts, unpack
from basketry.session import scratch_path, ship_package

PART_DOCS = 2000
AREA_SETS = 8000  # sets of an area that meet in one task
PIVOT_ROUNDS = 8
GROWTH = 1.3  # of sizes from one level to the next
FILTER_BITS = 24
FREQUENT = 8  # documents with a shingle from which on it is a common one
COMMON_BITS = 26  # places of the table of common shingles, whatever the corpus
FLUSH_KEYS = 250_000
SUB_ROWS = 256  # rows of a batch that are unpacked at once
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False

DOC = [("doc", "<i8"), ("null", "u1"), ("n", "<i8"), ("set", "<u8")]
KEY = [("key", "<u8"), ("set", "<u8")]
EDGE = [("a", "<u8"), ("b", "<u8")]
COUNT = [("low", "<u4"), ("high", "u1"), ("n", "<u2")]
KEYS, DOCS, EDGES = 0, 1, 2


def most_apart(n: int | np.ndarray, percent: int):
    """Shingles in which a set of n can differ from one no smaller that is near enough."""
    return n * (100 - percent) // percent


def levels(percent: int, largest: int) -> np.ndarray:
    """First size of every level; smaller sets are near to equal ones only."""
    first = [-(-percent // (100 - percent))]
    while first[-1] <= largest:
        first.append(max(first[-1] + 1, int(first[-1] * GROWTH)))
    return np.array(first)


def sets_of(piece: texts.Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text of a slice, ascending, and where each begins."""
    found = texts.words(piece, _WORD, texts.lower_ascii(piece.data))
    n = len(piece.bounds) - 1
    text, value = texts.shingles(found, n, size)
    return texts.distinct_per_text(text, value, n)


def set_ids(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """64-bit digest of every set: a sum, so without order; of an empty set 0."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(texts.mixed(values), dtype=np.uint64)))
    sizes = np.diff(begin)
    ids = texts.mixed(sums[begin[1:]] - sums[begin[:-1]] + sizes.astype(np.uint64))
    return np.where(sizes > 0, np.maximum(ids >> np.uint64(1), 1), 0).astype(np.uint64)


def _short(values: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Part and 40 bits of hashes."""
    rest = (values // np.uint64(parts)) & np.uint64((1 << 40) - 1)
    return (values % np.uint64(parts)).astype(np.int64), rest


def _common_place(part: np.ndarray, rest: np.ndarray, parts: int) -> np.ndarray:
    spread = texts.mixed(rest * np.uint64(parts) + part.astype(np.uint64))
    return (spread & np.uint64((1 << COMMON_BITS) - 1)).astype(np.int64)


def common_shingles(docs: DataFrame, size: int, parts: int, least: int = FREQUENT) -> np.ndarray:
    """Bits of the places of all shingles that ``least`` documents have, counted over all.

    Which shingles count as common only decides where sets meet, never which are near.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, waiting = [], 0
            for piece in texts.slices(batch.column(0)):
                held.append(sets_of(piece, size)[0])
                waiting += len(held[-1])
                if waiting > 4 * FLUSH_KEYS:
                    yield _batch(_counted(held, parts))
                    held, waiting = [], 0
            if waiting:
                yield _batch(_counted(held, parts))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _parts(batches):
            r = unpack(COUNT, rows[0])
            rest = (r["high"].astype(np.uint64) << np.uint64(32)) | r["low"]
            order = np.argsort(rest)
            rest, n = rest[order], r["n"][order].astype(np.int64)
            heads = np.flatnonzero(np.append(True, rest[1:] != rest[:-1]))
            often = rest[heads][np.add.reduceat(n, heads) >= least]
            if len(often):
                places = _common_place(np.full(len(often), part), often, parts)
                yield pa.RecordBatch.from_arrays([pa.array(places)], names=["place"])

    counted = docs.select("text").mapInArrow(returning(count), ROWS).repartitionById(parts, "part")
    return bitmap_of(counted.mapInArrow(returning(choose), "place long"), COMMON_BITS)


def _counted(held: list[np.ndarray], parts: int) -> list[tuple[int, int, bytes]]:
    value, n = np.unique(np.concatenate(held), return_counts=True)
    part, rest = _short(value, parts)
    columns = {
        "low": rest & np.uint64(0xFFFFFFFF),
        "high": rest >> np.uint64(32),
        "n": np.minimum(n, 65535),
    }
    return _by_part(part, COUNT, columns, 0)


def _is_rare(values: np.ndarray, common: np.ndarray, parts: int) -> np.ndarray:
    return ~holds(common, _common_place(*_short(values, parts), parts))


def region_keys(
    values: np.ndarray, begin: np.ndarray, percent: int, rare: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(set number, key) of all regions of some sets; ``rare``: shingles that are not common.

    A pair meets on the level of its smaller set, so a set also goes to lower levels that may
    hold a partner. There the pair differs in at most ``apart`` classes. If either set has
    more classes filled with rare shingles, some such class is equal; if neither has, both
    also have regions of all shingles, and if even those are too few, of every shingle.
    """
    rare = np.ones(len(values), bool) if rare is None else rare
    sizes = np.diff(begin)
    first = levels(percent, int(sizes.max(initial=1)))
    own = np.searchsorted(first, sizes, "right") - 1
    least = -(-sizes * percent // 100)  # the smallest partner
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for lower in range(int(own.max(initial=0)) + 1):
        level = own - lower
        use = level >= 0
        if lower:
            use &= least < first[np.maximum(level + 1, 0)]
        which = np.flatnonzero(use)
        if not len(which):
            break
        apart = most_apart(first[level[which] + 1] - 1, percent)
        classes = (apart * 11 + 9) // 10 + 2
        n = sizes[which]
        owner = np.repeat(np.arange(len(which)), n)
        at = np.repeat(begin[which] - np.cumsum(n) + n, n) + np.arange(len(owner))
        spread = texts.mixed(values[at] + np.uint64(77))
        tops = np.concatenate(([0], np.cumsum(classes)))
        number = (spread >> np.uint64(20)) % classes[owner].astype(np.uint64)
        cell = tops[owner] + number.astype(np.int64)
        chosen, poor = rare[at], None
        for family in (0, 1):
            of, number, sums = _filled(cell[chosen], spread[chosen], tops)
            tag = (level[which][of] * 2 + family) * 1_000_003 + number + 1
            out.append((which[of], texts.mixed(sums ^ texts.mixed(tag.astype(np.uint64)))))
            few = np.bincount(of, minlength=len(which)) <= apart
            poor = few if poor is None else poor & few
            chosen = poor[owner]
            if not chosen.any():
                break
        else:
            tag = (level[which][owner[chosen]] + 1 << 40).astype(np.uint64)
            out.append((which[owner[chosen]], texts.mixed(spread[chosen] ^ texts.mixed(tag))))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([o for o, _ in out]), np.concatenate([k for _, k in out])


def _filled(cell: np.ndarray, spread: np.ndarray, tops: np.ndarray):
    """Filled classes: number of the set, number of the class, sum of what is in it."""
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    heads = np.flatnonzero(np.diff(cell, prepend=-1))
    sums = np.add.reduceat(spread[order], heads) if len(heads) else spread[:0]
    of = np.searchsorted(tops, cell[heads], "right") - 1
    return of, cell[heads] - tops[of], sums


def send_keys(
    docs: DataFrame, size: int, percent: int, parts: int, common: np.ndarray
) -> DataFrame:
    """Packed rows: region keys of every distinct set of a batch, and every row's set."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            null = ids.is_null().to_numpy(zero_copy_only=False)
            doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
            keys, owners, waiting = [], [], 0
            seen: set[int] = set()
            for piece in texts.slices(batch.column(1)):
                values, begin = sets_of(piece, size)
                sets = set_ids(values, begin)
                rows = slice(piece.first, piece.first + len(sets))
                columns = {"doc": doc[rows], "null": null[rows], "n": np.diff(begin), "set": sets}
                owner = (sets % np.uint64(parts)).astype(np.int64)
                yield _batch(_by_part(owner, DOC, columns, DOCS))
                which = _unseen(sets, sets > 0, seen)
                n = np.diff(begin)[which]
                at = np.repeat(begin[which] - np.cumsum(n) + n, n) + np.arange(n.sum())
                some = values[at]
                rare = _is_rare(some, shared.value, parts)
                of, key = region_keys(some, np.concatenate(([0], np.cumsum(n))), percent, rare)
                keys.append(key)
                owners.append(sets[which][of])
                waiting += len(key)
                if waiting > FLUSH_KEYS:
                    yield _batch(_keys_out(keys, owners, parts))
                    keys, owners, waiting = [], [], 0
            if waiting:
                yield _batch(_keys_out(keys, owners, parts))

    return docs.select("doc_id", "text").mapInArrow(returning(run), ROWS)


def _unseen(sets: np.ndarray, wanted: np.ndarray, seen: set[int]) -> np.ndarray:
    """Numbers of the wanted sets that have not come before, which they now have."""
    new = []
    for k in np.flatnonzero(wanted).tolist():
        one = int(sets[k])
        if one not in seen:
            seen.add(one)
            new.append(k)
    return np.array(new, np.int64)


def _keys_out(keys: list[np.ndarray], owners: list[np.ndarray], parts: int):
    columns = {"key": np.concatenate(keys), "set": np.concatenate(owners)}
    bucket = (columns["key"] % np.uint64(parts)).astype(np.int64)
    return _by_part(bucket, KEY, columns, KEYS)


def meet(sent: DataFrame, parts: int) -> DataFrame:
    """Packed rows: every row's set as it came, and a star of edges for each shared region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _parts(batches):
            out = [(part, DOCS, data) for data in rows.get(DOCS, [])]
            r = unpack(KEY, rows.get(KEYS, []))
            order = np.lexsort((r["set"], r["key"]))
            key, member = r["key"][order], r["set"][order]
            new = np.ones(len(order), bool)
            new[1:] = key[1:] != key[:-1]
            center = member[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            apart = center != member
            pairs = np.unique(np.stack((center[apart], member[apart]), 1), axis=0)
            if len(pairs):
                columns = {"a": pairs[:, 0], "b": pairs[:, 1]}
                out += _by_part(np.zeros(len(pairs), np.int64), EDGE, columns, EDGES)
            if out:
                yield _batch(out)

    return sent.repartitionById(parts, "part").mapInArrow(returning(run), ROWS)


def _plain(rows: DataFrame, kind: int, layout, schema: str) -> DataFrame:
    """Packed rows of one kind as ordinary rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = unpack(layout, batch.column(0).to_pylist())
            arrays = []
            for name, _ in layout:
                if name == "null":
                    continue
                mask = r["null"].astype(bool) if name == "doc" else None
                arrays.append(pa.array(r[name].astype(np.int64), mask=mask))
            names = [name for name, _ in layout if name != "null"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.where(F.col("kind") == kind).select("data").mapInArrow(returning(run), schema)


def _candidate_sets(docs: DataFrame, areas: DataFrame, size: int) -> DataFrame:
    """(set, items) of the sets of ``areas``, one row each. A filter of fixed size keeps most
    other sets from being sent; the join drops the rest."""
    mask = (1 << FILTER_BITS) - 1
    places = areas.select(F.col("node").bitwiseAND(mask).alias("place"))
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap_of(places, FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            for piece in texts.slices(batch.column(0)):
                values, begin = sets_of(piece, size)
                sets = set_ids(values, begin)
                likely = holds(wanted.value, (sets & np.uint64(mask)).astype(np.int64)) & (sets > 0)
                new = _unseen(sets, likely, seen)
                if len(new):
                    items = [values[begin[k] : begin[k + 1]].tobytes() for k in new.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sets[new].astype(np.int64)), pa.array(items, pa.binary())],
                        names=["set", "items"],
                    )

    found = docs.select("text").mapInArrow(returning(run), "set long, items binary")
    return found.groupBy("set").agg(F.first("items").alias("items"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SUB_ROWS):
            yield batch.slice(at, SUB_ROWS)


class Area:
    """Sets that may be near each other; ``root`` numbers those known to be connected."""

    def __init__(self, items: list[np.ndarray], percent: int):
        self.percent = percent
        self.sizes = np.array([len(x) for x in items])
        self.begin = np.concatenate(([0], np.cumsum(self.sizes)))
        universe, self.item = np.unique(np.concatenate(items), return_inverse=True)
        self.universe = len(universe)
        self.root = np.arange(len(items))

    def _places(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.sizes[some]
        heads = np.cumsum(n) - n
        return np.repeat(self.begin[some] - heads, n) + np.arange(n.sum()), heads

    def shared(self, one: int, some: np.ndarray) -> np.ndarray:
        """Shingles that each of some sets has in common with one."""
        mark = np.zeros(self.universe, np.int64)
        mark[self.item[self.begin[one] : self.begin[one + 1]]] = 1
        place, heads = self._places(some)
        return np.add.reduceat(mark[self.item[place]], heads)

    def near(self, one: int, some: np.ndarray, shared: np.ndarray) -> np.ndarray:
        union = self.sizes[some] + self.sizes[one] - shared
        return 100 * shared >= self.percent * union

    def link(self, one: int, some: np.ndarray) -> None:
        roots = np.unique(np.append(self.root[some], self.root[one]))
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]

    def join(self, rounds: int = PIVOT_ROUNDS) -> np.ndarray:
        """Roots after all links; exact."""
        left = np.arange(len(self.sizes))
        for _ in range(rounds):
            if len(left) < 2:
                return self.root
            left = self.cell(left)
        if len(np.unique(self.root[left])) > 1:
            self._by_prefixes(left)
        return self.root

    def cell(self, left: np.ndarray) -> np.ndarray:
        """Link the cell of one pivot; what must still be joined, sets outside it first."""
        pivot = int(left[0])
        shared = self.shared(pivot, left)
        linked = self.near(pivot, left, shared)
        self.link(pivot, left[linked])
        if linked.all():
            return left[:0]
        distance = 1 - shared / (self.sizes[left] + self.sizes[pivot] - shared)
        # Both distances are to the pivot, so they differ by no more than the pair is apart.
        edge = distance[~linked].min() - (1 - self.percent / 100) - 1e-9
        return np.concatenate((left[~linked], left[linked & (distance >= edge)]))

    def _by_prefixes(self, left: np.ndarray) -> None:
        """Pairs that share one of their rarest shingles; near sets cannot but do."""
        place, heads = self._places(left)
        item = self.item[place]
        owner = np.repeat(np.arange(len(left)), self.sizes[left])
        count = np.bincount(item, minlength=self.universe)
        order = np.lexsort((item, count[item], owner))
        within = np.arange(len(order)) - heads[owner[order]]
        n = self.sizes[left][owner[order]]
        kept = order[within < n - -(-n * self.percent // 100) + 1]
        by_item = np.lexsort((owner[kept], item[kept]))
        posting_item, posting_owner = item[kept][by_item], owner[kept][by_item]
        first = np.searchsorted(posting_item, np.arange(self.universe + 1))
        by_owner = np.argsort(owner[kept], kind="stable")
        own_items = item[kept][by_owner]
        own_first = np.searchsorted(owner[kept][by_owner], np.arange(len(left) + 1))
        for one in range(len(left)):
            mine = own_items[own_first[one] : own_first[one + 1]]
            shared = mine[first[mine + 1] - first[mine] > 1].tolist()
            lists = [posting_owner[first[i] : first[i + 1]] for i in shared]
            if not lists:
                continue
            others = np.unique(np.concatenate(lists))
            others = others[others > one]
            here = left[one]
            others = left[others]
            small = np.minimum(self.sizes[others], self.sizes[here])
            large = np.maximum(self.sizes[others], self.sizes[here])
            likely = 100 * small >= self.percent * large
            others = others[likely & (self.root[others] != self.root[here])]
            if len(others):
                common = self.shared(here, others)
                self.link(here, others[self.near(here, others, common)])


def _join_areas(members: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) of near sets, enough to connect all that are, from (area, set, items)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        area, sets, items = None, [], []

        def settled() -> pa.RecordBatch:
            order = np.argsort(sets)
            root = Area([items[k] for k in order], percent).join()
            ids = np.array(sets)[order]
            moved = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids[moved]), pa.array(ids[root[moved]])], names=["a", "b"]
            )

        for batch in _cut(batches):
            columns = (batch.column(k).to_pylist() for k in range(3))
            for where, one, data in zip(*columns, strict=True):
                if where != area:
                    if len(sets) > 1:
                        yield settled()
                    area, sets, items = where, [], []
                sets.append(one)
                items.append(np.frombuffer(data, np.uint64))
        if len(sets) > 1:
            yield settled()

    ordered = members.repartition("area").sortWithinPartitions("area")
    return ordered.select("area", "set", "items").mapInArrow(returning(run), "a long, b long")


def _pivot_round(members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """One pivot for every large area, across tasks: its edges, and what must still be joined."""
    order = F.struct("inner", "set")
    pivots = members.groupBy("area").agg(
        F.min_by("items", order).alias("p_items"), F.min_by("set", order).alias("p_set")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches):
            shared, sizes = [], []
            for mine, other in zip(batch.column(2), batch.column(4), strict=True):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (mine, other))
                shared.append(len(np.intersect1d(a, b, assume_unique=True)))
                sizes.append(len(b))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(k) for k in range(4)],
                    pa.array(shared, pa.int64()),
                    pa.array(sizes, pa.int64()),
                ],
                names=["area", "set", "items", "p_set", "shared", "p_size"],
            )

    measured = (
        members.join(pivots, "area")
        .select("area", "set", "items", "p_set", "p_items")
        .mapInArrow(returning(run), "area long, set long, items binary, p_set long, shared long, p_size long")
    )
    union = F.length("items") / 8 + F.col("p_size") - F.col("shared")
    measured = _kept(
        measured.withColumns(
            {
                "linked": 100 * F.col("shared") >= percent * union,
                "distance": 1 - F.col("shared") / union,
            }
        ),
        "cells",
    )
    edges = measured.where("linked and set <> p_set").select(
        F.col("set").alias("a"), F.col("p_set").alias("b")
    )
    outer = measured.where("not linked").groupBy("area").agg(F.min("distance").alias("edge"))
    left = measured.join(outer, "area").where(
        ~F.col("linked") | (F.col("distance") >= F.col("edge") - (1 - percent / 100) - 1e-9)
    )
    return edges, left.select("area", "set", "items", F.col("linked").cast("int").alias("inner"))


def _by_rarest(members: DataFrame, percent: int) -> DataFrame:
    """Members of large areas, replicated to a smaller area for each of their rarest shingles."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches):
            items = [np.frombuffer(b.as_buffer(), np.int64) for b in batch.column(1)]
            n = np.array([len(x) for x in items])
            columns = (np.repeat(batch.column(0).to_numpy(), n), np.concatenate(items), np.repeat(n, n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["set", "item", "n"]
            )

    single = members.select("set", "items").mapInArrow(returning(spread), "set long, item long, n long")
    frequency = single.groupBy("item").agg(F.count(F.lit(1)).alias("df"))
    ranked = (
        single.join(frequency, "item")
        .groupBy("set", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "item"))).alias("ordered"))
    )
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    rarest = F.slice("ordered", F.lit(1), prefix.cast("int"))
    regions = ranked.select("set", F.explode(rarest).alias("r"))
    shared = regions.select("set", F.col("r.item").alias("area")).where("r.df > 1")
    items = members.select("set", "items").dropDuplicates(["set"])
    return shared.join(items, "set").select("area", "set", "items")


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def jaccard_join(
    docs: DataFrame, size: int = 3, percent: int = 90, area_sets: int = AREA_SETS
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id.

    Words are runs of bytes other than white space, A-Z lower-cased; a text with fewer than
    ``size`` words, but some, has one shingle. Two rows link when their shingles' Jaccard
    similarity is ``percent`` / 100 at least. component_id: the smallest id reachable by
    links. A row without words links with nothing and has its own id, as has a row whose id is
    null and whose component has no other. Repeated rows stay and link; an empty table gives no rows.
    """
    if not 50 <= percent <= 99:
        raise ValueError("percent must lie between 50 and 99")
    ship_package(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = max(1, math.ceil(source.count() / PART_DOCS))
    common = common_shingles(source, size, parts)
    met = _kept(meet(send_keys(source, size, percent, parts, common), parts), "regions")
    rows = _plain(met, DOCS, DOC, "doc long, n long, set long")
    edges = _plain(met, EDGES, EDGE, "a long, b long").distinct()
    areas = _kept(components(edges), "areas")
    links = _area_links(source, areas, size, percent, area_sets)
    roots = components(links)
    placed = rows.join(roots, rows["set"] == roots["node"], "left").select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("root", "set").alias("group"),
    )
    least = placed.where("n_shingles > 0").groupBy("group").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "group", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id")
    )


def _area_links(docs: DataFrame, areas: DataFrame, size: int, percent: int, most: int) -> DataFrame:
    counted = areas.groupBy("root").agg(F.count(F.lit(1)).alias("sets"))
    items = _candidate_sets(docs, areas, size)
    members = items.join(areas, items["set"] == areas["node"]).select(
        F.col("root").alias("area"), "set", "items"
    )
    large = counted.where(F.col("sets") > most).select(F.col("root").alias("area"))
    if large.isEmpty():
        return _join_areas(members, percent)
    members = _kept(members, "members")
    links = _join_areas(members.join(large, "area", "left_anti"), percent)
    left = members.join(large, "area", "left_semi").withColumn("inner", F.lit(0))
    for _ in range(PIVOT_ROUNDS):
        edges, left = _pivot_round(left, percent)
        links = links.unionByName(edges)
    return links.unionByName(_join_areas(_by_rarest(left, percent), percent))
