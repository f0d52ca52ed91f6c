"""Repair of conversation structure by the cheapest edits.

A conversation must read: perhaps a system turn, then user and assistant in turn, the user
first and the assistant last. Its rows in order are Kept (cost 0), Reroled to user or assistant
(3) or Deleted (4), empty turns are Inserted (3), and a truncated row that stays costs 3 more;
blank and repeated rows must go. A backward dynamic program over four states (nothing yet,
after a system, user or assistant turn) gives the cost of every rest. Its vectors are stored
only at checkpoints, one every square root of the rows; walking forward, the rows between two
checkpoints are worked out again, and of the edits that are tight the one whose initial is
least in ASCII is taken.

A conversation of bounded size is repaired in one task. A longer one is cut into blocks along
its order, whichever tasks hold them: a block's costs from every state to every state chain up
to the vectors between blocks, the states in which its walks end chain up to the one in which
each begins, and then every block walks for itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import isqrt
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.session import scratch_path, ship_package

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER_INSERT = (USER, USER, ASSISTANT, USER)  # the only role that may follow
NAMES = ("", "", "user", "assistant")
END = (0, 6, 3, 0)  # cost of what is missing at the end
FAR = 1 << 60

# Beyond either, a conversation is cut into blocks of these sizes.
MOST_ROWS = 20_000
MOST_BYTES = 32 << 20
BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20

_BLANK, _REPEATED, _CUT, _FINE = range(4)
_CLASS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


def fault(text: str, repeated: bool) -> int:
    """The first fault of a row."""
    body = text.rstrip(SPACES)
    if not body:
        return _BLANK
    if repeated:
        return _REPEATED
    return _FINE if body[-1] in ".!?" else _CUT


def symbol(role: str, found: int) -> int:
    """What the dynamic program sees of a row: class of its role, and whether it must go (2) or
    is truncated (1). A role that begins otherwise, or is empty, fits nowhere."""
    return _CLASS.get(role[:1], 0) + 4 * {_CUT: 1, _FINE: 0}.get(found, 2)


def _kept(state: int, role_class: int) -> int | None:
    """State after a row of the class, if it may follow."""
    if role_class == SYSTEM:
        return SYSTEM if state == START else None
    return role_class if role_class and AFTER_INSERT[state] == role_class else None


@lru_cache(maxsize=None)  # vectors less their minimum, so there are few
def before(seen: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Costs of the rest from every state before a row, less their minimum, and that."""
    must_go, extra, role_class = seen >= 8, TRUNCATED * (4 <= seen < 8), seen % 4
    cost = []
    for state in range(4):
        best = DELETE + after[state]
        if not must_go:
            best = min(best, REROLE + extra + after[AFTER_INSERT[state]])
            kept = _kept(state, role_class)
            if kept is not None:
                best = min(best, extra + after[kept])
        cost.append(best)
    for _ in range(2):
        cost = [min(c, INSERT + cost[AFTER_INSERT[s]]) for s, c in enumerate(cost)]
    least = min(cost)
    return tuple(c - least for c in cost), least


def transfer(symbols: bytes) -> list[int]:
    """Costs from every state before the rows to every state after them, row by row."""
    out = [[FAR] * 4 for _ in range(4)]
    for end in range(4):
        vector, total = tuple(0 if s == end else FAR for s in range(4)), 0
        # Inserts after the last row belong to whatever follows it.
        for seen in reversed(symbols):
            vector, more = before(seen, vector)
            vector = tuple(FAR if v > FAR // 2 else v for v in vector)
            total += more
        for state in range(4):
            out[state][end] = min(FAR, vector[state] + total)
    return [c for row in out for c in row]


def chained(matrix: list[int], after: tuple[int, ...]) -> tuple[int, ...]:
    """The vector before a block, from the vector after it; less its minimum."""
    cost = [min(matrix[4 * s + e] + after[e] for e in range(4)) for s in range(4)]
    least = min(cost)
    return tuple(c - least for c in cost)


class Walk(NamedTuple):
    edits: list[tuple[str, int]]  # initial and the state after it, row by row with inserts
    state: int
    cost: int


def walk(symbols: bytes, state: int, after: tuple[int, ...], last: bool) -> Walk:
    """The cheapest edits from a state, ASCII-least among equals; ``after`` has the costs of
    what follows, ``last`` adds the turns missing at the end."""
    n = len(symbols)
    step = isqrt(n) + 1
    marks, vector = {n: after}, after
    for i in range(n - 1, -1, -1):
        vector, _ = before(symbols[i], vector)
        if i % step == 0:
            marks[i] = vector
    edits: list[tuple[str, int]] = []
    cost = 0
    for low in range(0, n, step):
        high = min(n, low + step)
        vectors, base = [marks[high]], [0]
        for i in range(high - 1, low - 1, -1):
            vector, more = before(symbols[i], vectors[-1])
            vectors.append(vector)
            base.append(more)
        vectors.reverse()
        base.reverse()
        for i in range(low, high):
            here, rest, least = vectors[i - low], vectors[i - low + 1], base[i - low]
            seen = symbols[i]
            extra = TRUNCATED * (4 <= seen < 8)
            while True:
                value = here[state] + least
                follow = AFTER_INSERT[state]
                if DELETE + rest[state] == value:
                    edits.append(("D", state))
                    cost += DELETE
                    break
                if INSERT + here[follow] + least == value:
                    state = follow
                    edits.append(("I", state))
                    cost += INSERT
                    continue
                kept = _kept(state, seen % 4) if seen < 8 else None
                if kept is not None and extra + rest[kept] == value:
                    state = kept
                    edits.append(("K", state))
                    cost += extra
                else:
                    state = follow
                    edits.append(("R", state))
                    cost += REROLE + extra
                break
    while last and END[state]:
        state = AFTER_INSERT[state]
        edits.append(("I", state))
        cost += INSERT
    return Walk(edits, state, cost)


def applied(
    found: Walk, roles: list[str], texts: list[str], copies: list[int]
) -> tuple[str, int, list[dict]]:
    """Audit, cost and repaired turns; the copies of a row after its first are deleted."""
    audit, turns, cost, at = [], [], found.cost, 0
    for initial, state in found.edits:
        audit.append(initial)
        if initial == "I":
            turns.append({"role": NAMES[state], "text": ""})
            continue
        if initial != "D":
            role = roles[at] if initial == "K" else NAMES[state]
            turns.append({"role": role, "text": texts[at]})
        if copies[at] > 1:
            audit.append("D" * (copies[at] - 1))
            cost += DELETE * (copies[at] - 1)
        at += 1
    return "".join(audit), cost, turns


def illegal_pairs(roles: list[str], copies: list[int]) -> int:
    """Neighbours whose initials may not follow one another; copies are neighbours."""
    between = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
    return between + sum(copies) - len(copies)


def fault_counts(faults: Iterable[int], copies: list[int]) -> tuple[int, int, int]:
    """Blank, repeated and truncated rows; a copy of a row that is not blank is repeated."""
    blank = repeated = cut = 0
    for found, n in zip(faults, copies, strict=True):
        if found == _BLANK:
            blank += n
        else:
            repeated += n - 1 + (found == _REPEATED)
            cut += found == _CUT
    return blank, repeated, cut


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PIECE = pa.struct([("role", pa.string()), ("text", pa.string())])


def _schema(kind: str) -> str:
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return f"conv_id {kind}, piece long, {counts}, audit string, turns array<struct<role: string, text: string>>"


def _pieces(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    """Rows of (conv_id, piece, counts, audit, turns)."""
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[0], kind),
            pa.array(columns[1], pa.int64()),
            *[pa.array([c[k] for c in columns[2]], pa.int64()) for k in range(len(COUNTS))],
            pa.array(columns[3], pa.string()),
            pa.array(columns[4], pa.list_(_PIECE)),
        ],
        names=["conv_id", "piece", *COUNTS, "audit", "turns"],
    )


def _whole(conv_id, given: list[tuple]) -> tuple:
    """A conversation from its rows (turn, role, text, copies) in order."""
    given = [g for g in given if g[3] > 0]
    turns, roles, texts, copies = (list(c) for c in zip(*given, strict=True)) if given else ([], [], [], [])
    seen: set[tuple[str, str]] = set()
    faults = []
    for role, text in zip(roles, texts, strict=True):
        faults.append(fault(text, (role, text) in seen))
        seen.add((role, text))
    found = walk(bytes(map(symbol, roles, faults)), START, END, True)
    audit, cost, repaired = applied(found, roles, texts, copies)
    known = {t for t in turns if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    counts = (gaps, *fault_counts(faults, copies), illegal_pairs(roles, copies), cost)
    return conv_id, 0, counts, audit, repaired


def _repair_whole(rows: DataFrame, kind: str) -> DataFrame:
    """Conversations of bounded size, each in one task: sorted by Spark, read as a stream."""
    order = ("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, given, done, size, out_kind = None, [], [], 0, None
        for batch in batches:
            out_kind = batch.column(0).type
            columns = [c.to_pylist() for c in batch.columns]
            for conv_id, *row in zip(*columns, strict=True):
                if given and conv_id != current:
                    done.append(_whole(current, given))
                    given = []
                    if size > BLOCK_BYTES or len(done) >= BLOCK_ROWS:
                        yield _pieces(done, out_kind)
                        done, size = [], 0
                current = conv_id
                size += len(row[2] or "")
                # Of rows that are not there, one is enough to know the conversation.
                if row[3] > 0 or not given:
                    given.append(tuple(row))
        if given:
            done.append(_whole(current, given))
            yield _pieces(done, out_kind)

    dealt = rows.repartition("conv_id").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, _schema(kind))


def _blocks(rows: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Long conversations as written blocks along (conv_id, turn, role, text), and their gaps."""
    spark = rows.sparkSession
    same = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    path = scratch_path(spark, "turns")
    said = F.concat(F.length("role"), F.lit(":"), "role", "text")
    same.withColumn("digest", F.sha2(said, 256)).write.parquet(path)
    runs = spark.read.parquet(path)
    # A text that comes at several turns is repeated at all but the first.
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    often = runs.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n")
    )
    often = often.where("n > 1").drop("n")
    same_text = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    later = F.col("first").isNotNull() & ~place.eqNullSafe(F.col("first"))
    order = ("conv_id", "turn", "role", "text")
    marked = runs.join(often, same_text, "left").select(*order, "copies", later.alias("again"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for conv_id, roles, texts, copies, again, out_kind in _cut(batches):
            faults = [fault(t, a) for t, a in zip(texts, again, strict=True)]
            symbols = bytes(map(symbol, roles, faults))
            counts = [*fault_counts(faults, copies), illegal_pairs(roles, copies)]
            block = {
                "conv_id": pa.array([conv_id], out_kind),
                "piece": pa.array([(part << 32) + seq], pa.int64()),
                "symbols": pa.array([symbols], pa.binary()),
                "roles": pa.array([roles], pa.list_(pa.string())),
                "texts": pa.array([texts], pa.list_(pa.string())),
                "copies": pa.array([copies], pa.list_(pa.int64())),
                "matrix": pa.array([transfer(symbols)], pa.list_(pa.int64())),
                "counts": pa.array([counts], pa.list_(pa.int64())),
                "head": pa.array([roles[0][:1]], pa.string()),
                "tail": pa.array([roles[-1][:1]], pa.string()),
            }
            yield pa.RecordBatch.from_arrays(list(block.values()), names=list(block))
            seq += 1

    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.select("conv_id", "role", "text", "copies", "again")
    path = scratch_path(spark, "blocks")
    dealt.mapInArrow(
        run,
        f"conv_id {kind}, piece long, symbols binary, roles array<string>, texts array<string>, "
        "copies array<long>, matrix array<long>, counts array<long>, head string, tail string",
    ).write.parquet(path)
    missing = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    gaps = runs.groupBy("conv_id").agg(F.coalesce(missing, F.lit(0)).alias("gaps"))
    return spark.read.parquet(path), gaps


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Runs of rows of one conversation, of bounded rows and bytes."""
    current, given, size, kind = None, [], 0, None
    for batch in batches:
        kind = batch.column(0).type
        for conv_id, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if given and (conv_id != current or len(given) >= BLOCK_ROWS or size > BLOCK_BYTES):
                yield (current, *(list(c) for c in zip(*given, strict=True)), kind)
                given, size = [], 0
            current = conv_id
            given.append(tuple(row))
            size += len(row[1])
    if given:
        yield (current, *(list(c) for c in zip(*given, strict=True)), kind)


def _chain_back(table: pa.Table) -> pa.Table:
    """For every block of one conversation: costs after it, whether it is the last, and whether
    its first row may not follow the block before. A block gives a few numbers."""
    rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
    after, out = END, []
    for k in range(len(rows) - 1, -1, -1):
        out.append((rows[k]["piece"], list(after), k == len(rows) - 1))
        after = chained(rows[k]["matrix"], after)
    out.reverse()
    crossing = [0] + [
        int(a["tail"] + b["head"] not in ("su", "ua", "au")) for a, b in zip(rows, rows[1:], strict=False)
    ]
    return pa.table(
        {
            "piece": pa.array([o[0] for o in out], pa.int64()),
            "after": pa.array([o[1] for o in out], pa.list_(pa.int64())),
            "last": pa.array([o[2] for o in out], pa.bool_()),
            "crossing": pa.array(crossing, pa.int64()),
        }
    )


def _chain_on(table: pa.Table) -> pa.Table:
    """For every block of one conversation the state in which its walk begins."""
    state, pieces, states = START, [], []
    for row in sorted(table.to_pylist(), key=lambda r: r["piece"]):
        pieces.append(row["piece"])
        states.append(state)
        state = row["exits"][state]
    return pa.table({"piece": pa.array(pieces, pa.int64()), "state": pa.array(states, pa.int32())})


def _repair_long(rows: DataFrame, kind: str) -> DataFrame:
    """Long conversations: blocks, vectors between them, states between them, walks."""
    spark = rows.sparkSession
    blocks, gaps = _blocks(rows, kind)
    ends = blocks.select("conv_id", "piece", "matrix", "head", "tail").groupBy("conv_id")
    path = scratch_path(spark, "vectors")
    ends.applyInArrow(_chain_back, "piece long, after array<long>, last boolean, crossing long").write.parquet(path)
    vectors = spark.read.parquet(path)

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            ends = [[walk(r["symbols"], s, tuple(r["after"]), False).state for s in range(4)] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ends, pa.list_(pa.int32()))],
                names=["conv_id", "piece", "exits"],
            )

    known = blocks.select("conv_id", "piece", "symbols").join(vectors.select("piece", "after"), "piece")
    left = known.select("conv_id", "piece", "symbols", "after").mapInArrow(
        exits, f"conv_id {kind}, piece long, exits array<int>"
    )
    states = left.groupBy("conv_id").applyInArrow(_chain_on, "piece long, state int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = walk(r["symbols"], r["state"], tuple(r["after"]), r["last"])
                audit, cost, turns = applied(found, r["roles"], r["texts"], r["copies"])
                blank, repeated, cut, illegal = r["counts"]
                counts = (0, blank, repeated, cut, illegal + r["crossing"], cost)
                yield _pieces([(r["conv_id"], r["piece"], counts, audit, turns)], batch.column(0).type)

    ready = blocks.drop("matrix", "head", "tail").join(vectors, "piece").join(states, "piece")
    ready = ready.select("conv_id", *[c for c in ready.columns if c != "conv_id"])
    bare = [F.lit(0).cast("long").alias(c) for c in COUNTS[1:]]
    empty = F.expr("cast(array() as array<struct<role: string, text: string>>)")
    only_gaps = gaps.select(
        "conv_id", F.lit(-1).cast("long").alias("piece"), "gaps", *bare, F.lit("").alias("audit"), empty.alias("turns")
    )
    return ready.mapInArrow(run, _schema(kind)).unionByName(only_gaps)


def repaired_pieces(turns: DataFrame, copies: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Whole conversations, one row each, and the pieces of longer ones, if there are any.

    See :func:`repair`; ``copies`` names a column with how often a row occurs, adjacently, 0 for
    a row that only names its conversation.
    """
    spark = turns.sparkSession
    ship_package(spark)
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else F.col(copies)).cast("long").alias("copies"),
    )
    kind = dict(rows.dtypes)["conv_id"]
    here = F.when(F.col("copies") > 0, 1).otherwise(0)
    sizes = rows.groupBy("conv_id").agg(
        F.sum(here).alias("n"), F.sum(here * F.octet_length("text")).alias("bytes")
    )
    path = scratch_path(spark, "long-conversations")
    sizes.where((F.col("n") > MOST_ROWS) | (F.col("bytes") > MOST_BYTES)).select(
        F.col("conv_id").alias("c")
    ).write.parquet(path)
    long = spark.read.schema(f"c {kind}").parquet(path)
    if long.isEmpty():
        return _repair_whole(rows, kind), None
    is_long = F.col("conv_id").eqNullSafe(F.col("c"))
    some = rows.where("copies > 0").join(long, is_long, "left_semi")
    return _repair_whole(rows.join(long, is_long, "left_anti"), kind), _repair_long(some, kind)


def repair(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """conv_id, piece, gaps, blank, duplicate, truncated, illegal, cost, audit, turns.

    Rows of a conversation are taken by (turn, role, text), null turns first; equal rows are
    adjacent. A null role or text is one space; rows with a null conv_id form one conversation;
    other columns are ignored. An empty role, or one that begins other than with s, u or a, fits
    nowhere. A conversation is one row, or, beyond ``MOST_ROWS`` rows or ``MOST_BYTES`` of text,
    several: their audits and turns follow one another by piece, their numbers add up. An empty
    table gives no rows.
    """
    whole, parts = repaired_pieces(turns, copies)
    return whole if parts is None else whole.unionByName(parts)


def lines(turns: str = "turns") -> Column:
    """``role:text`` of all turns, divided by line feeds."""
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def audits(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """One row for each conversation: the numbers, the audit and repaired_sha256 of
    :func:`lines`. The digest of a long one reads its pieces in order, as a stream of bounded
    blocks; only the audit itself, a letter a row, grows with the conversation."""
    whole, parts = repaired_pieces(turns, copies)
    out = whole.select("conv_id", *COUNTS, "audit", F.sha2(lines(), 256).alias("repaired_sha256"))
    if parts is None:
        return out
    kind = dict(parts.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for r in batch.to_pylist():
                if state is not None and r["conv_id"] != state[0]:
                    yield finished(state, batch.column(0).type)
                    state = None
                if state is None:
                    state = (r["conv_id"], [0] * len(COUNTS), [], hashlib.sha256(), [])
                for k, c in enumerate(COUNTS):
                    state[1][k] += r[c]
                state[2].append(r["audit"])
                if r["some"]:
                    state[3].update(b"\n" * len(state[4]) + r["body"].encode())
                    state[4][:] = [True]
            last_kind = batch.column(0).type
        if state is not None:
            yield finished(state, last_kind)

    def finished(state: tuple, out_kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([state[0]], out_kind),
                *[pa.array([v], pa.int64()) for v in state[1]],
                pa.array(["".join(state[2])]),
                pa.array([state[3].hexdigest()]),
            ],
            names=["conv_id", *COUNTS, "audit", "repaired_sha256"],
        )

    body = parts.select(
        "conv_id", "piece", *COUNTS, "audit", (F.size("turns") > 0).alias("some"), lines().alias("body")
    )
    dealt = body.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return out.unionByName(
        dealt.mapInArrow(run, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")
    )


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: of twenty rows, by hash of ``conv_id:turn``, one is
    dropped (0 copies), one loses its text, one its ``.!?``, one comes twice, one is the user's.
    Nulls are one space."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    hit = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    return turns.select(
        "conv_id",
        "turn",
        F.when(hit == 4, F.lit("user")).otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(hit <= 1, F.lit("")).when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"),
    )
