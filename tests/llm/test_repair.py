"""Repair of conversations against a search over all edits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from basketry.llm import repair
from basketry.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = {"u": "user", "a": "assistant"}
BODY = re.compile(r"[^\x20\x09-\x0D]")


def damaged_by_hand(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv_id, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        if hit == 0:
            continue
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub(r"[.!?]", "", text)
        if hit == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * (2 if hit == 3 else 1)
    return out


def in_order(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def faults(rows: list[tuple]) -> list[str]:
    out, seen = [], set()
    for _, _, role, text in rows:
        body = BODY.findall(text)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def searched(rows: list[tuple], found: list[str]) -> tuple[int, str, str]:
    """Cost, audit and repaired text by trying all edits; for short conversations."""
    puts = ["", "u", "a", "ua", "au"]
    options = []
    for (_, _, role, text), f in zip(rows, found, strict=True):
        some = [(4, "D", None)]
        if f not in ("blank", "duplicate"):
            extra = 3 * (f == "truncated")
            some += [(extra, "K", (role, text))] * bool(role)
            some += [(3 + extra, "R", (NAMES[x], text)) for x in "ua"]
        options.append([(3 * len(p) + c, p, e, t) for p in puts for c, e, t in some])
    best = None
    for chosen in itertools.product(*options):
        for end in puts:
            turns, audit = [], ""
            for _, put, edit, turn in chosen:
                audit += "I" * len(put) + edit
                turns += [(NAMES[x], "") for x in put] + ([turn] if turn else [])
            turns += [(NAMES[x], "") for x in end]
            if not re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in turns)):
                continue
            cost = sum(c for c, *_ in chosen) + 3 * len(end)
            given = (cost, audit + "I" * len(end), "\n".join(f"{r}:{t}" for r, t in turns))
            best = given if best is None or given[:2] < best[:2] else best
    return best


def programmed(rows: list[tuple], found: list[str]) -> tuple[int, str, str]:
    """The same by a table over (row, last initial) that carries whole audits."""
    n = len(rows)
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    best: dict = {}
    for i in range(n, -1, -1):
        at = {}
        for last in after:
            some = [(0, "", ())] if i == n and last in ("", "a") else []
            if i < n:
                _, _, role, text = rows[i]
                cost, audit, turns = best[i + 1, last]
                some.append((cost + 4, "D" + audit, turns))
                if found[i] not in ("blank", "duplicate"):
                    extra = 3 * (found[i] == "truncated")
                    if role and role[0] in after[last]:
                        cost, audit, turns = best[i + 1, role[0]]
                        some.append((cost + extra, "K" + audit, (f"{role}:{text}", turns)))
                    for x in after[last].replace("s", ""):
                        cost, audit, turns = best[i + 1, x]
                        some.append((cost + extra + 3, "R" + audit, (f"{NAMES[x]}:{text}", turns)))
            at[last] = some
        for _ in range(4):  # inserts, until nothing changes
            for last in after:
                for x in after[last].replace("s", ""):
                    if at[x]:
                        cost, audit, turns = min(at[x], key=lambda o: o[:2])
                        at[last].append((cost + 3, "I" + audit, (f"{NAMES[x]}:", turns)))
        for last in after:
            best[i, last] = min(at[last], key=lambda o: o[:2])
    cost, audit, turns = best[0, ""]
    lines = []
    while turns:
        lines.append(turns[0])
        turns = turns[1]
    return cost, audit, "\n".join(lines)


def expected(rows: list[tuple], solve=programmed) -> dict:
    """Of every conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, hash."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = {}
    for conv_id, given in groups.items():
        given = in_order(damaged_by_hand(given))
        found = faults(given)
        turns = {r[1] for r in given if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(given, given[1:], strict=False)]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        cost, audit, text = solve(given, found)
        counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256(text.encode()).hexdigest()
        out[conv_id] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def results(df) -> dict:
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in (*repair.COUNTS, "audit", "repaired_sha256")) for r in rows}
    assert len(out) == len(rows)
    return out


def some_rows(seed: int, convs: int, most: int) -> list[tuple]:
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Well", "", " \t", "And?", "x. \n", None, "é…", "Yes.\x1c"]
    roles = ["user"] * 4 + ["assistant"] * 4 + ["system", "tool", "", None, "usher"]
    return [
        (c, r.choice([t, t, t, r.randrange(8), None]), r.choice(roles), r.choice(texts))
        for c in range(convs)
        for t in range(r.randint(1, most))
    ]


def audited(turns):
    return repair.audits(repair.damaged(turns), copies="copies")


def test_short_conversations_equal_a_search_over_all_edits(spark):
    rows = some_rows(1, 60, 3)
    exact = expected(rows, searched)
    assert exact == expected(rows)
    assert results(audited(spark.createDataFrame(rows, SCHEMA).repartition(3))) == exact


@pytest.fixture
def tiny_blocks(monkeypatch):
    monkeypatch.setattr(repair, "MOST_ROWS", 5)
    monkeypatch.setattr(repair, "BLOCK_ROWS", 3)


def odd_rows() -> list[tuple]:
    rows = some_rows(2, 40, 9) + [(None, t, role, text) for _, t, role, text in some_rows(3, 4, 12)]
    rows += [(100, 1, "user", "Hi.")] * 7 + [(101, None, None, None)] * 3
    rows += [(102, t, "user", "Same.") for t in range(30)]
    rows += [(103, 10 * t, "system", f"{t}.") for t in range(12)]
    rows += [(104, t, "assistant" if t % 2 else "user", "a" * 9 * t + "!") for t in range(40)]
    r = random.Random(4)
    return r.sample(rows, len(rows))


def test_odd_conversations(spark):
    rows = odd_rows()
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5)
    clashing = turns.selectExpr("*", "7 AS copies", "'p' AS piece", "1 AS cost", "2 AS n", "3 AS c")
    assert results(audited(clashing)) == expected(rows)
    assert repair.audits(turns.limit(0)).isEmpty()
    assert audited(turns.limit(0)).isEmpty()


def test_long_conversations_in_blocks_give_the_same(spark, tiny_blocks):
    rows = odd_rows()
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert repair.repaired_pieces(turns)[1] is not None
    assert results(audited(turns)) == expected(rows)


def test_long_conversations_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(repair, "MOST_BYTES", 60)
    monkeypatch.setattr(repair, "BLOCK_BYTES", 20)
    rows = some_rows(5, 6, 40)
    assert results(audited(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_whole_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    got = results(QUERIES["op11_conversation_repair"](spark, folder))
    assert got == expected(rows)


def test_turns_are_the_real_output(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "assistant", "A."), (1, 2, "user", "U"), (2, 0, "tool", "T!")]
    got = {r["conv_id"]: r for r in repair.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("system", "S."), ("user", ""), ("assistant", "A.")]
    assert got[1]["audit"] == "KIKD" and got[1]["cost"] == 7
    assert got[2]["audit"] == "D" and got[2]["cost"] == 4


def test_only_checkpoints_are_kept(monkeypatch):
    calls = []
    plain = repair.before.__wrapped__
    monkeypatch.setattr(repair, "before", lambda s, v: calls.append(1) or plain(s, v))
    n = 10_000
    seen = bytes(repair.symbol("user" if k % 2 == 0 else "assistant", 3) for k in range(n))
    found = repair.walk(seen, repair.START, repair.END, True)
    assert "".join(e for e, _ in found.edits) == "K" * n and found.cost == 0
    assert len(calls) == 2 * n  # once backward, once more block by block
