"""Fingerprints, decontamination, packing and sharding against plain versions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import prose, text_rows

from basketry.llm import decontamination, fingerprints, packing, sharding
from basketry.llm.queries import QUERIES, vocabulary

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Fingerprints


def edited_by_hand(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for k, (i, t) in enumerate(ordered):
        half, nxt = len(t) // 2, ordered[(k + 1) % len(ordered)][1]
        edited = t[: len(t) - half] + nxt[:half]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("ranges", [1, 2, 7])
def test_edited_texts_are_those_of_the_next_row(odd_docs, ranges):
    got = fingerprints.compare_with_next(odd_docs, ranges).collect()
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == edited_by_hand(
        text_rows(odd_docs)
    )


def test_fingerprints_of_equal_texts_are_equal_and_halves_are_near(documents, spark, folder):
    got = QUERIES["op1_document_fingerprints"](spark, folder).collect()
    texts = dict(text_rows(documents))
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == edited_by_hand(
        text_rows(documents)
    )
    marks = defaultdict(set)
    for r in got:
        marks[texts[r["doc_id"]]].add(r["fingerprint"])
    assert all(len(m) == 1 for m in marks.values())
    assert len({next(iter(m)) for m in marks.values()}) == len(marks)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    near = [r["near_edited"] for r in got if r["n_chars"] > 400]
    assert sum(near) / len(near) > 0.4
    assert sum(r["near_next"] for r in got) / len(got) < 0.1


def test_paragraphs_can_be_added_taken_out_and_reordered():
    def of(text):
        return fingerprints.fingerprints(pa.array([text]))

    a, b = prose(1, 40), prose(2, 30)
    both = of(a + "\n" + b)
    for other in (of(b + "\n\n" + a), fingerprints.combined(of(a), of(b))):
        assert (other[0] == both[0]).all() and (other[1] == both[1]).all()
    back = fingerprints.combined(both, of(b), -1)
    assert (back[0] == of(a)[0]).all() and (back[1] == of(a)[1]).all()
    assert (of(a + "\n" + a)[0] != of(a)[0]).any()


def test_likeness_equals_a_plain_count_of_runs():
    def counted(text):
        """Runs of three words of every line; of a shorter line the whole."""
        lanes = Counter()
        for line in text.split("\n"):
            words = line.split()
            runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)] or [tuple(words)] * bool(words)
            lanes.update(runs)
        return lanes

    def plain(a, b):
        x, y = counted(a), counted(b)
        both = sum(n * y[run] for run, n in x.items())
        return 2 * both / (sum(n * n for n in x.values()) + sum(n * n for n in y.values()))

    def likeness(a, b):
        one, other = (fingerprints.fingerprints(pa.array([t])) for t in (a, b))
        return fingerprints.likeness(one, other)[0]

    long = "\n".join(prose(k, 40) for k in range(30))
    half = "\n".join(long.split("\n")[:15] + [prose(100 + k, 40) for k in range(15)])
    assert abs(likeness(long, half) - plain(long, half)) < 0.1
    assert likeness(long, prose(300, 900)) < 0.15
    # More equal runs than 16 bits hold, against half as many.
    for n in (30_000, 70_000, 200_000):
        assert likeness("a " * n, "a " * (n // 2)) == pytest.approx(plain("a " * n, "a " * (n // 2)))


# Decontamination


def hits_by_hand(docs, items, size=10):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").translate(LOWER))
        k = min(size, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[a : a + k])].add(str(i) if i is not None else "null")
    out = []
    for i, t in docs:
        w, hit, found = word.findall(t.translate(LOWER)), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in windows:
                    found |= windows[tuple(w[a : a + k])]
                    hit.update(range(a, a + k))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit)))
    return Counter(out)


def as_counter(df):
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def test_benchmark_hits_equal_a_plain_search(documents, spark, folder):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    got = as_counter(QUERIES["op2_benchmark_decontamination"](spark, folder))
    assert got == hits_by_hand(text_rows(documents), items)


@pytest.mark.parametrize("block_words", [500_000, 40])
def test_odd_items_and_documents(odd_docs, spark, block_words):
    items = [
        (1, prose(2, 60)),
        (2, prose(2, 60)),
        (2, "Two, WORDS"),
        (3, "word"),
        (4, None),
        (5, "!!"),
        (None, prose(8, 12)),
        (6, "word word word"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.decontaminate(odd_docs, bench, block_words=block_words)
    assert as_counter(got) == hits_by_hand(text_rows(odd_docs), items)


def test_empty_tables_have_no_hits(odd_docs, no_docs, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.decontaminate(odd_docs, bench).where("contaminated").isEmpty()
    assert decontamination.decontaminate(no_docs, bench).isEmpty()


def test_proximity_finds_what_moved_apart(spark):
    words = prose(9, 12).split()
    text = " ".join([*words[:4], "extra", *words[4:]])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    assert not decontamination.decontaminate(docs, bench).first()["contaminated"]
    assert decontamination.decontaminate(docs, bench, slop=1).first()["contaminated"]


# Packing


def check_packing(got, rows, sequence=2048):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    expected = Counter()
    for i, t in rows:
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), sequence):
            part = np.array(ids[k : k + sequence], "<u4")
            expected[(i, k // sequence, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= sequence
    return len(places), sum(r["length"] for r in got)


def test_packed_documents(documents, spark, folder):
    got = QUERIES["op4_best_fit_packing"](spark, folder).collect()
    sequences, tokens = check_packing(got, text_rows(documents))
    assert sequences <= 1.01 * tokens / 2048 + 1


def test_any_vocabulary_gives_the_tokenizer_s_ids(documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    for name, by_chunk in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        path = public_tokenizers.path(name)
        tokenizer = Tokenizer.from_file(path)
        known = packing.ChunkIds(tokenizer)
        assert known.by_chunk == by_chunk
        for _, text in text_rows(documents):
            expected = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            assert known.of(text) == expected


def test_packing_odd_documents_in_several_streams(odd_docs, no_docs):
    pieces = packing.token_pieces(odd_docs.withColumnRenamed("n_chars", "length"), vocabulary(), 64)
    got = packing.best_fit(pieces, 64, open_bins=3, tasks=3).collect()
    check_packing(got, text_rows(odd_docs), 64)
    assert packing.pack_documents(no_docs, vocabulary()).isEmpty()


def test_pieces_with_ids_and_too_long_pieces(odd_docs, spark):
    for r in packing.token_pieces(odd_docs, vocabulary(), with_ids=True).collect():
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
    bad = spark.createDataFrame([(1, 0, 9)], "doc_id long, piece int, length long")
    with pytest.raises(Exception, match="fits no sequence"):
        packing.best_fit(bad, 8).collect()


def test_the_fullest_bin_closes_first():
    bins = packing.Bins(10, 2)
    assert [bins.place(n) for n in (6, 5, 9, 5, 4)] == [(0, 0), (1, 0), (2, 0), (1, 5), (3, 0)]


# Sharding


def sharded_by_hand(ids, shards, nodes):
    points = sharding.ring_points(shards, nodes)
    place = sorted(int(hashlib.md5(str("null" if i is None else i).encode()).hexdigest()[:15], 16) for i in ids)
    counts = Counter(sum(p < x for p, _ in points) for x in place)
    room = sharding.capacities(len(ids), shards)
    load = Counter()
    for _, lo, hi, shard, _ in sharding.fill(counts, points, room):
        load[shard] += hi - lo
    return load, room


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_differ_by_one_row_at_most(odd_docs, shards):
    clash = odd_docs.withColumnRenamed("n_chars", "slot")
    got = sharding.bounded_ring(clash, shards).collect()
    rows = text_rows(odd_docs)
    expected = Counter((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected
    load, room = sharded_by_hand([i for i, _ in rows], shards, 64)
    assert Counter(r["shard"] for r in got) == load
    assert sorted(load.values()) == sorted(n for n in room if n)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_whole_table_and_empty_table(spark, folder, documents, no_docs):
    got = QUERIES["op9_sharding"](spark, folder)
    counts = {r["shard"]: r["count"] for r in got.groupBy("shard").count().collect()}
    assert sum(counts.values()) == documents.count()
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 8
    assert got.groupBy("shard", "slot").count().where("count > 1").isEmpty()
    assert sharding.bounded_ring(no_docs).isEmpty()


def test_one_more_shard_moves_few_rows_when_there_is_room():
    ids = range(4000)
    place = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16) for i in ids}

    def owners(shards):
        points = sharding.ring_points(shards, 64)
        arcs = {i: sum(p < x for p, _ in points) for i, x in place.items()}
        by_arc = defaultdict(list)
        for i in sorted(ids, key=place.get):
            by_arc[arcs[i]].append(i)
        counts = {a: len(v) for a, v in by_arc.items()}
        out = {}
        for arc, lo, hi, shard, _ in sharding.fill(counts, points, sharding.capacities(4000, shards, 1.5)):
            out.update(dict.fromkeys(by_arc[arc][lo:hi], shard))
        return out

    before, after = owners(8), owners(9)
    assert sum(before[i] != after[i] for i in ids) < 4000 * 0.25
    with pytest.raises(ValueError, match="at least"):
        sharding.bounded_ring(None, 0)
