"""Jaccard join and repeated byte strings against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import prose, text_rows

from basketry.llm import jaccard, substrings, suffixes
from basketry.llm.components import components
from basketry.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups_by_hand(rows, size, percent):
    word = re.compile("[^\x20\x09-\x0d]+")
    sets = []
    for _, t in rows:
        w = word.findall(t.translate(LOWER))
        sets.append({tuple(w[a : a + size]) for a in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            ra, rb = root[a], root[b]
            root = [ra if r == rb else r for r in root]
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]].append(i)
    return Counter(
        (i, len(sets[k]), min(least[root[k]], default=i) if sets[k] else i)
        for k, (i, _) in enumerate(rows)
    )


def as_counter(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


@pytest.mark.parametrize(("size", "percent", "area"), [(3, 90, 8000), (5, 80, 8000), (3, 90, 1), (2, 60, 2)])
def test_odd_documents_join(odd_docs, no_docs, size, percent, area):
    got = jaccard.jaccard_join(odd_docs, size, percent, area)
    assert as_counter(got) == groups_by_hand(text_rows(odd_docs), size, percent)
    assert jaccard.jaccard_join(no_docs, size, percent).isEmpty()


def test_chains_and_crowds_of_near_copies(spark):
    """Links at the threshold, chains whose ends are far apart, and a crowd that does not link."""
    base = prose(20, 60).split()
    rows = []
    for k in range(40):  # each differs from the one before in one word
        words = list(base)
        words[:k] = [f"new{j}" for j in range(k)]
        rows.append((k, " ".join(words)))
    for k in range(40):  # all share four fifths
        rows.append((100 + k, " ".join(base[:48] + prose(300 + k, 12).split())))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for percent, area in ((90, 8000), (80, 8000), (80, 5), (95, 8000)):
        expected = groups_by_hand(rows, 3, percent)
        assert as_counter(jaccard.jaccard_join(docs, 3, percent, area)) == expected


def test_join_of_whole_table(spark, folder, documents):
    got = QUERIES["op5_ngram_jaccard_join"](spark, folder)
    assert as_counter(got) == groups_by_hand(text_rows(documents), 3, 90)


def test_near_sets_share_a_region_key():
    rng = np.random.default_rng(0)
    for percent in (60, 80, 90, 95):
        for n in [*range(1, 40), 100, 333]:
            pool = np.sort(rng.integers(0, 1 << 62, n + n, dtype=np.uint64))
            drop = rng.integers(0, n // 4 + 1)
            a = np.sort(pool[:n])
            b = np.sort(np.concatenate((a[drop:], pool[n : n + rng.integers(0, n // 8 + 1)])))
            common = len(np.intersect1d(a, b))
            if 100 * common < percent * (len(a) + len(b) - common) or len(a) == len(b) == common:
                continue
            both = np.concatenate((a, b))
            for share in (0, 2, 5, 10):  # tenths of the shingles that are common
                which, key = jaccard.region_keys(
                    both, np.array([0, len(a), len(both)]), percent, both % np.uint64(10) >= share
                )
                assert set(key[which == 0].tolist()) & set(key[which == 1].tolist())


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 130)] + [(7, 7), (None, 3)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {k: 0 for k in range(21)} | {k: 100 for k in range(100, 130)}
    assert len(got) == 51


# Repeated byte strings


def cut_by_hand(rows):
    ordered = sorted(
        {(i, t) for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, *_digest(r[1], r[0] is None))
    )
    seen, results = set(), {}
    for i, t in ordered:
        data = t.encode()
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - 99):
            w = data[k : k + 100]
            if w in seen:
                gone[k : k + 100] = True
            seen.add(w)
        gone = gone[: len(data)]
        runs = int((np.diff(np.concatenate(([False], gone)).astype(int)) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        results[(i, t)] = (i, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return Counter(results[r] for r in rows)


def _digest(text, null):
    import xxhash

    return (xxhash.xxh3_64_intdigest(text) ^ int(null),)


def as_cut(df):
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return Counter(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("hot", [2048, 1])
def test_odd_documents_are_cut(odd_docs, no_docs, hot):
    assert as_cut(substrings.remove_repeats(odd_docs, hot=hot)) == cut_by_hand(text_rows(odd_docs))
    assert substrings.remove_repeats(no_docs).isEmpty()


def test_cut_of_whole_table(spark, folder, documents):
    got = as_cut(QUERIES["op6_suffix_array_dedup"](spark, folder))
    assert got == cut_by_hand(text_rows(documents))


@pytest.mark.parametrize("hot", [2048, 3])
def test_common_passages_with_many_borders(spark, hot):
    passage = prose(30, 40)
    rows = [(k, prose(400 + k, 5 + k % 7) + passage + prose(500 + k, 9)) for k in range(60)]
    rows += [(100 + k, passage[k : k + 120] * 3) for k in range(0, 40, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert as_cut(substrings.remove_repeats(docs, hot=hot)) == cut_by_hand(rows)


def test_kept_text_has_whole_characters_and_carried_columns(spark):
    passage = "é" * 3 + prose(31, 30) + "日本" + "é" * 4
    rows = [(1, "a" + passage + "b", "x"), (2, "ü" + passage + "ß" + prose(32, 9), "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, data string")
    got = {r["doc_id"]: r for r in substrings.remove_repeats(docs, ["data"], with_text=True).collect()}
    assert got[1]["kept_text"] == rows[0][1] and got[1]["data"] == "x"
    assert got[2]["kept_text"] == "üß" + prose(32, 9) and got[2]["data"] == "y"


def test_maximal_repeats_equal_a_plain_search():
    rng = np.random.default_rng(1)
    for _ in range(30):
        text = bytes(rng.integers(97, 99, 60, dtype=np.uint8))
        data = np.frombuffer(text, np.uint8)
        place = np.arange(len(data))
        before = np.concatenate(([-1], data[:-1].astype(int)))
        got = {
            (depth, tuple(sorted(members.tolist())))
            for depth, members in suffixes.maximal_repeats(data, place, len(data) - place, before, 4)
        }
        expected = set()
        for n in range(4, len(text)):
            at = defaultdict(list)
            for k in range(len(text) - n + 1):
                at[text[k : k + n]].append(k)
            for s, places in at.items():
                if len(places) < 2:
                    continue
                left = {text[k - 1] if k else -1 for k in places}
                right = {text[k + n] if k + n < len(text) else -1 for k in places}
                if len(left) > 1 and len(right) > 1:
                    expected.add((n, tuple(places)))
        assert expected == got
