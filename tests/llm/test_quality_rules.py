"""The cascade of quality rules against a plain version and SQL."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from conftest_llm import prose, text_rows

from basketry.llm import cascade, texts

BASE = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def plain_counts(text: str) -> tuple[int, ...]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    chars = sum(len(w) for w in words)
    return len(words), chars, symbols, len(lines), len(lines) - len(set(lines)), len(covered)


def plain_verdict(text: str) -> tuple[bool, bool]:
    """(base_failed, kept) with the standard rules, written out."""
    n, chars, symbols, lines, dup, repeated = plain_counts(text)
    base = n < 10 or 100 * repeated > 20 * n
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    filled = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    upper, lower = len(re.findall("[A-Z]", text)), len(re.findall("[a-z]", text))
    known = set(cascade.FUNCTION_WORDS)
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
    bad = (
        100 * symbols > 25 * n
        or 100 * dup > 50 * lines
        or chars > 30 * n
        or 100 * upper > 50 * (upper + lower)
        or 100 * text.count("!") > 30 * n
        or 100 * sum(a == b for a, b in zip(words, words[1:], strict=False)) > 30 * n
        or 100 * sum(not re.search(r"[A-Za-z]|[^\x00-\x7F]", w) for w in words) > 40 * n
        or (lines >= 10 and 100 * sum(x[0] in "*-" for x in filled) > 90 * lines)
        or (n >= 30 and not known & set(low))
    )
    return base, not base and not bad


JUNK = [
    "the " + " | ".join(prose(21, 60).split()),
    "\n".join(f"is\nit\n{prose(200 + k, 12)}" for k in range(6)),
    "x" * 900 + " the of and to in is that for it a",
    prose(23, 40).upper() + " THE",
    "!! ".join(prose(24, 40).split()) + " the",
    " ".join(w + " " + w for w in ("the " + prose(25, 30)).split()),
    " ".join(str(k * 7) for k in range(60)) + " the of and " + prose(26, 30),
    "\n".join(f"- the point {k} {prose(k, 3)}" for k in range(20)),
    prose(27, 50),
    "THE " + prose(28, 50),
    "- the one\n" * 2 + prose(29, 40) + " the\n* a",
    "\n\n \n" + "the " + prose(30, 40) + "\r\n\x0b\x0c",
]


def test_rows_equal_a_plain_version(spark, odd_docs, no_docs):
    more = spark.createDataFrame(
        [(100 + k, t) for k, t in enumerate(JUNK)] + [(None, JUNK[0]), (None, JUNK[0])],
        "doc_id long, text string",
    ).selectExpr("doc_id", "text", "'k' AS kept", "1 AS n_words", "'b' AS bits")
    for docs in (odd_docs, more):
        got = cascade.quality_rules(docs, sample=7).collect()
        expected = [(i, *plain_counts(t), *plain_verdict(t)) for i, t in text_rows(docs)]
        assert Counter((r["doc_id"], *(r[c] for c in BASE), r["base_failed"], r["kept"]) for r in got) == Counter(expected)
        for r in got:
            assert (r["rejected_by"] is None) == r["kept"]
            assert (r["rejected_by"] == "base") == r["base_failed"]
    assert cascade.quality_rules(no_docs).isEmpty()
    assert any(r["rejected_by"] not in (None, "base") for r in got)


def test_every_rule_rejects_something_and_order_changes_no_verdict():
    column = pa.array([*JUNK, None, "", prose(31, 400) + " the"])
    (piece,) = texts.slices(column)
    batch = cascade.Batch(piece, cascade.base_counts(piece))
    kept = cascade.cascade(batch, cascade.RULES) == len(cascade.RULES)
    back = cascade.cascade(batch, cascade.RULES[::-1]) == len(cascade.RULES)
    assert kept.tolist() == back.tolist()
    alone = [cascade.cascade(batch, [rule]) for rule in cascade.RULES]
    assert all((ended == 0).any() for ended in alone)


def test_a_rule_reads_only_what_is_left():
    (piece,) = texts.slices(pa.array(["too short", *JUNK, prose(31, 400) + " the"]))
    batch = cascade.Batch(piece, cascade.base_counts(piece))
    seen = []

    def spy(rule):
        def rejects(given):
            seen.append(len(given.piece.bounds) - 1)
            return rule.rejects(given)

        return cascade.Rule(rule.name, rejects)

    ended = cascade.cascade(batch, [spy(r) for r in cascade.RULES])
    assert seen == [int(((ended >= k) & (ended != -1)).sum()) for k in range(len(seen))]
    assert seen[-1] < seen[0] < len(ended)


def test_order_is_by_rejections_per_cost_among_what_is_left():
    rules = [cascade.Rule(n, None) for n in "abcd"]
    # a and b reject the same half, c another quarter, d nothing; b costs twice as much as a.
    bits = [0b0011] * 4 + [0b0100] * 2 + [0] * 2
    sample = [(b, [1.0, 2.0, 1.0, 0.5]) for b in bits]
    assert [r.name for r in cascade.ordered(rules, sample)] == ["a", "c", "d", "b"]
    assert cascade.ordered(rules, []) == rules
    assert np.all([r.name in "abcd" for r in rules])
