"""Quality rules as a short-circuit cascade.

The counts that every row returns are taken first. What they leave undecided goes through the
rules one after another, and a rule reads only the texts that every rule before it passed. A
bounded sample tells what each rule costs and which texts it rejects; the next rule is always
the one that rejects most of what is left of the sample for its cost. A text is kept if no rule
rejects it, so the order, which depends on measured time, moves work and never a verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import texts
from basketry.llm.texts import Slice
from basketry.session import ship_package

# Frequent words of the languages that the corpus is expected to have.
FUNCTION_WORDS = tuple(
    "the of and to in is that for it as was with be by on "
    "de la le et les des en un du une que est pour qui "
    "der die und den von zu das mit sich auf für ist "
    "el y a los se del las por con".split()
)

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_WORD = ~_SPACES
_LINE = np.ones(256, bool)
_LINE[0x0A] = False
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LOWER = (np.arange(256) >= 97) & (np.arange(256) <= 122)
_LETTER = _UPPER | _LOWER | (np.arange(256) >= 128)
_START = (np.arange(256) < 0x80) | (np.arange(256) >= 0xC0)  # first byte of a code point
_BULLETS = (0x2A, 0x2D)  # * and -

BASE = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


class Batch(NamedTuple):
    """Some texts and their base counts, in the same order."""

    piece: Slice
    counts: dict[str, np.ndarray]

    def taken(self, chosen: np.ndarray) -> Batch:
        """The texts of the numbers ``chosen``, ascending, end to end."""
        bounds = self.piece.bounds
        length = (bounds[1:] - bounds[:-1])[chosen]
        inside = np.zeros(len(self.piece.data) + 1, np.int8)
        some = chosen[length > 0]
        np.add.at(inside, bounds[some], 1)
        np.add.at(inside, bounds[some + 1], -1)
        marks = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        data = self.piece.data[marks]
        piece = Slice(0, data, np.concatenate(([0], np.cumsum(length))))
        return Batch(piece, {k: v[chosen] for k, v in self.counts.items()})


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many bytes of every text have the flag."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeated(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether (text, value) occurs twice or more, and whether it is not the first time."""
    order = np.lexsort((value, text))  # stable: earlier places come first
    same = (text[order][1:] == text[order][:-1]) & (value[order][1:] == value[order][:-1])
    again = np.concatenate((np.zeros(min(1, len(order)), bool), same))
    twice = again.copy()
    twice[:-1] |= same
    out = np.empty((2, len(order)), bool)
    out[0, order], out[1, order] = twice, again
    return out[0], out[1]


def base_counts(piece: Slice, window: int = 5) -> dict[str, np.ndarray]:
    """The base counts of every text of a slice."""
    data, bounds, n = piece.data, piece.bounds, len(piece.bounds) - 1
    found = texts.words(piece, _WORD)
    lines = texts.words(piece, _LINE)
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_WORD[data], out=filled[1:])
    has_word = filled[lines.end] > filled[lines.start]
    line_text, line_hash = lines.text[has_word], lines.hash[has_word]
    again = _repeated(line_text, line_hash)[1]
    counts = texts.word_counts(found, n)
    ends = np.cumsum(counts)
    begins = np.arange(len(found.text))
    begins = begins[begins + window <= ends[found.text]] if len(found.text) else begins
    covered = np.zeros(len(found.text) + 1, np.int64)
    if len(begins):
        value = np.zeros(len(begins), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(window):
                value = texts.mixed(value + found.hash[begins + k] + np.uint64(k + 1))
        twice = begins[_repeated(found.text[begins], value)[0]]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + window, -1)
    repeated = np.cumsum(covered[:-1]) > 0
    return {
        "n_words": counts.astype(np.int64),
        "word_chars": _per_text(_WORD[data] & _START[data], bounds),
        "n_symbols": _per_text(_SYMBOL[data], bounds),
        "n_lines": np.bincount(line_text, minlength=n).astype(np.int64),
        "n_dup_lines": np.bincount(line_text[again], minlength=n).astype(np.int64),
        "n_repeat_words": np.bincount(found.text[repeated], minlength=n).astype(np.int64),
    }


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    n = counts["n_words"]
    return (n < 10) | (100 * counts["n_repeat_words"] > 20 * n)


class Rule(NamedTuple):
    """``rejects`` takes a Batch and says for each of its texts whether it fails."""

    name: str
    rejects: Callable[[Batch], np.ndarray]


def more_than(batch: Batch, percent: int, part: str, whole: str) -> np.ndarray:
    """One base count is more than a share of another."""
    return 100 * batch.counts[part] > percent * batch.counts[whole]


def long_words(batch: Batch, chars: int) -> np.ndarray:
    """Words are longer on average than ``chars`` code points."""
    return batch.counts["word_chars"] > chars * batch.counts["n_words"]


def shouting(batch: Batch, percent: int) -> np.ndarray:
    """Capitals are more than a share of the letters A-Z and a-z."""
    data, bounds = batch.piece.data, batch.piece.bounds
    upper = _per_text(_UPPER[data], bounds)
    return 100 * upper > percent * (upper + _per_text(_LOWER[data], bounds))


def exclaiming(batch: Batch, percent: int) -> np.ndarray:
    """Exclamation marks are more than a share of the words."""
    marks = _per_text(batch.piece.data == 0x21, batch.piece.bounds)
    return 100 * marks > percent * batch.counts["n_words"]


def stuttering(batch: Batch, percent: int) -> np.ndarray:
    """Words equal to the word before them are more than a share of the words."""
    found = texts.words(batch.piece, _WORD)
    same = (found.hash[1:] == found.hash[:-1]) & (found.text[1:] == found.text[:-1])
    count = np.bincount(found.text[1:][same], minlength=len(batch.piece.bounds) - 1)
    return 100 * count > percent * batch.counts["n_words"]


def letterless(batch: Batch, percent: int) -> np.ndarray:
    """Words without a letter are more than a share of the words. A byte beyond ASCII counts
    as a letter."""
    found = texts.words(batch.piece, _WORD)
    letters = np.zeros(len(batch.piece.data) + 1, np.int64)
    np.cumsum(_LETTER[batch.piece.data], out=letters[1:])
    without = letters[found.end] == letters[found.start]
    count = np.bincount(found.text[without], minlength=len(batch.piece.bounds) - 1)
    return 100 * count > percent * batch.counts["n_words"]


def listing(batch: Batch, percent: int, least: int) -> np.ndarray:
    """Of ``least`` lines or more, more than a share begin with ``-`` or ``*``."""
    lines = texts.words(batch.piece, _LINE)
    filled = np.zeros(len(batch.piece.data) + 1, np.int64)
    np.cumsum(_WORD[batch.piece.data], out=filled[1:])
    marked = np.isin(batch.piece.data[lines.start], _BULLETS)
    marked &= filled[lines.end] > filled[lines.start]
    count = np.bincount(lines.text[marked], minlength=len(batch.piece.bounds) - 1)
    n = batch.counts["n_lines"]
    return (n >= least) & (100 * count > percent * n)


def no_function_words(batch: Batch, known: tuple[str, ...], least: int) -> np.ndarray:
    """``least`` words or more, and not one of the ``known`` ones, A-Z lower-cased."""
    listed = "\0".join(known).encode()
    parts = np.cumsum([0, *[len(w.encode()) + 1 for w in known]])
    values = texts.range_hashes(np.frombuffer(listed, np.uint8), parts[:-1], parts[1:] - 1)
    found = texts.words(batch.piece, _WORD, texts.lower_ascii(batch.piece.data))
    hits = np.isin(found.hash, values)
    count = np.bincount(found.text[hits], minlength=len(batch.piece.bounds) - 1)
    return (batch.counts["n_words"] >= least) & (count == 0)


RULES = (
    Rule("symbols", partial(more_than, percent=25, part="n_symbols", whole="n_words")),
    Rule("duplicate_lines", partial(more_than, percent=50, part="n_dup_lines", whole="n_lines")),
    Rule("long_words", partial(long_words, chars=30)),
    Rule("shouting", partial(shouting, percent=50)),
    Rule("exclaiming", partial(exclaiming, percent=30)),
    Rule("stuttering", partial(stuttering, percent=30)),
    Rule("letterless", partial(letterless, percent=40)),
    Rule("listing", partial(listing, percent=90, least=10)),
    Rule("no_function_words", partial(no_function_words, known=FUNCTION_WORDS, least=30)),
)


def cascade(batch: Batch, rules: Sequence[Rule]) -> np.ndarray:
    """Number of the rule that rejects each text: -1 for the base counts, len(rules) if none
    does. A rule sees no text that came to an end before it."""
    ended = np.where(base_failed(batch.counts), -1, len(rules))
    at = np.arange(len(ended))
    for k, rule in enumerate(rules):
        alive = ended[at] == len(rules)
        if not alive.all():
            batch, at = batch.taken(np.flatnonzero(alive)), at[alive]
        if not len(at):
            break
        ended[at[rule.rejects(batch)]] = k
    return ended


def measured(docs: DataFrame, rules: Sequence[Rule], sample: int) -> list[tuple[int, list[float]]]:
    """Of at most ``sample`` texts that pass the base counts: rejecting rules as bits, and each
    rule's seconds a text. The texts, of smallest hashes, stay in the task that measures; a
    bound on the hash, worked out from the number of rows, leaves about twice as many as are
    needed, so that no task sorts more."""
    rules = tuple(rules)
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for piece in texts.slices(rows.column(0)):
                batch = Batch(piece, base_counts(piece))
                batch = batch.taken(np.flatnonzero(~base_failed(batch.counts)))
                n = len(batch.piece.bounds) - 1
                if not n:
                    continue
                bits, seconds = np.zeros(n, np.int64), []
                for k, rule in enumerate(rules):
                    begun = time.perf_counter()
                    fails = rule.rejects(batch)
                    seconds.append((time.perf_counter() - begun) / n)
                    bits |= fails.astype(np.int64) << k
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bits), pa.array([seconds] * n, pa.list_(pa.float64()))],
                    names=["bits", "seconds"],
                )

    least = -(1 << 63)
    bound = least + min((1 << 64) - 1, (1 << 64) * 2 * sample // max(docs.count(), 1))
    hashed = docs.withColumn("h", F.xxhash64("doc_id", "text")).where(F.col("h") <= F.lit(bound))
    some = hashed.orderBy("h").limit(sample).select("text")
    rows = some.mapInArrow(run, "bits long, seconds array<double>").collect()
    return [(r["bits"], r["seconds"]) for r in rows]


def ordered(rules: Sequence[Rule], sample: list[tuple[int, list[float]]]) -> list[Rule]:
    """The rules by rejections per cost, each among the texts that those before it pass.

    Rules that reject nothing of what is left come last, the cheapest first; without a sample
    the rules keep their order.
    """
    if not sample:
        return list(rules)
    cost = np.maximum(np.mean([s for _, s in sample], axis=0), 1e-9)
    left = np.array([b for b, _ in sample], np.int64)
    rest, out = list(range(len(rules))), []
    while rest:
        share = {k: float(np.mean((left >> k) & 1)) if len(left) else 0.0 for k in rest}
        best = max(rest, key=lambda k: (share[k] / cost[k], -cost[k]))
        left = left[((left >> best) & 1) == 0]
        rest.remove(best)
        out.append(rules[best])
    return out


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, sample: int = 512) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and rejected_by of every row of ``docs``.

    Words are runs of other than ASCII white space. A null or empty text has no words and fails
    the base counts. Repeated rows, ids and null ids stay as they are; columns besides doc_id
    and text are ignored; an empty table gives no rows. rejected_by names the first rule of the
    cascade that rejects the text ("base" for the counts, null if kept); with several reasons
    it depends on the measured order. There are 62 rules at most.
    """
    rows = docs.select("doc_id", "text")
    order = tuple(ordered(rules, measured(rows, rules, sample)))
    names = ["base", *[r.name for r in order], None]
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for piece in texts.slices(given.column(1)):
                batch = Batch(piece, base_counts(piece))
                ended = cascade(batch, order)
                n = len(ended)
                yield pa.RecordBatch.from_arrays(
                    [
                        given.column(0).slice(piece.first, n),
                        *[pa.array(batch.counts[c]) for c in BASE],
                        pa.array(ended == -1),
                        pa.array(ended == len(order)),
                        pa.array([names[k + 1] for k in ended], pa.string()),
                    ],
                    names=["doc_id", *BASE, "base_failed", "kept", "rejected_by"],
                )

    counted = ", ".join(f"{c} long" for c in BASE)
    return rows.mapInArrow(
        run, f"doc_id {kind}, {counted}, base_failed boolean, kept boolean, rejected_by string"
    )
