"""Toxicity from a learned lexicon, matched with Levenshtein automata over its trie.

The lexicon comes from labelled rows: words and word beginnings that are much more frequent
in toxic texts. Its trie, walked with one allowed error for whole words, is made into one
deterministic automaton over letters as far as texts reach it, and all words of a batch step
through it together.
A hit counts by its context: between paired quotation marks or on a quoting line it is worth
less, near a word that reports speech still less; the window of words around a hit sums what
the hits in it are worth, so direct hits that stand close together are abuse.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import texts
from basketry.llm.memory import returning
from basketry.llm.quality import fit_logistic
from basketry.llm.quotation import quoted, reported
from basketry.llm.sampling import fold, labelled
from basketry.session import ship_package

WINDOW = 48  # words before and after a hit
STEM = 8  # letters of the longest beginning
CODES = 0x110000
# Scripts without spaces: Thai and Lao, Burmese, Khmer, kana, Chinese characters.
UNSPACED = ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF))
UNSPACED += ((0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x323AF))
ALIKE = dict(
    zip(
        "аеорсухіјѕһԁԛԝкмтвнгαονρτυικχγϲɑɡıǀⅼо",
        "aeopcyxijshdqwkmtbhraovptuikxycagillo",
        strict=True,
    )
)
QUOTED = 0.3  # worth of a quoted hit
REPORTED = 0.15  # of a quoted hit near a word that reports speech
MISSPELLED = 0.6  # weight of a hit with an error
MOST_STATES = 50_000  # of an automaton that are kept from one slice of texts to the next


@dataclass(frozen=True)
class Term:
    text: str
    weight: float
    beginning: bool  # any word that begins so, without errors


State = frozenset[tuple[int, int]]


class Automaton:
    """The trie of all terms, walked with errors and made deterministic as words ask for it.

    A state is a set of (trie node, errors made) and the weight of the best beginning that the
    word already has. Only the trie moves between processes; each makes the states that its
    words reach, and starts anew after ``MOST_STATES``, so any number of terms will do.
    """

    def __init__(self, nodes: list[tuple[dict[int, int], float, float, bool]], errors: int):
        self.nodes, self.errors = nodes, errors
        self.letters = np.array(sorted({k >> 1 for n in nodes for k in n[0]}), np.int64)
        self.clear()

    def __getstate__(self):
        return self.nodes, self.errors

    def __setstate__(self, state):
        self.__init__(*state)

    def clear(self) -> None:
        self.step = np.full((64, len(self.letters) + 1), -1, np.int32)
        self.value = np.zeros(64)
        self.ended = np.zeros(64, bool)  # nothing more can change the value
        self.numbers: dict[tuple[State, float], int] = {}
        self.order: list[tuple[State, float]] = []
        self.number(frozenset(), 0.0)
        self.number(self.closed({(0, 0)}), 0.0)

    def number(self, state: State, begun: float) -> int:
        known = self.numbers.get((state, begun))
        if known is not None:
            return known
        k = self.numbers[state, begun] = len(self.order)
        self.order.append((state, begun))
        if k == len(self.step):
            self.step = np.concatenate((self.step, np.full_like(self.step, -1)))
            self.value = np.concatenate((self.value, np.zeros(k)))
            self.ended = np.concatenate((self.ended, np.zeros(k, bool)))
        ends = (self.nodes[n][1] * (1.0 if made == 0 else MISSPELLED) for n, made in state)
        self.value[k] = max(begun, max(ends, default=0.0))
        self.ended[k] = not state
        return k

    def closed(self, items: set[tuple[int, int]]) -> State:
        """Leaving out letters of the term is free but for the error it costs."""
        todo = list(items)
        while todo:
            node, made = todo.pop()
            if made < self.errors:
                for key, child in self.nodes[node][0].items():
                    if key & 1 and (child, made + 1) not in items:
                        items.add((child, made + 1))
                        todo.append((child, made + 1))
        best: dict[int, int] = {}
        for node, made in items:
            best[node] = min(made, best.get(node, made))
        return frozenset(best.items())

    def after(self, number: int, letter: int) -> int:
        """The state that a letter (its place in ``letters`` plus 1, 0 for any other) leads to."""
        state, begun = self.order[number]
        code = int(self.letters[letter - 1]) * 2 if letter else None
        reached: set[tuple[int, int]] = set()
        for node, made in state:
            children, _, _, free = self.nodes[node]
            for key in () if code is None else (code, code + 1):
                if key in children:
                    child = children[key]
                    reached.add((child, made))
                    if made == 0:
                        begun = max(begun, self.nodes[child][2])
            if made < self.errors:
                for key, child in children.items():
                    if key & 1:
                        reached.add((child, made + 1))
                if free:
                    reached.add((node, made + 1))
        return self.number(self.closed(reached), begun)

    def walk(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        target = self.step[state, letter]
        new = np.flatnonzero(target < 0)
        if len(new):
            width = self.step.shape[1]
            for pair in np.unique(state[new].astype(np.int64) * width + letter[new]).tolist():
                made = self.after(pair // width, pair % width)  # may move the table
                self.step[pair // width, pair % width] = made
            target = self.step[state, letter]
        return target


def compile_terms(terms: list[Term], errors: int = 1, least: int = 5) -> Automaton:
    """The automaton of all terms; words under ``least`` letters and beginnings allow no error.

    Terms with and without errors have tries of their own under one root: a key is twice the
    letter, plus one in the trie with errors. The distance counts letters.
    """
    _, _, folded = _letters()
    children: list[dict[int, int]] = [{}]
    ends, stems, free = [0.0], [0.0], [False]
    for term in terms:
        data = folded[[ord(c) for c in _plain(term.text)]].tolist()
        loose = not term.beginning and len(data) >= least
        free[0] |= loose
        node = 0
        for letter in data:
            key = 2 * letter + loose
            if key not in children[node]:
                children[node][key] = len(children)
                children.append({})
                ends.append(0.0)
                stems.append(0.0)
                free.append(loose)
            node = children[node][key]
        where = stems if term.beginning else ends
        where[node] = max(where[node], term.weight)
    return Automaton(list(zip(children, ends, stems, free, strict=True)), errors)


def match(automaton: Automaton, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Weight of every word, 0 for no match; all words take each step together."""
    if len(automaton.order) > MOST_STATES:
        automaton.clear()
    place = np.searchsorted(automaton.letters, data)
    known = np.append(automaton.letters, -1)[place] == data
    letter = np.where(known, place + 1, 0)
    state = np.ones(len(start), np.int32)
    alive = np.arange(len(start))
    k = 0
    while len(alive := alive[(start[alive] + k < end[alive]) & ~automaton.ended[state[alive]]]):
        state[alive] = automaton.walk(state[alive], letter[start[alive] + k])
        k += 1
    return automaton.value[state]


@cache
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every code point: 0 none, 1 letter, digit or mark, 2 one of a script without spaces,
    3 invisible; whether a word of such a script can begin with it; the letter it stands for."""
    kind, head = np.zeros(CODES, np.uint8), np.zeros(CODES, bool)
    for lo, hi in ((0, 0x323B0), (0xE0000, 0xE01F0)):
        names = [unicodedata.category(chr(c)) for c in range(lo, hi)]
        kind[lo:hi] = [3 if n == "Cf" else n[0] in "LNM" for n in names]
        head[lo:hi] = [n[0] in "LN" for n in names]
    kind[0xFE00:0xFE10] = kind[0xE0100:0xE01F0] = 3  # variation selectors
    for lo, hi in UNSPACED:
        kind[lo : hi + 1] = np.where(kind[lo : hi + 1] == 1, 2, kind[lo : hi + 1])
    folded = np.arange(CODES, dtype=np.uint32)
    for one, other in ALIKE.items():
        folded[ord(one)] = ord(other)
    return kind, head & (kind == 2), folded


def _plain(text: str) -> str:
    return unicodedata.normalize("NFKC", text).lower()


def letters(column: pa.Array) -> Iterator[tuple[texts.Slice, texts.Words, np.ndarray]]:
    """Code points of a column's texts, their words, and which of these are of a script
    without spaces: there a word begins at every letter and reaches to the end of its run.

    Texts are in NFKC and small letters; letters that look like Latin ones are those and what
    is invisible is left out.
    """
    kind, head, folded = _letters()
    for piece in texts.slices(column):
        data, ends = piece.data.tobytes(), piece.bounds.tolist()
        plain = [_plain(data[lo:hi].decode(errors="replace")) for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
        codes = np.frombuffer("".join(plain).encode("utf-32-le"), np.uint32)
        begins = np.cumsum([0, *map(len, plain)])
        seen = kind[codes] != 3
        bounds = np.concatenate(([0], np.cumsum(seen)))[begins]
        codes = folded[codes[seen]]
        piece = texts.Slice(piece.first, codes, bounds)
        spaced, runs = (texts.words(piece, kind == k) for k in (1, 2))
        if not len(runs.start):
            yield piece, spaced, np.zeros(len(spaced.start), bool)
            continue
        n = runs.end - runs.start
        at = np.repeat(runs.end - np.cumsum(n), n) + np.arange(n.sum())
        at, which = at[head[codes[at]]], np.repeat(np.arange(len(n)), n)[head[codes[at]]]
        start = np.concatenate((spaced.start, at))
        order = np.argsort(start, kind="stable")
        found = texts.Words(
            start[order],
            np.concatenate((spaced.end, runs.end[which]))[order],
            np.concatenate((spaced.text, runs.text[which]))[order],
            np.zeros(0, np.uint64),
        )
        yield piece, found, order >= len(spaced.start)


FEATURES = ("__density", "__near", "__weight", "__quoted")


def evidence(automaton: Automaton, column: pa.Array) -> np.ndarray:
    """Per text: weighted hits per word, the fullest window, hits against the root of the
    length, which chance hits of a long text grow with, and the quoted share."""
    out = np.zeros((len(column), len(FEATURES)))
    for piece, found, _ in letters(column):
        n = len(piece.bounds) - 1
        if not len(found.start):
            continue
        weight = match(automaton, piece.data, found.start, found.end)
        hit = np.flatnonzero(weight)
        counts = np.bincount(found.text, minlength=n)
        rows = out[piece.first : piece.first + n]
        if not len(hit):
            continue
        begin = np.concatenate(([0], np.cumsum(counts)))
        owner = found.text[hit]
        cited = quoted(piece, found, _letters()[0], hit)
        weight[hit[cited]] *= np.where(reported(piece, found, hit[cited]), REPORTED, QUOTED)
        sums = np.concatenate(([0.0], np.cumsum(weight)))
        lo = np.maximum(hit - WINDOW, begin[owner])
        hi = np.minimum(hit + WINDOW + 1, begin[owner + 1])
        around = sums[hi] - sums[lo]
        total = np.bincount(owner, weights=weight[hit], minlength=n)
        np.maximum.at(rows[:, 1], owner, around)
        rows[:, 0] = np.minimum(40 * total / (counts + 20), 6)
        rows[:, 1] = np.minimum(rows[:, 1], 12)
        rows[:, 2] = np.minimum(3 * total / np.sqrt(counts + 10), 9)
        hits = np.bincount(owner, minlength=n)
        rows[:, 3] = np.bincount(owner, weights=cited, minlength=n) / np.maximum(hits, 1)
    return out


@dataclass(frozen=True)
class ToxicityModel:
    automaton: Automaton
    weights: np.ndarray
    terms: tuple[Term, ...]


def _beginnings(least: int, more: Column) -> Column:
    """Beginnings of ``word``, marked by a star, and more; of a script without spaces the whole
    of a short run, too."""
    most = F.length("word") - (1 if least == 3 else 0)
    lengths = F.filter(F.array(*map(F.lit, range(least, STEM + 1))), lambda k: k <= most)
    return F.concat(F.transform(lengths, lambda k: F.concat(F.substring("word", 1, k), F.lit("*"))), more)


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """y, row, and the distinct words of every text; "open": beginnings in scripts without spaces."""
    for batch in batches:
        words: list[list[str]] = [[] for _ in range(batch.num_rows)]
        inside: list[list[str]] = [[] for _ in range(batch.num_rows)]
        for piece, found, free in letters(batch.column(2)):
            whole = piece.data.tobytes().decode("utf-32-le")
            end = np.where(free, np.minimum(found.end, found.start + STEM), found.end)
            seen: set[tuple[int, bool, str]] = set()
            columns = (found.text.tolist(), free.tolist(), found.start.tolist(), end.tolist())
            for text, is_open, lo, hi in zip(*columns, strict=True):
                key = (text, is_open, whole[lo:hi])
                if key not in seen:
                    seen.add(key)
                    (inside if is_open else words)[piece.first + text].append(key[2])
        kinds = pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(words, kinds), pa.array(inside, kinds)],
            names=["y", "row", "words", "open"],
        )


def learn_terms(sample: DataFrame, least_hits: int = 6, ratio: float = 8.0) -> list[Term]:
    """All words and beginnings (3 to 8 letters) from doc_id, text, y that clear the tests; of
    scripts without spaces, what begins anywhere (2 to 8 letters).

    Counted are distinct texts: a term needs ``least_hits`` toxic ones and must be ``ratio``
    times as frequent there as in others, by shares of all distinct words of texts. A
    beginning needs two different words, but not in a script without spaces, and adds nothing
    to a shorter one of no less weight.
    """
    ship_package(sample.sparkSession)
    per_text = sample.dropDuplicates(["text", "y"]).select(
        "y", F.monotonically_increasing_id().alias("row"), "text"
    )
    per_text = per_text.mapInArrow(returning(_distinct_words), "y int, row long, words array<string>, open array<string>")
    size = F.size("words") + F.size("open")
    totals = per_text.agg(
        F.sum(size * F.col("y")).alias("t"), F.sum(size * (1 - F.col("y"))).alias("o")
    ).first()
    if not totals["t"] or not totals["o"]:
        return []
    single = per_text.select("y", "row", F.lit(False).alias("inside"), F.explode("words").alias("word"))
    terms = single.select(
        "y", "row", "inside", "word", F.explode(_beginnings(3, F.array("word"))).alias("term")
    )
    inside = per_text.select("y", "row", F.lit(True).alias("inside"), F.explode("open").alias("word"))
    terms = terms.unionByName(
        inside.select(
            "y", "row", "inside", "word", F.explode(_beginnings(2, F.array().cast("array<string>"))).alias("term")
        )
    )
    # Once for each text that has the term, in however many words.
    per_term = terms.groupBy("term", "row", "y").agg(
        F.min("word").alias("low"), F.max("word").alias("high"), F.max("inside").alias("inside")
    )
    odds = (F.col("toxic") / F.lit(totals["t"])) / ((F.col("other") + 1) / F.lit(totals["o"]))
    found = (
        per_term.groupBy("term")
        .agg(
            F.sum("y").alias("toxic"),
            F.sum(1 - F.col("y")).alias("other"),
            ((F.min("low") < F.max("high")) | F.max("inside")).alias("family"),
        )
        .where(F.col("toxic") >= least_hits)
        .where(F.col("family") | ~F.endswith("term", F.lit("*")))
        .withColumn("odds", odds)
        .where(F.col("odds") >= ratio)
        .orderBy(F.length("term"), "term")
        .collect()
    )
    chosen: list[Term] = []
    stems: dict[str, float] = {}
    for r in found:
        beginning = r["term"].endswith("*")
        text = r["term"].removesuffix("*")
        weight = float(min(np.log(r["odds"]), 5.0)) / 5.0
        if beginning:
            # What a shorter beginning finds with no less weight adds nothing.
            if any(stems.get(text[:k], 0.0) >= weight for k in range(2, len(text))):
                continue
            stems[text] = weight
        chosen.append(Term(text, weight, beginning))
    return chosen


def train(
    docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, per_class: int = 3000
) -> ToxicityModel:
    """Lexicon and weights from at most 2 * ``per_class`` labelled documents."""
    ship_package(docs.sparkSession)
    sample = labelled(docs, labels, "toxic", folds, held_out, per_class)
    terms = learn_terms(sample)
    automaton = compile_terms(terms)
    measured = measure(sample, automaton, ["y"]).toPandas()
    y = measured["y"].to_numpy(float)
    x = measured[list(FEATURES)].to_numpy(float)
    if len(set(y)) < 2:
        weights = np.zeros(len(FEATURES) + 1)
        weights[-1] = -5.0 if not len(y) or y.mean() < 0.5 else 5.0
    else:
        weights = fit_logistic(x, y, penalty=0.1)
    return ToxicityModel(automaton, weights, tuple(terms))


def measure(rows: DataFrame, automaton: Automaton, kept: list[str]) -> DataFrame:
    """``kept`` columns and, under the names of FEATURES, the evidence of every whole text."""
    ship_package(rows.sparkSession)
    schema = T.StructType([rows.schema[c] for c in kept])
    for name in FEATURES:
        schema.add(name, T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = evidence(automaton, batch.column(batch.num_columns - 1))
            columns = [batch.column(k) for k in range(len(kept))]
            columns += [pa.array(found[:, k]) for k in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.select(*kept, F.col("text").alias("__text")).mapInArrow(returning(run), schema)


def with_score(rows: DataFrame, model: ToxicityModel, kept: list[str]) -> DataFrame:
    """``kept`` columns and __score from 0 to 1 of every row; null and empty texts have no
    hits. Repeated rows stay; an empty table gives no rows."""
    z = sum(
        (F.lit(float(w)) * F.col(f) for w, f in zip(model.weights, FEATURES, strict=False)),
        F.lit(float(model.weights[-1])),
    )
    scored = (1 / (1 + F.exp(-z))).alias("__score")
    return measure(rows, model.automaton, kept).select(*kept, scored)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    return with_score(docs, model, ["doc_id"]).withColumnRenamed("__score", "score")


def reject(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a score under the threshold, all columns as they were."""
    return with_score(docs, model, docs.columns).where(F.col("__score") < threshold).drop("__score")


def classify(
    docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = 0.3
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    scored = score(docs, train(docs, labels, folds, held_out))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
