"""Quality from compression: how much better one dictionary compresses a text than another.

Two Zstandard dictionaries are trained, on good and on bad labelled text. A text is
compressed in pieces with either; the difference of the two sizes, divided by their sum, is
its evidence, and a logistic curve fitted on other labelled rows makes a score of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.sampling import fold, labelled
from basketry.session import ship_package

PIECE = 4096  # bytes compressed at once, so that a long text does not become its own dictionary
LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]  # of features(), the constant last


def sizes(text: str | None, compressors) -> tuple[int, list[int]]:
    """Bytes of a text and the sum of its pieces' sizes with each compressor."""
    data = (text or "").encode()
    total = [0] * len(compressors)
    for at in range(0, len(data), PIECE):
        part = data[at : at + PIECE]
        for k, compressor in enumerate(compressors):
            total[k] += len(compressor.compress(part))
    return len(data), total


def compressors(model_good: bytes, model_bad: bytes) -> list:
    import zstandard

    made = []
    for content in (model_good, model_bad):
        dictionary = zstandard.ZstdCompressionDict(content)
        dictionary.precompute_compress(level=LEVEL)
        made.append(
            zstandard.ZstdCompressor(
                dict_data=dictionary,
                compression_params=zstandard.ZstdCompressionParameters.from_level(
                    LEVEL, write_checksum=0, write_content_size=0, write_dict_id=0
                ),
            )
        )
    return made


def features(n: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Normalised difference, both compression ratios and their squares; zeros without text."""
    n = np.asarray(n, float)
    some = np.maximum(n, 1)
    difference = (bad - good) / np.maximum(good + bad, 1)
    ratio = np.where(n > 0, good / some, 0.0)
    short = np.where(n > 0, 1 / np.sqrt(some), 0.0)
    return np.stack(
        (10 * difference, ratio, ratio * ratio, 10 * difference * ratio, short), axis=1
    )


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights, the constant last, by Newton's method with a small ridge."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge @ w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def logistic(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.column_stack((x, np.ones(len(x)))) @ w, -30, 30)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 3,
    held_out: int = 1,
    per_class: int = 3000,
    pieces: int = 4000,
    dictionary_bytes: int = 112_640,
) -> QualityModel:
    """Dictionaries and calibration from at most 2 * ``per_class`` labelled documents.

    Half of those documents, by hash, give pieces of their text for the dictionaries (at
    most ``pieces`` of each class, the ones of smallest hash); the other half fit the curve.
    Without rows of both labels every score is the share of label 1, or a half.
    """
    import zstandard

    ship_package(docs.sparkSession)
    sample = labelled(docs, labels, "quality", folds, held_out, per_class)
    sample = sample.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)))
    rows = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE))
    cut = (
        sample.where("half = 0 and length(text) > 0")
        .withColumn("k", F.explode(rows))
        .select("doc_id", "y", "k", F.expr(f"substring(text, k * {PIECE} + 1, {PIECE})").alias("part"))
    )
    content = []
    for y in (1, 0):
        chosen = cut.where(F.col("y") == y).orderBy(F.xxhash64("doc_id", "k"), "doc_id").limit(pieces)
        parts = [r["part"].encode() for r in chosen.select("part").collect()]
        content.append(_dictionary(zstandard, parts, dictionary_bytes))
    measured = measure(sample.where("half = 1"), content[0], content[1], ["y"]).toPandas()
    y = measured["y"].to_numpy(float)
    x = features(measured["n"], measured["good"], measured["bad"])
    if len(set(y)) < 2:
        share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
        w = np.zeros(x.shape[1] + 1)
        w[-1] = np.log(share / (1 - share))
    else:
        w = fit_logistic(x, y)
    return QualityModel(content[0], content[1], tuple(float(v) for v in w))


def _dictionary(zstandard, parts: list[bytes], size: int) -> bytes:
    """A trained dictionary; of very little text, the text itself."""
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-size:] or b"........"


def measure(rows: DataFrame, good: bytes, bad: bytes, kept: list[str]) -> DataFrame:
    """``kept`` columns, n (bytes) and the compressed sizes of every row's whole text."""
    ship_package(rows.sparkSession)
    schema = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in kept)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = compressors(good, bad)
        for frame in frames:
            found = [sizes(t, made) for t in frame["text"]]
            out = frame[kept].copy()
            out["n"] = np.array([n for n, _ in found], np.int64)
            out["good"] = np.array([s[0] for _, s in found], np.int64)
            out["bad"] = np.array([s[1] for _, s in found], np.int64)
            yield out

    return rows.select(*kept, "text").mapInPandas(run, f"{schema}, n long, good long, bad long")


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score from 0 to 1 of every row; null and empty texts have the curve's value
    at no evidence. Repeated rows stay; other columns are ignored."""
    measured = measure(docs, model.good, model.bad, ["doc_id"])
    n, some = F.col("n"), F.greatest("n", F.lit(1))
    difference = (F.col("bad") - F.col("good")) / F.greatest(F.col("good") + F.col("bad"), F.lit(1))
    ratio = F.when(n > 0, F.col("good") / some).otherwise(0.0)
    short = F.when(n > 0, 1 / F.sqrt(some)).otherwise(0.0)
    terms = (10 * difference, ratio, ratio * ratio, 10 * difference * ratio, short, F.lit(1.0))
    z = sum((F.lit(w) * t for w, t in zip(model.weights, terms, strict=True)), F.lit(0.0))
    return measured.select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))


def classify(
    docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, threshold: float = 0.5
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    scored = score(docs, train(docs, labels, folds, held_out))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
