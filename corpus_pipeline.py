"""Preparation of a training corpus in stages, each calling one operator of the subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import decontamination, jaccard, packing, substrings, toxicity
from basketry.llm.queries import table, vocabulary
from basketry.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labels, does not reject."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model)


def numbered(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of each row, and the name of its column, which no other has;
    written and reread, so that it stays. Ids may repeat or be null, so decisions about rows
    are applied by this number."""
    name = "__row"
    while name in (c.lower() for c in docs.columns):
        name += "_"
    path = scratch_path(spark, "numbered")
    docs.withColumn(name, F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path), name


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows connected by similar five-word shingles (0.8 or more) one stays: that of smallest
    id, null ids last, and of those the text of smallest hash. Rows without words all stay."""
    rows, row = numbered(spark, docs)
    source = rows.select(F.col(row).alias("doc_id"), "text")
    groups = jaccard.jaccard_join(source, size=5, percent=80)
    groups = groups.select(F.col("doc_id").alias(row), "component_id")
    places = rows.select(
        row,
        F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), row).alias("place"),
    )
    first = groups.join(places, row).groupBy("component_id").agg(F.min("place").alias("place"))
    kept = first.select(F.col(f"place.{row}").alias(row))
    return rows.join(kept, row, "left_semi").select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages of 100 bytes or more that began in an earlier one.
    A document of which nothing is left stays, with an empty text."""
    kept = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cut = substrings.remove_repeats(docs, kept=kept, with_text=True)
    return cut.select(
        *[
            F.col("kept_text").alias("text")
            if c == "text"
            else F.length("kept_text").cast(docs.schema[c].dataType).alias("n_chars")
            if c == "n_chars"
            else F.col(c)
            for c in docs.columns
        ]
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without ten consecutive words of a benchmark item."""
    rows, row = numbered(spark, docs)
    source = rows.select(F.col(row).alias("doc_id"), "text")
    found = decontamination.decontaminate(source, table(spark, sf_dir, "benchmark"))
    leaks = found.where("contaminated").select(F.col("doc_id").alias(row))
    return rows.join(leaks, row, "left_anti").select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs.select("doc_id", "text"), vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

# Learned, hashed and tokenised results have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
