"""Bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)).cast("int")


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int
) -> DataFrame:
    """doc_id, text, y of at most ``per_class`` training rows of each label 0 and 1.

    Rows of fold ``held_out``, without a label or id, never come; of the others those whose
    ids have the smallest hashes. The ids are chosen before any text is read.
    """
    allowed = labels.where((fold(F.col("doc_id"), folds) != held_out) & F.col(label).isin(0, 1))
    allowed = allowed.select("doc_id", F.col(label).cast("int").alias("y"), F.xxhash64("doc_id").alias("h"))
    chosen = None
    for y in (0, 1):
        some = allowed.where(F.col("y") == y).orderBy("h", "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    return docs.select("doc_id", "text").join(chosen.select("doc_id", "y"), "doc_id")
