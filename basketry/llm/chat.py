"""Chat formatting with Spark expressions only: one string per conversation and a loss mask.

Format: ``<turn ROLE>TEXT<also>TEXT</turn>``; adjacent turns of one role share a block and
are divided by ``<also>``. Within roles and texts ``\\`` is written ``\\b``, ``<`` is
``\\l`` and ``>`` is ``\\g``, so a control string can never come from a text and the output
can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, SHUT, ALSO, CLOSE = "<turn ", ">", "<also>", "</turn>"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_chats(turns: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, learned.

    ``turns`` has conv_id, turn, role and text; other columns are ignored. Turns are sorted
    by (turn, role, text), nulls first; repeated rows stay. A null text or role is empty; rows
    with a null conv_id form one conversation. loss_spans are (start, length) in code points of
    the texts of ``learn_from``, in order; an empty text has a span of length 0. ``learned``
    says the same turn by turn. An empty table gives no rows. Work grows with the length of a
    conversation and not with its square: places are running sums over its turns, on the
    partitioning that the collecting has made.
    """
    part = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("turns"))
    # A turn joins the block before it if the role is the same.
    marked = sorted_turns.withColumn(
        "parts",
        F.transform(
            "turns",
            lambda t, i: F.struct(
                F.when(i == 0, F.concat(F.lit(OPEN), escaped(t["role"]), F.lit(SHUT)))
                .when(F.col("turns")[i - 1]["role"] == t["role"], F.lit(ALSO))
                .otherwise(F.concat(F.lit(CLOSE + OPEN), escaped(t["role"]), F.lit(SHUT)))
                .alias("mark"),
                escaped(t["text"]).alias("text"),
                (t["role"] == F.lit(learn_from)).alias("learn"),
            ),
        ),
    ).select("conv_id", "parts")
    each = marked.select("conv_id", F.posexplode("parts").alias("k", "part"))
    before = Window.partitionBy("conv_id").orderBy("k")
    length = F.length("part.text").cast("long")
    placed = each.select(
        "conv_id",
        F.struct(
            "k",
            F.concat("part.mark", "part.text").alias("body"),
            "part.learn",
            (F.sum(F.length("part.mark") + length).over(before) - length).alias("start"),
            length.alias("length"),
        ).alias("piece"),
    )
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    spans = F.transform(
        F.filter("pieces", lambda p: p["learn"]),
        lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length")),
    )
    return whole.select(
        "conv_id",
        F.concat(F.array_join("pieces.body", ""), F.lit(CLOSE)).alias("formatted"),
        spans.alias("loss_spans"),
        F.col("pieces.learn").alias("learned"),
    )


def read_chats(formatted: DataFrame) -> DataFrame:
    """Turns and learned text read back from the output: conv_id, formatted, turns, loss_text.

    turns: array of (role, text) in order, merged turns apart again. Every block is taken apart
    by itself, so a role is read where its block begins.
    """
    blocks = F.filter(F.split("formatted", OPEN), lambda b: b != "")
    turns = F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                # Without the role before the first and the closing after the last text.
                F.split(F.replace(F.substr(b, F.instr(b, SHUT) + 1), F.lit(CLOSE), F.lit("")), ALSO),
                lambda text: F.struct(
                    unescaped(F.substring_index(b, SHUT, 1)).alias("role"), unescaped(text).alias("text")
                ),
            ),
        )
    )
    read = formatted.select("conv_id", "formatted", turns.alias("turns"), "learned")
    masked = F.zip_with("turns", "learned", lambda t, learn: F.when(learn, t["text"]))
    return read.select("conv_id", "formatted", "turns", F.array_join(masked, "").alias("loss_text"))
