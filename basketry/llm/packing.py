"""Tokens of documents packed into sequences: bounded-space online best fit.

Tokenisation runs in one pass without a shuffle; only (document, piece, length) rows move to
the packing tasks. A task keeps a fixed number of open bins, found through a bitset whose
bit f is set while some open bin has f places free; when too many are open the fullest closes.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.memory import returning
from basketry.session import ship_package

SEQUENCE = 2048
OPEN_BINS = 8192
TASK_PIECES = 25_000  # pieces that one packing task gets on average
CACHED_CHUNKS = 300_000

# White space at which the tokenizer divides and str.split does not, or the other way round,
# or of which that is not sure: texts with these are not cut before they are tokenised.
_UNSURE = re.compile(
    "[\x1c-\x1f\x85\xa0 ᠎ -‏ -  -⁯　﻿]"
)
_PLAIN_TAIL = ".,;:!?*#$%&|-)"
# Composed Latin letters, which normalising leaves alone and which have one lower-case letter.
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
# How the model writes bytes: printable ones as themselves, the others from U+0100 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SIGNS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}


# What a vocabulary must give chunk by chunk as it does at once, for chunks to be looked up.
_PROBES = (
    "The quick brown FOX, it jumped! (over) 12 dogs; isn't Über-naïve çà ÉTÉ straße.",
    "a  b\n\nc\td  Mixed CaSe words*** 3.14 x|y -- end",
    "   leading and trailing   ",
    "Ünï cødé 日本語 \U0001f600 don't #tag $5 %% &&",
)


class ChunkIds(dict):
    """Ids (little-endian unsigned 32-bit) of a text between white space, remembered.

    A vocabulary that divides words at white space and between letters and signs gives a chunk
    the same ids whatever its neighbours. Latin letters followed by plain signs are looked up
    apart, letters straight in the model; anything else goes through the whole tokenizer. A
    vocabulary that does otherwise with any of the probes tokenises every text whole.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.model = tokenizer.model
        self.words: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}
        self.by_chunk = True
        try:
            self.by_chunk = all(self.of(probe) == self.whole(probe) for probe in _PROBES)
        except Exception:  # what the library raises for letters that a model does not know
            self.by_chunk = False

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, letters: str) -> bytes:
        ids = self.words.get(letters)
        if ids is None:
            seen = letters if letters.isascii() else letters.encode().decode("latin-1").translate(_BYTE_SIGNS)
            ids = array("I", [t.id for t in self.model.tokenize(seen)]).tobytes()
            self.words[letters] = ids
        return ids

    def __missing__(self, chunk: str) -> bytes:
        core = chunk.rstrip(_PLAIN_TAIL)
        if _LATIN.fullmatch(core):
            tail = chunk[len(core) :]
            if tail not in self.tails:
                self.tails[tail] = self.whole(tail)
            ids = self.word(core.lower()) + self.tails[tail]
        else:
            ids = self.whole(chunk)
        self[chunk] = ids
        return ids

    def of(self, text: str) -> bytes:
        if not self.by_chunk or _UNSURE.search(text):
            return self.whole(text)
        if len(self) > CACHED_CHUNKS:
            self.clear()
            self.tails = {"": b""}
        if len(self.words) > CACHED_CHUNKS:
            self.words.clear()
        return b"".join(map(self.__getitem__, text.split()))


PIECES = "piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE, with_ids: bool = False
) -> DataFrame:
    """Pieces of the tokens of every row: columns of ``docs`` but its text, then PIECES.

    A row's ids are those of its text (null: none) and id 0; only longer ones are cut, every
    ``sequence`` ids. ``with_ids`` adds the ids themselves. ``vocabulary``: a tokenizer file
    that every worker can read. Columns of ``docs`` with the name of a new one are dropped.
    """
    ship_package(docs.sparkSession)
    new = T._parse_datatype_string(PIECES).names + (["ids"] if with_ids else [])
    kept = [c for c in docs.columns if c != "text" and c not in new]
    schema = T.StructType([docs.schema[c] for c in kept])
    for field in T._parse_datatype_string(PIECES + (", ids array<long>" if with_ids else "")):
        schema.add(field)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        known = ChunkIds(Tokenizer.from_file(vocabulary))
        step = sequence * 4
        for batch in batches:
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column(batch.num_columns - 1)):
                text = text.as_py()
                data = (known.of(text) if text else b"") + b"\0\0\0\0"
                for k, at in enumerate(range(0, len(data), step)):
                    part = data[at : at + step]
                    rows.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int64))
            taken = pa.array(rows, pa.int64())
            columns = [batch.column(k).take(taken) for k in range(len(kept))]
            columns += [pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*kept, "text").mapInArrow(returning(pieces), schema)


class Bins:
    """Open bins of one stream; ``place`` gives (sequence, offset) of the next piece."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.free: list[list[int]] = [[] for _ in range(size + 1)]
        self.bits = self.open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            number = self._take(room)
        else:
            room, number = self.size, self.made
            self.made += 1
            if self.open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        left = room - length
        if left:
            self.free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.size - room

    def _take(self, room: int) -> int:
        number = self.free[room].pop()
        self.open -= 1
        if not self.free[room]:
            self.bits &= ~(1 << room)
        return number


def best_fit(
    pieces: DataFrame, sequence: int = SEQUENCE, open_bins: int = OPEN_BINS, tasks: int | None = None
) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) plus sequence_id and offset.

    Rows go to ``tasks`` streams by the hash of their values and are packed there from the
    longest to the shortest, so a recomputed task gives the same places. Pieces that do not
    fit an empty sequence are an error. An empty table gives no rows.
    """
    ship_package(pieces.sparkSession)
    if tasks is None:
        tasks = max(1, math.ceil(pieces.count() / TASK_PIECES))
    plain = [c for c, kind in pieces.dtypes if not kind.startswith(("array", "map", "struct"))]
    dealt = pieces.withColumn("__task", F.pmod(F.xxhash64(*plain), F.lit(tasks)).cast("int"))
    ordered = dealt.repartitionById(tasks, "__task").sortWithinPartitions(
        "__task", F.desc("length"), *[c for c in plain if c != "length"]
    )
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    schema = T.StructType([pieces.schema[c] for c in kept])
    schema.add("sequence_id", T.LongType()).add("offset", T.LongType())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, bins = None, None
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("length")).to_pylist()
            owners = batch.column(batch.num_columns - 1).to_pylist()
            numbers, offsets = [], []
            for owner, length in zip(owners, lengths, strict=True):
                if not 0 < length <= sequence:
                    raise ValueError(f"a piece of {length} tokens fits no sequence")
                if owner != stream:
                    stream, bins = owner, Bins(sequence, open_bins)
                number, offset = bins.place(length)
                numbers.append((owner << 40) + number)
                offsets.append(offset)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns += [pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return ordered.select(*kept, "__task").mapInArrow(returning(pack), schema)


def pack_documents(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE) -> DataFrame:
    """Pieces of all rows of ``docs`` with their places; see the two functions above."""
    tasks = max(1, math.ceil(docs.count() / TASK_PIECES))
    return best_fit(token_pieces(docs, vocabulary, sequence), sequence, tasks=tasks)
