"""Words of whole Arrow columns of text as NumPy arrays; used inside tasks.

A column is cut into slices of a few megabytes, so that temporary arrays stay small whatever
the number of rows in a batch; a text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MULTIPLIERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class Slice(NamedTuple):
    """Texts ``first`` to ``first + count`` of a column, end to end."""

    first: int
    data: np.ndarray  # uint8, all bytes of the texts
    bounds: np.ndarray  # int64, count + 1 offsets into data


class Words(NamedTuple):
    """Words of a slice in order: byte range, number of their text in the slice, hash."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a string column; a null is an empty text."""
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return
    column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        lo, hi = int(offsets[first]), int(offsets[last])
        yield Slice(first, data[lo:hi], offsets[first : last + 1] - lo)
        first = last


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(_MULTIPLIERS[0])
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(_MULTIPLIERS[1])
    return h ^ (h >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = max(n, SLICE_BYTES + 1)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if size <= 4 * SLICE_BYTES:  # the powers of a very long text are not kept
            _POWERS[base] = known
    return known[:n]


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges; equal bytes have equal hashes wherever they stand."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
    h = (sums[end] - sums[start]) * _powers(_INVERSE, n + 1)[start]
    return mixed(h + (end - start).astype(np.uint64) * np.uint64(_MULTIPLIERS[1]))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A to Z become a to z; every other byte stays."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(piece: Slice, is_word: np.ndarray, data: np.ndarray | None = None) -> Words:
    """Maximal runs of bytes for which the table ``is_word`` holds, within each text."""
    data = piece.data if data is None else data
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = piece.bounds[:-1]
    heads = heads[heads < len(data)]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    text = np.searchsorted(piece.bounds, start, "right") - 1
    return Words(start, end, text, range_hashes(data, start, end))


def word_counts(found: Words, texts: int) -> np.ndarray:
    return np.bincount(found.text, minlength=texts)


def shingles(found: Words, texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and hash of every run of ``size`` words, repeated ones included.

    A text with fewer words, but not none, has its whole sequence as its one shingle.
    """
    counts = word_counts(found, texts)
    begin = np.concatenate(([0], np.cumsum(counts)))
    n = len(found.hash)
    whole = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        if n >= size:
            for k in range(size):
                whole[: n - size + 1] = mixed(
                    whole[: n - size + 1] + found.hash[k : n - size + 1 + k] + np.uint64(k + 1)
                )
        at = np.arange(n)
        full = at + size <= begin[found.text + 1]
        text, value = found.text[full], whole[full]
        short = np.flatnonzero((counts > 0) & (counts < size))
        if len(short):
            h = np.zeros(len(short), np.uint64)
            for k in range(size - 1):
                more = counts[short] > k
                h[more] = mixed(h[more] + found.hash[begin[short[more]] + k] + np.uint64(101 + k))
            text, value = np.concatenate((text, short)), np.concatenate((value, h))
    return text, value


def distinct_per_text(
    text: np.ndarray, value: np.ndarray, texts: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, ascending, end to end, and where each text begins."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    text, value = text[new], value[new]
    return value, np.searchsorted(text, np.arange(texts + 1))
