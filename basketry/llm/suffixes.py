"""Enhanced suffix arrays of short byte strings and their maximal repeats; used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def suffix_array(
    data: np.ndarray, place: np.ndarray, length: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes data[place : place + length], and each one's common prefix with
    the one before it in that order (0 for the first)."""
    n = len(place)
    words = -(-int(length.max(initial=0)) // 8)
    padded = np.concatenate((data, np.zeros(8 * words + 8, np.uint8))).astype(np.uint64)
    eight = np.zeros(len(padded) - 7, np.uint64)  # the eight bytes from every place as a number
    for k in range(8):
        eight |= padded[k : k + len(eight)] << np.uint64(56 - 8 * k)
    keys = []
    for k in range(words):
        left = np.clip(length - 8 * k, 0, 8)
        mask = np.where(left > 0, ~np.uint64(0) << ((8 - np.maximum(left, 1)) * 8).astype(np.uint64), np.uint64(0))
        keys.append(eight[place + 8 * k] & mask)
    order = np.lexsort(keys[::-1]) if keys else np.arange(n)
    common = np.zeros(n, np.int64)
    same = np.ones(max(n - 1, 0), bool)
    for key in keys:
        sorted_key = key[order]
        differ = sorted_key[1:] ^ sorted_key[:-1]
        equal_bytes = np.full(len(differ), 8, np.int64)
        for b in range(8):
            # The first byte that differs decides; later ones must not overwrite it.
            here = (differ >> np.uint64(56 - 8 * b)) & np.uint64(255) != 0
            equal_bytes = np.where(here & (equal_bytes == 8), b, equal_bytes)
        common[1:] += np.where(same, equal_bytes, 0)
        same &= differ == 0
    sorted_length = length[order]
    common[1:] = np.minimum(common[1:], np.minimum(sorted_length[1:], sorted_length[:-1]))
    return order, common


def prefix_intervals(common: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of all common-prefix intervals at least so deep, inner ones first."""
    stack = [(0, 0)]
    for k in range(1, len(common) + 1):
        depth = common[k] if k < len(common) else 0
        if depth < least:
            depth = 0
            if stack[-1][0] == 0:
                continue
        first = k - 1
        while depth < stack[-1][0]:
            inner, first = stack.pop()
            yield inner, first, k - 1
        if depth > stack[-1][0]:
            stack.append((depth, first))


def maximal_repeats(
    data: np.ndarray, place: np.ndarray, length: np.ndarray, before: np.ndarray, least: int
) -> Iterator[tuple[int, np.ndarray]]:
    """(length, numbers of all suffixes that begin with it) of every maximal repeat.

    ``before``: the byte before each suffix, -1 where it is not known. An interval whose
    suffixes all have one byte before them is the rest of a longer repeat and is left out.
    """
    if len(place) < 2:
        return
    order, common = suffix_array(data, place, length)
    left = before[order]
    change = np.ones(len(left), np.int64)
    change[1:] = (left[1:] != left[:-1]) | (left[1:] < 0)
    changes = np.cumsum(change).tolist()
    unknown = (left < 0).tolist()
    for depth, first, last in prefix_intervals(common.tolist(), least):
        if changes[last] > changes[first] or unknown[first]:
            yield depth, order[first : last + 1]
