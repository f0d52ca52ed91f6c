"""Anchors: places of a text chosen by its content alone, one at least in every long string."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from basketry.llm.texts import Slice, range_hashes


class Contexts(NamedTuple):
    """Runs of neighbouring windows of one text that have the same anchor.

    text: number in the slice; start: place of the first window in its text; windows: how
    many; anchor: hash of the anchor; content: hash of all bytes that the windows cover;
    loops: whether two of its windows may be equal.
    """

    text: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    content: np.ndarray
    loops: np.ndarray


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours: from running minima to both sides of block ends."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    full = np.full(len(values) + -len(values) % width, np.iinfo(np.uint64).max, np.uint64)
    full[: len(values)] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[:n], behind[width - 1 : width - 1 + n])


def contexts(piece: Slice, window: int, gram: int, most: int) -> Contexts:
    """Contexts of all windows of ``window`` bytes of the texts of a slice.

    A window's anchor is the least hash of its runs of ``gram`` bytes, so equal windows have
    equal anchors. A context has at most ``most`` windows.
    """
    n = len(piece.data)
    grams = range_hashes(piece.data, np.arange(max(n - gram + 1, 0)), np.arange(gram, n + 1))
    least = sliding_least(grams, window - gram + 1)
    place = np.arange(len(least))
    text = np.searchsorted(piece.bounds, place, "right") - 1
    inside = place + window <= piece.bounds[text + 1]
    place, text, least = place[inside], text[inside], least[inside]
    if not len(place):
        none = np.zeros(0, np.int64)
        h = none.astype(np.uint64)
        return Contexts(none, none, none, h, h, none.astype(bool))
    new = np.ones(len(place), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    run = np.flatnonzero(new)
    within = np.arange(len(place)) - np.repeat(run, np.diff(np.append(run, len(place))))
    first = np.flatnonzero(within % most == 0)
    windows = np.diff(np.append(first, len(place)))
    start = place[first]
    content = range_hashes(piece.data, start, start + windows + window - 1)
    # Of two equal windows the earlier one's anchor lies before the later one begins, so some
    # window but the last begins with the anchor.
    at_head = np.concatenate(([0], np.cumsum(grams[place] == least)))
    loops = at_head[first + windows - 1] > at_head[first]
    begin = start - piece.bounds[text[first]]
    return Contexts(text[first], begin, windows, least[first], content, loops)
