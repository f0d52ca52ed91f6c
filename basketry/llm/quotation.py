"""Which words of a text are quoted: between paired quotation marks, or on a quoting line."""

from __future__ import annotations

from functools import cache

import numpy as np

from basketry.llm.texts import Slice, Words

LONGEST = 48  # words between two marks of a pair
REACH = 6  # words from a quoted one to a word that reports speech
SPACE = 10  # class of white space in the table of marks
# Fixed values. Marks of one string pair with each other; which one opens is told by what
# stands around them, else by the mark: small letters o and c below.
MARKS = (
    ("\"“”„‟″〝〞", "xocooxoc"),
    ("'‘’‚‛`", "xocoox"),
    ("«»", "oc"),
    ("‹›", "oc"),
    ("「」", "oc"),
    ("『』", "oc"),
    ("《》", "oc"),
)
OPENING, CLOSING = (np.array([ord(c) for c in signs]) for signs in ("([{-–—", ")]}.,;:!?-–—…"))
# Words that report what somebody said, in the languages of the corpus.
REPORTING = frozenset(
    "said says saying wrote writes written called calls quote quoted quotes replied shouted "
    "word words term insult insults slur "
    "sagte sagt schrieb schreibt nannte rief wort "
    "dit disait écrit écrivait appelé traité mot "
    "dijo dice escribió escribe llamó gritó palabra "
    "disse scrisse escreveu chamou parola palavra".split()
)


@cache
def _marks() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: class of the mark from 1, SPACE, or 0; 1 opens, -1 closes, or 0."""
    group, side = np.zeros(0x110000, np.uint8), np.zeros(0x110000, np.int8)
    for k, (marks, sides) in enumerate(MARKS, 1):
        for mark, way in zip(marks, sides, strict=True):
            group[ord(mark)] = k
            side[ord(mark)] = {"o": 1, "c": -1, "x": 0}[way]
    for code in range(0x3001):
        if chr(code).isspace():
            group[code] = SPACE
    return group, side


def sides(piece: Slice, letter: np.ndarray, at: np.ndarray) -> np.ndarray:
    """1 for a mark that opens, -1 for one that closes, 0 for one inside a word.

    ``at``: places of the marks. White space on one side only decides, else a letter on one
    side only, else the mark itself, else a bracket or stop beside it. Ends of texts count as white space.
    """
    group, own = _marks()
    data = piece.data
    text = np.searchsorted(piece.bounds, at, "right") - 1
    first, last = at == piece.bounds[text], at + 1 == piece.bounds[text + 1]
    before, after = data[np.maximum(at - 1, 0)], data[np.minimum(at + 1, len(data) - 1)]
    space_before = first | (group[before] == SPACE)
    space_after = last | (group[after] == SPACE)
    letter_before = ~first & (letter[before] > 0)
    letter_after = ~last & (letter[after] > 0)
    way = own[data[at]].astype(np.int64)
    # An apostrophe between letters is part of a word.
    inside = letter_before & letter_after & (group[data[at]] == 2)
    way = np.where(letter_after & ~letter_before, 1, np.where(letter_before & ~letter_after, -1, way))
    way = np.where(space_before & ~space_after, 1, np.where(space_after & ~space_before, -1, way))
    # Between two signs an undecided mark leans on the one that holds it.
    way = np.where((way == 0) & ~letter_after & np.isin(after, CLOSING), -1, way)
    way = np.where((way == 0) & ~letter_before & np.isin(before, OPENING), 1, way)
    # Brackets of scripts without spaces always show their side.
    way = np.where(group[data[at]] >= 5, own[data[at]], way)
    return np.where(inside, 0, way)


def quoted(piece: Slice, found: Words, letter: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """For every word number in ``hit`` (rising): whether it is quoted.

    Quoted is a word between an opening mark and the next mark of the same class, if that
    closes, on the same line and at most LONGEST words on; and a word on a line that begins
    with > (up to three spaces before it). ``letter``: kind of every code point, 0 for none.
    """
    group, _ = _marks()
    data = piece.data
    start = found.start[hit]
    lines = np.union1d(piece.bounds[:-1], np.flatnonzero(data == 10) + 1)
    begin = lines[np.searchsorted(lines, start, "right") - 1]
    out = np.zeros(len(hit), bool)
    open_line = np.ones(len(hit), bool)
    for k in range(4):
        here = data[np.minimum(begin + k, start)]
        out |= open_line & (here == ord(">"))
        open_line &= here == ord(" ")
    kinds = group[data]
    places = np.flatnonzero((kinds > 0) & (kinds < SPACE))
    if not len(places):
        return out
    way = sides(piece, letter, places)
    places, way = places[way != 0], way[way != 0]
    for kind in np.unique(kinds[places]):
        chosen = kinds[places] == kind
        at, turn = places[chosen], way[chosen]
        if len(at) < 2:
            continue
        after = np.searchsorted(at, start)
        framed = (after > 0) & (after < len(at))
        after = np.clip(after, 1, len(at) - 1)
        left, right = at[after - 1], at[after]
        framed &= (turn[after - 1] == 1) & (turn[after] == -1)
        framed &= np.searchsorted(lines, left, "right") == np.searchsorted(lines, right, "right")
        framed &= np.searchsorted(found.start, right) - np.searchsorted(found.start, left) <= LONGEST
        out |= framed
    return out


def reported(piece: Slice, found: Words, hit: np.ndarray) -> np.ndarray:
    """For every word number in ``hit``: a reporting word stands within REACH words of it in
    its text."""
    if not len(hit):
        return np.zeros(0, bool)
    near = hit[:, None] + np.arange(-REACH, REACH + 1)
    inside = (near >= 0) & (near < len(found.start))
    near = np.clip(near, 0, len(found.start) - 1)
    inside &= found.text[near] == found.text[hit][:, None]
    words, where = np.unique(near, return_inverse=True)
    length = found.end[words] - found.start[words]
    says = np.zeros(len(words), bool)
    for k in np.flatnonzero(length <= 12):
        lo, hi = found.start[words[k]], found.end[words[k]]
        says[k] = piece.data[lo:hi].astype(np.uint32).tobytes().decode("utf-32-le") in REPORTING
    return (says[where.reshape(near.shape)] & inside).any(axis=1)
