from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(60)) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, copies and near copies."""
    base, passage = prose(1, 120), prose(2, 60)
    near = base.replace(base.split()[50], "changed", 1)
    rows = [
        (1, base),
        (2, base),
        (3, near),
        (3, near),
        (4, None),
        (5, ""),
        (6, "one"),
        (7, "Ünï cødé ßtraße 日本語 \U0001f600 x" * 9),
        (8, "word " * 3000),
        (9, prose(3, 30) + "\n" + passage + "\n" + prose(4, 30)),
        (10, prose(5, 40) + "\n" + passage),
        (11, passage + " " + prose(6, 25)),
        (12, prose(7, 9000)),
        (13, "ABC def! <turn a> \\ </turn> don't 12"),
        (14, "ab" * 400),
        (None, prose(8, 40)),
        (None, passage),
        (-5, "\x00\x01 \x1c a\tb\r\nc"),
        (15, "two words"),
        (16, "two words"),
    ]
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]


def text_rows(df) -> list[tuple]:
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
