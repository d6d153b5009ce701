"""Small tables for the training-data operators: planted cases and odd rows."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = ["ka", "lo", "mi", "ren", "tas", "vo", "pel", "nu", "dra", "sin", "qui", "for", "ble", "or", "en"]


def words(text):
    return WORD.findall(text or "")


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def planted(seed: int = 3) -> list[tuple[int, str]]:
    """Prose with exact copies, near copies, shared passages and repeats inside one text."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(30, 220))) for i in range(60)]
    passage = prose(rng, 60)
    for i in range(60, 75):
        base = rows[rng.randrange(10)][1].split(" ")
        for _ in range(rng.choice((0, 0, 1, 2, 6))):
            base[rng.randrange(len(base))] = "changed" + str(rng.randrange(1000))
        rows.append((i, " ".join(base)))
    for i in range(75, 90):
        rows.append((i, f"{prose(rng, rng.randint(0, 40))} {passage}\t{prose(rng, rng.randint(0, 40))}"))
    rows += [(90, "  ".join([prose(rng, 25)] * 3)), (91, rows[5][1]), (92, "one two"), (93, "one two"), (94, "ab " * 200)]
    return rows


#: Columns whose names are used inside operators too.
CLASHES = ("key", "home", "path", "n", "kept", "gone", "id", "class_id", "bad_id", "h", "a.b", "seen")


def odd_rows() -> list[tuple]:
    """Nulls in each column, empty texts, repeated rows, ties, and a very long text."""
    long = " ".join(prose(random.Random(9), 50) + f" w{i}" for i in range(1500))
    rows = [
        (None, None, None, None), (None, "a text without an id " + prose(random.Random(1), 40), None, 1), (1, None, "en", None),
        (2, "", "en", 0), (3, " \t\n", None, 3), (4, "x", "en", 1), (5, long, "en", len(long)), (5, long, "en", len(long)),
        (6, "tie " * 3, "de", 12), (6, "other text of the same id " + prose(random.Random(2), 60), "de", 5),
        (7, "ünïcödé \u00a0 texts\u2003with wide spaces  and  doubles \U0001f600", "de", 9), (8, "<|endoftext|>", None, 13),
    ]
    return [(*r, *range(len(CLASHES))) for r in rows]


def odd_docs(spark, rows=None):
    kinds = "doc_id long, text string, lang string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASHES)
    return spark.createDataFrame(odd_rows() if rows is None else rows, kinds)
