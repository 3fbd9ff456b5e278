"""Small tables with the cases every operator defines: nulls, empty, long, repeated, clashing."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    made = ["".join(draw.choice("abcdefghilmnoprstu") for _ in range(draw.randint(2, 8))) for _ in range(words)]
    return " ".join(made) + "."


LONG = prose(99, 60_000)

ROWS = [
    (1, prose(1, 40) + "\nA line that several documents share.\n" + prose(2, 30), "en", "a", 10),
    (2, "Other start.\n  a LINE that several documents share.  \n" + prose(3, 30), "en", "b", 11),
    (3, prose(1, 40) + "\nA line that several documents share.\n" + prose(2, 30), "de", None, 12),
    (3, prose(1, 40) + "\nA line that several documents share.\n" + prose(2, 30), "de", None, 12),
    (4, None, None, "a", None),
    (5, "", "fr", "a", 0),
    (None, prose(5, 25), "es", "b", 7),
    (6, LONG, "en", "c", len(LONG)),
    (7, "one two three", "en", "c", 13),
    (8, "one TWO three", "fr", "c", 13),
    (9, " \t\n\n ", None, None, None),
    (10, "Ünïcödé漢字 🙂🙂 don't they'll 'tis\r\n\x0bx", "de", "d", 30),
    (11, "z" * 5000, "en", "d", 5000),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
