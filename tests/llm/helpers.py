"""Rows that every operator must handle: nulls, empty and long texts, ties,
repeated rows, and columns whose names clash with an operator's own."""

import re

CLASH = "row long, level int, name string, ids string, score string, spans string, token string, chunk long, key string, stats string, label string, text2 string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
EXTRA = (1, 2, "n", "i", "s", "p", "t", 3, "k", "st", "l", "x")

PROSE = "the quick brown fox jumps over the lazy dog while seven small birds sing in a tall tree near the old mill by the river"


def documents(spark, rows):
    """rows: (doc_id, text)."""
    data = [(i, t, None, None, None if t is None else len(t), *EXTRA) for i, t in rows]
    return spark.createDataFrame(data, SCHEMA)


def odd_rows():
    long_text = " ".join(f"word{i % 997} token{i}" for i in range(30_000))
    return [
        (1, PROSE),
        (2, PROSE),
        (2, PROSE),
        (3, PROSE.replace(" ", "\n", 3) + "\t \n"),
        (4, None),
        (5, ""),
        (6, " \t\n "),
        (7, "one"),
        (8, PROSE + " and then"),
        (None, "no id here"),
        (None, None),
        (9, long_text),
        (10, long_text),
        (11, "déjà vu — 東京 🙂 don't <|endoftext|> x y  z\x1c\x85w"),
        (12, "a" * 5_000),
        (13, "0" * 300 + " " + "=" * 50),
    ]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
