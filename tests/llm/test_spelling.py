"""Spelling variants against plain string comparison."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from helpers import documents, odd_rows

from tessera.llm import spelling


def runs(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(n):
    by = {w: [] for w in n}
    for a, b in itertools.combinations(n, 2):
        if abs(len(a) - len(b)) < 2 and near(a, b):
            by[a].append(b)
            by[b].append(a)
    form = {}
    for w, others in by.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(by[w]), n[form[w]] if form[w] else None))
    return out


def check(spark, n):
    out = spelling.spelling_forms(spark.createDataFrame(list(n.items()), "word string, n long"))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = out.collect()
    assert len(got) == len(n) and set(map(tuple, got)) == plain(n)
    return got


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_words(spark, seed):
    r = random.Random(seed)
    words = {"".join(r.choice("abé") for _ in range(r.randint(1, 7))) for _ in range(400)}
    got = check(spark, {w: r.choice([1, 1, 2, 3, 5, 9, 40]) for w in words})
    assert sum(r["n_near"] for r in got) > 1000 and sum(r["form"] is not None for r in got) > 100


def test_runs_of_equal_letters_and_chains(spark):
    n = {"a" * k: 3 ** (12 - k) for k in range(1, 12)} | {"aab": 4, "aabb": 4, "abab": 4, "baba": 4, "ab": 100, "ba": 100}
    got = {r["word"]: r for r in check(spark, n)}
    assert got["a" * 11]["root"] == "a" and got["ab"]["n_near"] > 2


def test_a_letter_s_whole_alphabet_at_one_place(spark):
    letters = [chr(c) for c in range(0x61, 0x7B)] + [chr(c) for c in range(0xC0, 0x100)]
    check(spark, {f"pre{c}suf": i + 1 for i, c in enumerate(letters)} | {"presuf": 500, "prensuff": 7, "東京🙂": 3, "東🙂": 9})


def test_words_longer_than_plain_labels(spark):
    r = random.Random(3)
    n = {}
    for k in (23, 24, 25, 26, 27, 60, 3000):
        w = "".join(r.choice("abcdefgh") for _ in range(k))
        for v in (w, w[:-1], w[1:], w[: k // 2] + "x" + w[k // 2 :], "y" + w[1:], w[:-1] + "z", w[: k // 2] + w[k // 2 + 2 :]):
            n[v] = r.randint(1, 30)
    check(spark, n)


def test_counts_of_odd_rows(spark):
    rows = odd_rows() + [(20 + i, "Straße STRASSE naïve×÷ Ünter ünter don't x1Word word_word ſtrange ÿÿÿÿÿ") for i in range(3)]
    rows += [(100 + i, " ".join(["common", "Common", "commen"] * 40)) for i in range(200)]
    docs = documents(spark, rows)
    got = {r["word"]: r["n"] for r in spelling.word_counts(docs.repartition(3), damage=97).collect()}
    assert got == runs(rows)
    assert len({w for w in got if len(w) == 5 and not set(w) - set("comn")} | {"common"}) > 2  # some runs lost a letter
    plain_counts = {r["word"]: r["n"] for r in spelling.word_counts(docs).collect()}
    assert plain_counts["common"] == 16000 and plain_counts["naïve×÷"] == 3


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MAX_COUNTED", 3)
    rows = [(i, "alpha beta gamma delta epsilon") for i in range(9)]
    assert {r["word"]: r["n"] for r in spelling.word_counts(documents(spark, rows)).collect()} == {"alpha": 9, "gamma": 9, "delta": 9, "epsilon": 9}


def test_no_words(spark):
    assert spelling.spelling_forms(spelling.word_counts(documents(spark, []))).count() == 0
    assert [tuple(r) for r in spelling.spelling_forms(spark.createDataFrame([("alone", 5), (None, 9)], "word string, n long")).collect()] == [("alone", None, "alone", 5, 0, None)]
