"""Threshold-scaled sketches against plain sets."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import PROSE, documents, odd_rows, words
from pyspark.sql import functions as F

from tessera.llm import fingerprints as fp


def shingles(text):
    w = [x.lower() if x.isascii() else "".join(c.lower() if c.isascii() else c for c in x) for x in words(text)]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def prose(r, n):
    return " ".join(f"{r.choice('abcdefgh')}{r.randrange(4000)}" for _ in range(n))


def test_with_the_whole_range_a_sketch_is_the_set():
    r = random.Random(4)
    texts = [prose(r, n) for n in (0, 1, 4, 5, 6, 60, 300)] + [PROSE, PROSE.upper(), PROSE + " " + PROSE, "é É é É é É", "a\x1cb c\x85d e f g"]
    sketch = fp.Sketcher(1.0)
    for a in texts:
        assert len(sketch(a)) == len(shingles(a))
        for b in texts:
            x, y = shingles(a), shingles(b)
            assert fp.likeness(sketch(a), sketch(b)) == (len(x & y) / len(x | y) if x | y else 1.0)
            assert fp.containment(sketch(a), sketch(b)) == (len(x & y) / len(x) if x else 1.0)


def test_only_hashes_below_the_threshold_stay_and_the_least_of_none():
    r = random.Random(5)
    for n in (5, 6, 9, 40, 4000):
        t = prose(r, n)
        whole, part = fp.Sketcher(1.0)(t), fp.Sketcher(1 / 8)(t)
        low = whole[whole < np.uint64(2**61)]
        assert part.tolist() == (low.tolist() or [whole.min()])
    assert 0.1 < len(part) / len(whole) < 0.15


def test_sketches_merge():
    r = random.Random(6)
    sketch = fp.Sketcher(1 / 8)
    for n, m in ((5, 5), (6, 8), (50, 6), (3000, 10), (200, 300)):
        a, b = prose(r, n), prose(r, m)
        every = np.union1d(fp.Sketcher(1.0)(a), fp.Sketcher(1.0)(b))
        low = every[every < np.uint64(2**61)]
        assert fp.merged(sketch(a), sketch(b)).tolist() == (low.tolist() or [every.min()])


def test_containment_of_a_small_text_in_a_huge_one():
    r = random.Random(7)
    small = [prose(r, 800) for _ in range(20)]
    huge = fp.Sketcher()(" ".join(prose(r, 20_000) + " " + s for s in small[:10]))
    found = [fp.containment(fp.Sketcher()(s), huge) for s in small]
    assert min(found[:10]) > 0.95 and max(found[10:]) < 0.05


def test_likeness_is_close_to_the_sets(spark):
    r = random.Random(8)
    errors = []
    for _ in range(60):
        a = prose(r, 1500).split()
        k = r.randrange(1500)
        b = a[:k] + prose(r, 1500 - k).split()
        a, b = " ".join(a), " ".join(b)
        errors.append(fp.likeness(fp.Sketcher()(a), fp.Sketcher()(b)) - len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.05


def test_written_fingerprints_are_read_back():
    s = fp.Sketcher()(PROSE * 9)
    assert fp.read(fp.written(s)).tolist() == s.tolist() and fp.written(fp.Sketcher()("")) == ""


def plain(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    sketch, out = fp.Sketcher(), Counter()
    for (i, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        x, y, z = sketch(t), sketch(edited), sketch(after)
        sha = hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest()
        out[(i, len(t), sha, fp.written(x), fp.written(y), fp.likeness(x, y), fp.likeness(x, z), fp.containment(y, x))] += 1
    return out


@pytest.mark.parametrize("shuffles", ["1", "7", "200"])
def test_edits_against_a_plain_version(spark, shuffles):
    r = random.Random(9)
    rows = [(i * 3, prose(r, r.choice([0, 1, 3, 30, 300]))) for i in range(120)] + [(1, None), (500, "é🙂" * 41), (501, PROSE), (502, PROSE), (None, "none"), (None, "other"), (-(2**63), "least"), (501, "tie")]
    r.shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = documents(spark, rows).withColumns({"id": F.lit(1), "part": F.lit(2), "known": F.lit(3), "fingerprint": F.lit("x"), "after": F.lit("y")})
        out = fp.edits_compared(docs.repartition(4))
        assert out.columns == fp.RESULT.names
        assert Counter(map(tuple, out.collect())) == plain([(i, t or "") for i, t in rows])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_rows(spark):
    rows = odd_rows()
    for size in (len(rows), 1, 0):
        part = rows[:size]
        out = fp.edits_compared(documents(spark, part)).collect()
        assert Counter(r["doc_id"] for r in out) == Counter(i for i, _ in part)
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
        one = fp.fingerprints(documents(spark, part)).collect()
        want = Counter((i, len(t or ""), fp.written(fp.Sketcher()(t))) for i, t in part)
        assert Counter(map(tuple, one)) == want
    # a single row follows itself: its first half twice, less an odd code point
    assert Counter((r["doc_id"], r["fingerprint"]) for r in out) == Counter((i, fp.written(fp.Sketcher()(t))) for i, t in part)
