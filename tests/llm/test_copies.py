"""Exact and near copies against plain versions."""

import hashlib
import random
import re
from collections import Counter

import pytest
from helpers import PROSE, documents, odd_rows
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, ngram_join, secrets
from tessera.llm.components import connected_components


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check_exact(rows, out):
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    want = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        for i in ids:
            want[(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out) == want
    kept = Counter(r["text_sha256"] for r in out if r["kept"])
    assert set(kept.values()) <= {1} and len(kept) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])


@pytest.mark.parametrize("block", [4096, 16])
def test_exact_groups_of_odd_rows(spark, block):
    rows = odd_rows()
    check_exact(rows, exact_dedup.exact_groups(documents(spark, rows).repartition(3), block=block).collect())


def test_texts_that_differ_in_one_block_only(spark):
    base = "".join(random.Random(1).choice("ab") for _ in range(700))
    rows = [(i, base) for i in range(3)] + [(10 + i, base[:i] + "c" + base[i + 1 :]) for i in range(0, 700, 37)] + [(100, base + "c"), (101, base[:-1]), (102, base + base)]
    check_exact(rows, exact_dedup.exact_groups(documents(spark, rows), block=32).collect())


def test_a_hash_with_collisions_is_replaced(spark):
    salts = []

    def weak(salt, block):
        salts.append(salt)
        return F.struct((F.length(block) * 0 if salt == 0 else F.xxhash64(F.lit(salt), block)).cast("long").alias("a"), F.lit(0).alias("b"))

    rows = [(1, "x"), (2, "y"), (3, "x")]
    check_exact(rows, exact_dedup.exact_groups(documents(spark, rows), hashed=weak).collect())
    assert set(salts) == {0, 2}


def test_without_copies_keeps_columns_and_one_row_of_each(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    out = exact_dedup.without_copies(docs)
    assert out.columns == docs.columns
    got = Counter(normal(r["text"]) for r in out.collect())
    assert got == Counter({normal(t) for _, t in rows})


def test_exact_empty(spark):
    assert exact_dedup.exact_groups(documents(spark, [])).count() == 0
    assert exact_dedup.without_copies(documents(spark, [])).count() == 0


def test_names_are_ranks_whatever_the_partitions(spark):
    words = [("".join(random.Random(i).choices("abc", k=6)),) for i in range(300)]
    want = {w: i for i, w in enumerate(sorted({w for w, in words}))}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for shuffles, parts in (("3", 1), ("17", 5)):
            spark.conf.set("spark.sql.shuffle.partitions", shuffles)
            rows = spark.createDataFrame(words, "left string").repartition(parts).distinct()
            assert {r["left"]: r["name"] for r in exact_dedup.ranks(rows, "left").collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_columns_called_like_helpers_stay(spark):
    rows = [(1, PROSE), (1, PROSE), (2, PROSE), (3, "password = hunter2hunter2 " + PROSE), (None, "x")]
    names = ("id", "id_", "sha", "own_sha", "n", "spans", "base", "assign", "random", "__id", "__n", "__base", "__spans", "__sha", "__own_sha", "number", "__all")
    docs = documents(spark, rows).drop("row", "level", "name", "ids", "score", "spans", "token", "chunk", "key", "stats", "label", "text2")
    docs = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in names})
    whole = docs.count()
    for out, n in ((exact_dedup.without_copies(docs), 3), (ngram_join.one_of_each(docs), 3), (secrets.redacted(docs), whole)):
        assert out.columns == docs.columns
        got = out.collect()
        assert len(got) == n and all(r[c] == (None if r["doc_id"] is None else f"{c} of {r['doc_id']}") for r in got for c in names)


def test_of_repeated_ids_the_first_by_the_other_columns_stays(spark):
    docs = spark.createDataFrame([(1, "a b", 9), (1, "a  b", 3), (1, "a\tb", 5), (2, "a b", 1)], "doc_id long, text string, extra int")
    for parts in (1, 4):
        assert [tuple(r) for r in exact_dedup.without_copies(docs.repartition(parts)).collect()] == [(1, "a  b", 3)]


def shingles(text, k=5):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    links = 0
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                links += 1
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}, links


def check_near(spark, rows, **options):
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(documents(spark, rows).repartition(3), **options).collect()}
    want, links = brute(rows)
    assert out == want
    return links


def edited(r, words, edits):
    words = list(words)
    for _ in range(edits):
        words[r.randrange(len(words))] = r.choice("abcdefghij") + str(r.randrange(40))
    return " ".join(words)


def test_bands_hold_every_pair_that_fits_and_none_of_a_template(spark):
    r = random.Random(11)
    rows = []
    for token in range(4):
        for _ in range(60):
            n = r.choice([5, 6, 10, r.randint(5, 60), r.randint(100, 140), 2000])
            rows.append((token, len(rows), n, r.randint((4 * n + 4) // 5, n), r.randint(0, 30), None))
    rows = [(t, i, n, rest, c, c != 0) for t, i, n, rest, c, _ in rows]
    out = ngram_join._banded(spark.createDataFrame(rows, "token long, row long, n long, rest long, component long, outside boolean"), 80, 100)
    fits = lambda n, a, m, b: 180 * min(a, b) >= 80 * (n + m)
    got = {(min(x["row"], x["o_row"]), max(x["row"], x["o_row"])) for x in out.collect() if fits(x["n"], x["rest"], x["o_n"], x["o_rest"])}
    want = {(p[1], q[1]) for p in rows for q in rows if p[1] < q[1] and p[0] == q[0] and p[4] != q[4] and fits(p[2], p[3], q[2], q[3])}
    assert got == want and len(want) > 100
    template = spark.range(3000).selectExpr("7L AS token", "id AS row", "240L AS n", "200L AS rest", "id AS component", "id > 0 AS outside")
    smaller = spark.range(1).selectExpr("7L AS token", "9999L AS row", "200L AS n", "200L AS rest", "9999L AS component", "true AS outside")
    assert ngram_join._banded(template, 80, 100).isEmpty()
    assert ngram_join._banded(template.unionByName(smaller), 80, 100).count() == 3000


def test_pages_of_one_template(spark):
    passage = " ".join(f"shared{i}" for i in range(60))
    r = random.Random(12)
    rows = [(i, passage + " " + " ".join(f"own{i}x{j}" for j in range(r.choice([4, 9, 12, 14, 16])))) for i in range(150)]
    check_near(spark, rows)


@pytest.mark.parametrize("seed,stars", [(1, 2), (2, 0), (3, 1)])
def test_near_copies_against_all_pairs(spark, seed, stars):
    r = random.Random(seed)
    bases = [[r.choice("klmnop") + str(r.randrange(60)) for _ in range(r.randint(20, 90))] for _ in range(6)]
    rows = [(i, edited(r, r.choice(bases), r.randint(0, 4))) for i in range(120)]
    # a passage that many otherwise different texts share
    passage = " ".join(f"shared{i}" for i in range(30))
    rows += [(200 + i, passage + " " + " ".join(r.choice("qrst") + str(r.randrange(900)) for _ in range(r.randint(2, 40)))) for i in range(60)]
    assert check_near(spark, rows, stars=stars) > 50


def test_the_threshold_is_inclusive(spark):
    # 9 words: 5 shingles; 10 words of which 9 agree: 4 of 6 ... ; 12 and 13 words: 8 of 9
    w = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(w[:8])), (2, " ".join(w[:9])), (3, " ".join(w[20:28])), (4, " ".join(w[20:28]).upper()), (5, "w1 w2"), (6, "W1  w2"), (7, "w2 w1")]
    check_near(spark, rows)  # 4 of 5 shingles is 0.8


def test_near_odd_rows(spark):
    rows = [(i, t) for i, t in odd_rows() if i is not None]
    rows = list(dict(rows).items())
    check_near(spark, rows)
    out = ngram_join.near_duplicates(documents(spark, odd_rows())).collect()
    assert len(out) == len(odd_rows())
    assert sorted((r["n_shingles"], r["component_id"]) for r in out if r["doc_id"] is None) == [(0, None), (1, None)]


def test_one_of_each(spark):
    rows = [(1, PROSE), (2, PROSE + " x"), (3, "alone here"), (4, ""), (5, None)]
    docs = documents(spark, rows)
    out = ngram_join.one_of_each(docs)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 3, 4, 5]


def test_near_empty(spark):
    assert ngram_join.near_duplicates(documents(spark, [])).count() == 0
    assert ngram_join.one_of_each(documents(spark, [])).count() == 0


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300), (201, 200), (None, 5)]
    random.Random(2).shuffle(edges)
    out = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 1 for i in range(1, 31)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200, 202: 200}
    assert out == want
