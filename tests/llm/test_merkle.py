"""Merkle manifests against a plain version."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import documents, odd_rows
from pyspark.sql import functions as F

from tessera.llm import merkle, queries

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS))


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def tree(hashes):
    """The root, and per leaf its (left, right) of each level."""
    paths, owner = [[] for _ in hashes], [[i] for i in range(len(hashes))]
    while len(hashes) > 1:
        above, owners = [], []
        for a in range(0, len(hashes), 16):
            run = hashes[a : a + 16]
            for j in range(len(run)):
                for i in owner[a + j]:
                    paths[i].append((run[:j], run[j + 1 :]))
            above.append(h(*run))
            owners.append([i for part in owner[a : a + 16] for i in part])
        hashes, owner = above, owners
    return hashes[0], paths


def plain(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    low = {}
    for name in names:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        low[name] = tree([leaf(r) for r in groups[name]])
    if not names:
        return Counter()
    root, tops = tree([low[s][0] for s in names])
    out = Counter()
    for name, top in zip(names, tops):
        for r, path in zip(groups[name], low[name][1]):
            path = path + top
            now = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                now["text"] = lower(r["text"])
            fold = leaf(now)
            for left, right in path:
                fold = h(*left, fold, *right)
            proof = h(*(x for left, right in path for x in left + right))
            out[(r["doc_id"], leaf(r), low[name][0], root, proof, fold, fold == root)] += 1
    return out


def check(spark, rows):
    """rows: (doc_id, text, source)."""
    docs = documents(spark, [(i, t) for i, t, _ in rows])
    docs = docs.drop("source", "lang").join(spark.createDataFrame([(i, t, s) for i, t, s in dict.fromkeys(rows)], "i long, t string, source string"),
                                    F.col("i").eqNullSafe(F.col("doc_id")) & F.col("t").eqNullSafe(F.col("text"))).drop("i", "t")
    docs = docs.withColumns({"lang": F.when(F.col("doc_id") % 2 == 0, "dé"), "g": F.lit(1), "pos": F.lit(2), "n": F.lit(3), "hash": F.lit("x"), "run": F.lit(4), "leaf": F.lit("y"), "keep_0": F.lit(0)})
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = merkle.tamper_check(docs.repartition(5), tampered, lowered)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = Counter(map(tuple, out.collect()))
    want = plain([r.asDict() for r in docs.collect()])
    assert got == want
    return got


@pytest.mark.parametrize("n", [1, 2, 16, 17, 33, 256, 257])
def test_one_source_of_each_size(spark, n):
    got = check(spark, [(i * 7 - 20, f"Text {i}", "S") for i in range(n)])
    assert sum(got.values()) == n and any(not k[-1] for k in got) == any(zlib.crc32(str(i * 7 - 20).encode()) % 5 == 0 for i in range(n))


def test_many_sources_and_a_hot_one(spark):
    rows = [(i, f"Hello {i % 9}", f"s{i}" if i % 3 else "hot") for i in range(300)] + [(1000, "A", None), (1001, None, None), (1002, "Ä", ""), (1003, "z", "é"), (1004, "q", "zz")]
    got = check(spark, rows)
    assert len({k[2] for k in got}) > 200 and len({k[3] for k in got}) == 1


def test_odd_rows(spark):
    check(spark, [(i, t, None if (i or 0) % 3 == 0 else "src") for i, t in odd_rows()])


def test_no_rows(spark):
    docs = documents(spark, [])
    assert merkle.tamper_check(docs, F.lit(True), F.col("text")).count() == 0


def test_tampering_shows_exactly_where_the_text_changes(spark):
    got = check(spark, [(i, "no capitals" if i % 2 else "Capitals", "S") for i in range(100)])
    for (i, _, _, _, _, _, verified), _ in got.items():
        assert verified == (i % 2 == 1 or zlib.crc32(str(i).encode()) % 5 != 0)


def test_manifests_of_equal_rows_agree_whatever_the_partitions(spark):
    docs = documents(spark, [(i, f"T{i}") for i in range(70)]).withColumn("own", F.sha2("text", 256))
    tables = [set(map(tuple, merkle.nodes(merkle.manifest(docs.repartition(k), "lang", "doc_id", "own")).collect())) for k in (1, 6)]
    assert tables[0] == tables[1] and sum(r[0] == "group" and r[2] == 0 for r in tables[0]) == 70
    changed = docs.withColumn("own", F.when(F.col("doc_id") == 33, F.sha2(F.lit("other"), 256)).otherwise(F.col("own")))
    other = set(map(tuple, merkle.nodes(merkle.manifest(changed, "lang", "doc_id", "own")).collect()))
    assert sorted((r[0], r[2], r[3]) for r in other - tables[0]) == [("group", 0, 33), ("group", 1, 2), ("group", 2, 0), ("top", 0, 0)]


def test_query_has_the_contract_s_columns():
    assert "op11_merkle_manifest" in queries.queries() and "op11_merkle_manifest" in queries.oracle_sql()
