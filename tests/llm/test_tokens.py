"""Byte-level BPE and packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import documents, odd_rows

from tessera.llm import bpe, packing, queries
from tessera.llm.units import UnitCoder


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def random_texts(n=400, seed=3):
    r = random.Random(seed)
    alphabet = "aAbeé ñ  \n\t.,!'’1 9½²_-  \x1c\x85東🙂é<|>"
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(n)] + [
        "<|endoftext|>", " <|endoftext|> ", "a<|endoftext|>\nb", "aaaaaaaaaaa", "foo.bar,baz. 12ab", "it's we'LL don't",
    ]


@pytest.mark.parametrize("make", [bpe.Bpe, packing.library_encoder])
def test_units_give_the_library_s_ids(library, make):
    coder = UnitCoder(make(open(queries.tokenizer_path()).read()))
    texts = random_texts()
    flat, lens = coder(texts)
    ends = np.concatenate([[0], np.cumsum(lens)])
    for text, a, b in zip(texts, ends, ends[1:]):
        assert flat[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_segments_of_long_texts_do_not_change_ids(library, monkeypatch):
    monkeypatch.setattr("tessera.llm.units.SEGMENT", 7)
    texts = random_texts(100, 5)
    coder = UnitCoder(bpe.Bpe(open(queries.tokenizer_path()).read()))
    flat, lens = coder(texts)
    assert flat.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]


def test_encode_and_decode_odd_rows(spark, library):
    rows = odd_rows()
    ids = bpe.encode(documents(spark, rows), queries.tokenizer_path())
    out = bpe.decode(ids, queries.tokenizer_path(), keep=("doc_id", "ids")).collect()
    got = sorted((r["doc_id"] or 0, r["ids"], r["decoded"]) for r in out)
    want = []
    for i, t in rows:
        e = library.encode(t or "", add_special_tokens=False).ids
        want.append((i or 0, e, library.decode(e, skip_special_tokens=False)))
    assert got == sorted(want)


def test_decode_of_broken_ids(spark, library):
    rows = spark.createDataFrame([(1, [10, 200, 99_999_999, -4, None]), (2, None), (3, [])], "doc_id long, ids array<int>")
    out = {r["doc_id"]: r["decoded"] for r in bpe.decode(rows, queries.tokenizer_path()).collect()}
    assert out == {1: library.decode([10, 200], skip_special_tokens=False), 2: "", 3: ""}


def test_empty_tables(spark):
    none = documents(spark, [])
    assert bpe.decode(bpe.encode(none, queries.tokenizer_path()), queries.tokenizer_path()).count() == 0
    assert packing.pack_documents(none, queries.tokenizer_path()).count() == 0


def check_packing(pieces, texts, library, capacity):
    """Every id once, sequences gapless; padding in all."""
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append(p)
    for doc, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            assert p["crc"] == zlib.crc32(np.array(ids[at : at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    padding = 0
    for group in by_seq.values():
        at = 0
        for p in sorted(group, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


@pytest.mark.parametrize("capacity,window", [(2048, 256), (64, 4), (64, 1)])
def test_packing_odd_rows(spark, library, capacity, window):
    rows = {i: t for i, t in odd_rows() if i is not None}
    docs = documents(spark, list(rows.items())).repartition(3)
    out = packing.pack_documents(docs, queries.tokenizer_path(), capacity=capacity, window=window)
    pieces = [r.asDict() for r in out.select("*", packing.ids_crc32().alias("crc")).collect()]
    assert check_packing(pieces, rows, library, capacity) == 0
    assert {p["doc_id"] for p in pieces} == set(rows)


def test_packing_keeps_repeated_and_null_ids(spark):
    out = packing.pack_documents(documents(spark, [(1, "a b"), (1, "a b"), (None, "c")]), queries.tokenizer_path()).collect()
    total = {}
    for r in out:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == {None: 2, 1: 6} and {r["doc_tokens"] for r in out} == {2, 3}


def test_packing_balances_cost():
    r = random.Random(1)
    p = packing.Packer(2048, 64, 1.0, 1 / 2048, 0)
    for i in range(2_000):
        p.add(i, np.zeros(r.choice([20, 60, 200, 700]), np.int32))
    p.finish()
    cost, size = {}, {}
    for _, _, n, _, s, _, c, _ in p.out:
        cost[s] = cost.get(s, 0) + c
        size[s] = size.get(s, 0) + n
    full = [cost[s] for s in cost if size[s] == 2048]
    assert len(full) > 200 and np.std(full) < 0.1 * np.mean(full)


def test_op9_query_matches_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    out = queries.QUERIES["op9_bpe"](spark, sf).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op3_query_is_whole_and_tight(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    pieces = [r.asDict() | {"crc": r["ids_crc32"]} for r in queries.QUERIES["op3_packing"](spark, sf).collect()]
    assert check_packing(pieces, texts, library, 2048) == 0
