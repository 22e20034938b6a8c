"""The queries' SQL, and the pipeline against a plain version."""

import re

import duckdb
import pytest
from helpers import documents, odd_rows
from test_copies import brute, normal
from test_filters import base_spans
from test_tokens import check_packing

import corpus_pipeline
from tessera.llm import quality, queries, secrets
from tessera.llm.common import fold

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations", "embeddings")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(queries.oracle_sql()[name])
    want = sorted(map(str, (dict(sorted(zip(rel.columns, r))) for r in rel.fetchall())))
    got = sorted(map(str, (dict(sorted(r.asDict().items())) for r in queries.QUERIES[name](spark, SF).collect())))
    assert got == want and got


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_pipeline_against_a_plain_version(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.learnt(docs, spark.read.parquet(f"{SF}/labels.parquet"), fold() != 2)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    import numpy as np

    rows = [(i, t) for i, t in rows if 1 / (1 + np.exp(-model.log_odds(np.array([quality.statistics(t)]))[0])) >= 0.7]
    first = {}
    for i, t in sorted(rows):
        first.setdefault(normal(t), (i, t))
    rows = sorted(first.values())
    near, _ = brute(rows)
    rows = [(i, t) for i, t in rows if near[i][1] == i]
    after = {r["doc_id"]: r["text"] for r in secrets.redacted(documents(spark, rows)).collect()}
    for i, t in rows:
        assert ("[SECRET]" in after[i]) >= bool(base_spans(t)) and not base_spans(after[i])
    pieces = [r.asDict() | {"crc": r["ids_crc32"]} for r in corpus_pipeline.run(spark, SF).collect()]
    assert {p["doc_id"] for p in pieces} == set(after)
    assert check_packing(pieces, after, library, 2048) == 0


def test_stages_take_odd_rows_and_empty_tables(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    for rows in (odd_rows(), []):
        docs = documents(spark, rows).select(*schema.names)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.columns == docs.columns and out.dtypes == docs.dtypes
            if name == "secrets":
                assert out.count() == len(rows)
            elif not rows:
                assert out.count() == 0


def test_stages_are_as_agreed():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "ngram_join", "secrets", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries()} == set(range(1, 14))
