"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
it kept; all but the last return the columns of ``documents``. Between stages
the rows lie as Parquet in the shared scratch folder. Null texts count as empty
in every stage, repeated rows are copies of which one stays, and an empty
table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, ngram_join, packing, quality, secrets
from tessera.llm.common import fold, stored, table
from tessera.llm.queries import packed_pieces, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.7 or more."""
    return quality.accepted(docs, quality.learnt(docs, table(spark, sf_dir, "labels"), fold() != 2))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_of_each(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; n_chars follows the text."""
    out = secrets.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 ids."""
    return packed_pieces(packing.pack_documents(docs, tokenizer_path(), kept_units=150_000))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("ngram_join", near_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the classifier nor the tokenizer; tests/llm holds a plain version against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
