"""Threshold-scaled sketches of documents.

Every 5-word shingle has a 64-bit hash; a text's fingerprint keeps all hashes below a
fixed fraction of the range (of a text that has none below it, the least one).
What is kept depends on the shingle alone, so the fingerprint of a union
is the union of the fingerprints, and the share of a small text that lies in a
huge one is read off as well as the likeness of two equally long ones. About
``fraction`` of the shingles are kept: more for longer texts, as the estimate needs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices, texts_of, tidy

U = np.uint64
FRACTION, WORDS = 1 / 8, 5
#: Odd multipliers that mix the words of a shingle (fixed values).
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
MAX_KEPT_WORDS = 100_000


class _WordHashes(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MAX_KEPT_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


class Sketcher:
    """Texts -> sorted 64-bit hashes below ``fraction`` of the range."""

    def __init__(self, fraction: float = FRACTION, words: int = WORDS) -> None:
        self.limit, self.words, self.hashes = U(int(fraction * 2**64) - 1), words, _WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        """A-Z are lower-cased, words are parted by ASCII white space; fewer
        words than a shingle has are one shingle, no words none."""
        w = np.array(list(map(self.hashes.__getitem__, (text or "").encode("utf-8", "replace").lower().split())), U)
        k = min(self.words, len(w))
        if not k:
            return w
        with np.errstate(over="ignore"):
            x = np.full(len(w) - k + 1, k, U)
            for i in range(k):
                x = (x ^ w[i : i + len(x)]) * U(ODD[0])
                x ^= x >> U(29)
            x = (x ^ (x >> U(32))) * U(ODD[1])
            x = (x ^ (x >> U(29))) * U(ODD[2])
            x ^= x >> U(32)
        low = x[x <= self.limit]
        return np.unique(low) if len(low) else x.min(keepdims=True)


def merged(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The sketch of the union of what two sketches stand for."""
    both = np.union1d(a, b)
    low = both[both <= U(int(fraction * 2**64) - 1)]
    return low if len(low) else both[:1]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common hashes among all (Jaccard); 1 for two empty sketches."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    every = len(a) + len(b) - common
    return common / every if every else 1.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of a's hashes that b has; 1 if a is empty."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def written(sketch: np.ndarray) -> str:
    """16 hex digits for each hash, ascending."""
    return np.ascontiguousarray(sketch, ">u8").tobytes().hex()


def read(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(U)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fraction: float = FRACTION, words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, fingerprint (:func:`written`).

    Null counts as empty and has an empty fingerprint; equal texts have equal
    ones. Repeated rows stay. Other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(fraction, words)
        for batch in slices(batches, "text"):
            yield _batch([(i, len(t), written(sketch(t))) for i, t in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text"))], schema)

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(tidy(run), "doc_id long, n_chars long, fingerprint string")


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()), ("edited_contained", pa.float64()),
])
RESULT_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edited_contained double"
#: Stands for a null id, which comes first.
NO_ID = -(2**63)


def _compared(doc: int | None, text: str, own: np.ndarray, after: str, after_own: np.ndarray, sketch: Sketcher) -> tuple:
    """A result row of a text and the text that comes after it."""
    half = len(text) // 2
    edited = text[: len(text) - half] + after[:half]
    new = sketch(edited)
    sha = hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest()
    return doc, len(text), sha, written(own), written(new), likeness(own, new), likeness(own, after_own), containment(new, own)


def _range_starts(ids: DataFrame, ranges: int) -> np.ndarray:
    """The first id of each of about as many ranges of equally many rows: one number for each range."""
    ranged = ids.repartitionByRange(ranges, "id").select(F.spark_partition_id().alias("part"), "id")
    return np.array(sorted(r["least"] for r in ranged.groupBy("part").agg(F.min("id").alias("least")).collect()), np.int64)


def edits_compared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fraction: float = FRACTION, words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: its fingerprint and that of an edited text, whose
    last floor(n_chars / 2) code points are the first as many of the next row's text.

    Columns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next (likeness to the edited text and to the next one), edited_contained (share of the
    edited text's shingles that the text has). Rows follow each other by doc_id, null
    first, then by the text; after the last comes the first, and a single row is
    its own successor. Null counts as empty. Other columns are not read.

    The starts of the id ranges come from the ids alone, one per range. Texts are shuffled once, to
    their range; rows that start a range also go, behind its own rows, to the range before. So each task
    walks through sorted ranges holding two texts, and no row waits for another task. Rows that
    share an id lie in one range.
    """
    narrow = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.col(doc_id).isNotNull().alias("known"), F.col(text).alias("text"))
    spark = docs.sparkSession
    ranges = max(docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    starts = _range_starts(narrow.select("id"), ranges)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            part = np.searchsorted(starts, ids, "right") - 1
            first = np.flatnonzero(starts[part] == ids)
            for rows, to, after in ((np.arange(len(ids)), part, False), (first, (part[first] - 1) % len(starts), True)):
                if len(rows):
                    dealt = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(np.full(len(rows), after)), *dealt.columns], ["part", "after", *dealt.schema.names])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, before = Sketcher(fraction, words), None
        for batch in slices(batches, "text"):
            rows = []
            for i, known, after, now in zip(*(batch.column(c).to_pylist() for c in ("id", "known", "after")), texts_of(batch, "text")):
                if after and before is None:
                    continue  # one more row that ties with the next range's first
                own = sketch(now)
                if before is not None:
                    rows.append(_compared(*before, now, own, sketch))
                before = None if after else (i if known else None, now, own)
            if rows:
                yield _batch(rows, RESULT)

    dealt = narrow.mapInArrow(tidy(deal), "part int, after boolean, id long, known boolean, text string")
    ranged = dealt.repartitionById(max(1, len(starts)), "part").sortWithinPartitions("part", "after", "id", "known", "text")
    return ranged.mapInArrow(tidy(walk), RESULT_DDL)
