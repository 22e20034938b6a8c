"""Regularised quadratic discriminant over document statistics.

Every text gives a row of statistics, transformed towards normal shape. Class
means and covariances come from sums over all labelled rows that Spark adds
up, so only those sums reach the driver. Each covariance is
shrunk towards the pooled one and that towards its diagonal; the Cholesky
factors are computed once and used for every row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices, stored, texts_of, tidy

STATISTICS = (
    "words", "word_length", "word_length_spread", "upper", "digits", "symbols", "stops", "distinct_words", "top_word",
    "same_as_last", "distinct_pairs", "short_words", "lines", "repeated_lines", "byte_entropy", "marked_words",
)
#: Bytes of the counted classes (fixed values).
SYMBOLS, STOPS, MARKS = b"#*$%&|<>!~^_=+{}[]\\@", b".,;:?", b"!#$%&*|"


def _logit(count: float, total: float) -> float:
    """Log odds of a share, half a case added to either side."""
    return float(np.log((count + 0.5) / (max(total - count, 0) + 0.5)))


def statistics(text: str) -> list[float]:
    """The transformed statistics of one text; those of "" are finite too."""
    raw = text.encode("utf-8", "replace")
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    n = len(words)
    lens = np.fromiter(map(len, words), np.float64, n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    seen = Counter(words)
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    share = count[count > 0] / max(1, len(raw))
    again = sum(map(eq, words, words[1:]))
    return [
        float(np.log1p(n)),
        float(np.log1p(lens.mean())) if n else 0.0,
        float(np.log1p(lens.std())) if n else 0.0,
        _logit(upper, upper + lower),
        _logit(int(count[48:58].sum()), len(raw)),
        _logit(int(count[list(SYMBOLS)].sum()), len(raw)),
        _logit(int(count[list(STOPS)].sum()), n),
        _logit(len(seen), n),
        _logit(max(seen.values(), default=0), n),
        _logit(again, n),
        _logit(len(set(zip(words, words[1:]))), max(0, n - 1)),
        _logit(int((lens <= 3).sum()), n),
        float(np.log1p(len(lines))),
        _logit(len(lines) - len(set(lines)), len(lines)),
        float(-(share * np.log2(share)).sum()),
        _logit(sum(w[-1] in MARKS for w in words), n),
    ]


def with_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, stats array<double>) of every row; null text reads as empty."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            stats = [statistics(t) for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(stats, pa.list_(pa.float64()))], ["doc_id", "stats"])

    return narrow.mapInArrow(tidy(run), "doc_id long, stats array<double>")


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log constants of the two classes."""

    mean: np.ndarray
    factor: np.ndarray
    constant: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        part = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.mean, self.factor, self.constant)]
        return part[1] - part[0]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    k = len(STATISTICS)
    total = np.zeros((2, 1 + k + k * k))
    for batch in batches:
        if batch.num_rows:
            x, y = _matrix(batch.column("stats")), batch.column("label").to_numpy(zero_copy_only=False)
            for label in (0, 1):
                own = x[y == label]
                total[label] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    label, place = np.divmod(np.arange(total.size), total.shape[1])
    yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(place), pa.array(total.ravel())], ["label", "place", "value"])


def fit(rows: DataFrame, pool: float = 0.2, diagonal: float = 0.05) -> Discriminant | None:
    """The discriminant of rows (stats, label 0 or 1); None unless both
    classes have rows. ``pool`` is the weight of the pooled covariance in each
    class's, ``diagonal`` that of the diagonal in the result."""
    k = len(STATISTICS)
    # as many partial rows as partitions and places; what is collected has a fixed size
    sums = rows.mapInArrow(tidy(_sums), "label long, place long, value double").groupBy("label", "place").agg(F.sum("value").alias("value"))
    total = np.zeros((2, 1 + k + k * k))
    for r in sums.collect():
        total[r["label"], r["place"]] = r["value"]
    n = total[:, 0]
    if not n.all():
        return None
    mean = total[:, 1 : 1 + k] / n[:, None]
    within = total[:, 1 + k :].reshape(2, k, k) - n[:, None, None] * mean[:, :, None] * mean[:, None, :]
    pooled = within.sum(axis=0) / n.sum()
    factor, constant = [], []
    for c in (0, 1):
        cov = (1 - pool) * within[c] / n[c] + pool * pooled
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + 1e-6 * np.eye(k)
        low = np.linalg.cholesky(cov)
        factor.append(np.linalg.inv(low))
        constant.append(float(np.log(n[c] / n.sum()) - np.log(np.diag(low)).sum()))
    return Discriminant(mean, np.array(factor), np.array(constant))


def labelled(stats: DataFrame, labels: DataFrame, keep: Column, doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """(stats, label) of rows with a label 0 or 1 that ``keep`` (over doc_id)
    lets in; of several labels of an id the smallest counts."""
    one = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.min(label).cast("long").alias("label"))
    return stats.where(keep).join(one, "doc_id").select("stats", "label")


def score(stats: DataFrame, model: Discriminant | None, constant: float = 0.5) -> DataFrame:
    """``stats`` with a column score, the odds of label 1 as a share; without
    a model ``constant``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("stats")) if batch.num_rows else np.empty((0, len(STATISTICS)))
            odds = np.clip(model.log_odds(x), -500, 500) if model else np.zeros(len(x))
            value = 1 / (1 + np.exp(-odds)) if model else np.full(len(x), constant)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], [*batch.schema.names, "score"])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema.fields)
    return stats.mapInArrow(tidy(run), f"{names}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, keep: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(doc_id, score) of every row of ``docs``, learnt from the labelled rows
    that ``keep`` lets in.

    Null and empty texts have the statistics of "". Repeated rows get the same
    score each, rows with a null id are scored but never learnt from. Without
    labels of both classes every score is 0.5. Other columns are never
    read. An empty table gives no rows.
    """
    stats = stored(with_statistics(docs, doc_id, text), "statistics")
    return score(stats, fit(labelled(stats, labels, keep, label=label))).select("doc_id", "score")


def learnt(docs: DataFrame, labels: DataFrame, keep: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Discriminant | None:
    """The discriminant of the labelled rows of ``docs`` that ``keep`` lets in."""
    return fit(labelled(with_statistics(docs, doc_id, text), labels, keep, label=label))


def accepted(docs: DataFrame, model: Discriminant | None, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, with all
    their columns and in place: nothing is shuffled. Without a model all stay."""
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            odds = model.log_odds(np.array([statistics(t) for t in texts_of(batch, text)]))
            yield batch.filter(pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))) >= threshold))

    return docs.mapInArrow(tidy(run), docs.schema)
