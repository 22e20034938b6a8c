"""Cumulative-link ordinal regression of severity over sparse word features.

P(grade <= k) = logistic(threshold_k - w·x): one weight vector for all
thresholds, which are in ascending order. The labels say only whether a text is
toxic, so grades for learning are made of them: 0 for the others; toxic ones
get 1, 2 or 3 by thirds of how much of the words that mark toxic texts they
hold. The result is the expected grade, and P(grade >= 1).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices, texts_of, tidy

#: Hash space of words, and after it that of their beginnings; most labelled rows to learn from, most terms with a weight.
WORDS, MAX_FIT_ROWS, MAX_TERMS = 1 << 19, 20_000, 8_000
SPACE = 2 * WORDS
GRADES, PREFIX = 3, 4
#: Characters cut from the ends of a word (fixed values).
EDGES = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»“”‘’„…–—¡¿"


class _Terms(dict):
    """White-space word -> its term and that of its beginning (``2 * WORDS``
    stands for none), from its lower-case form without edges."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        bare = word.strip(EDGES)
        h = xxhash.xxh3_64_intdigest(bare.encode("utf-8", "replace")) % WORDS if bare else SPACE
        start = WORDS + xxhash.xxh3_64_intdigest(bare[:PREFIX].encode("utf-8", "replace")) % WORDS if len(bare) > PREFIX else SPACE
        self[word] = both = h << 32 | start
        return both


def _counts(terms: _Terms, text: str) -> tuple[np.ndarray, np.ndarray]:
    x = np.array(list(map(terms.__getitem__, text.lower().split())), np.int64)
    x = np.concatenate([x >> 32, x & 0xFFFFFFFF])
    return np.unique(x[x < SPACE], return_counts=True)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    terms = _Terms()
    for batch in slices(batches, "text"):
        rows = [_counts(terms, t) for t in texts_of(batch, "text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array([i.astype("<i4").tobytes() for i, _ in rows], pa.binary()), pa.array([c.astype("<i4").tobytes() for _, c in rows], pa.binary())],
            ["label", "terms", "counts"],
        )


@dataclass
class Ordinal:
    """Terms in ascending order with their weights, and the thresholds."""

    terms: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, value: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. GRADES, a row for each value of w·x."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - value[:, None], -500, 500)))


def _grades(toxic: np.ndarray, rows: np.ndarray, terms: np.ndarray, x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Grade of each row, and the association of each term with toxic rows (z score of log odds)."""
    a = np.bincount(terms, toxic[rows], size) + 0.5
    b = np.bincount(terms, 1 - toxic[rows], size) + 0.5
    na, nb = toxic.sum() + 1, (1 - toxic).sum() + 1
    z = (np.log(a / (na - a + 0.5)) - np.log(b / (nb - b + 0.5))) / np.sqrt(1 / a + 1 / b)
    held = np.bincount(rows, x * (z[terms] > 4), len(toxic))
    grade = np.zeros(len(toxic), np.int64)
    on = toxic == 1
    if on.any():
        cuts = np.quantile(held[on], np.arange(1, GRADES) / GRADES)
        grade[on] = 1 + (held[on, None] > cuts[None, :]).sum(axis=1)
    return grade, z


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], rounds: int = 300, ridge: float = 1e-4, max_terms: int | None = MAX_TERMS) -> Ordinal | None:
    """The model of (toxic, terms, counts) rows, by gradient steps (Adam) on
    the mean log-likelihood; None unless toxic and other rows are there.

    Of the terms that two rows or more hold, the ``max_terms`` with the
    strongest association get a weight; None gives all of them one."""
    toxic = np.array([r[0] for r in rows], np.float64)
    if not rows or toxic.min() == toxic.max():
        return None
    lens = np.array([len(r[1]) for r in rows])
    row = np.repeat(np.arange(len(rows)), lens)
    term = np.concatenate([r[1] for r in rows]).astype(np.int64)
    x = 1 + np.log(np.concatenate([r[2] for r in rows]))
    grade, z = _grades(toxic, row, term, x, SPACE)
    seen = np.flatnonzero(np.bincount(term, minlength=SPACE) > 1)
    picked = np.sort(seen[np.argsort(-np.abs(z[seen]), kind="stable")[:max_terms]])
    at = np.minimum(np.searchsorted(picked, term), max(0, len(picked) - 1))
    on = picked[at] == term if len(picked) else np.zeros(len(term), bool)
    row, at, x = row[on], at[on], x[on]
    n = len(rows)
    p = np.concatenate([np.zeros(len(picked)), [0.0], np.zeros(GRADES - 1)])  # weights, first threshold, log steps
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, rounds + 1):
        w, steps = p[: len(picked)], np.exp(p[len(picked) + 1 :])
        theta = p[len(picked)] + np.concatenate([[0], np.cumsum(steps)])
        value = np.bincount(row, w[at] * x, n)
        low = 1 / (1 + np.exp(np.clip(value[:, None] - theta[None, :], -500, 500)))  # P(grade <= k)
        edge = np.concatenate([np.zeros((n, 1)), low, np.ones((n, 1))], axis=1)
        slope = np.concatenate([np.zeros((n, 1)), low * (1 - low), np.zeros((n, 1))], axis=1)
        i = np.arange(n)
        own = np.maximum(edge[i, grade + 1] - edge[i, grade], 1e-12)
        up, down = slope[i, grade + 1] / own, slope[i, grade] / own
        g_theta = np.array([-(up[grade == k].sum() - down[grade == k + 1].sum()) for k in range(GRADES)]) / n
        g_w = np.bincount(at, ((up - down)[row]) * x, len(picked)) / n + ridge * w
        g = np.concatenate([g_w, [g_theta.sum()], [g_theta[k + 1 :].sum() * steps[k] for k in range(GRADES - 1)]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    theta = p[len(picked)] + np.concatenate([[0], np.cumsum(np.exp(p[len(picked) + 1 :]))])
    return Ordinal(picked, p[: len(picked)], theta)


def learn(docs: DataFrame, labels: DataFrame, keep: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = MAX_FIT_ROWS, max_terms: int | None = MAX_TERMS) -> Ordinal | None:
    """Fit on at most ``max_rows`` labelled rows that ``keep`` (over doc_id)
    lets in: those with the smallest hash of their id, so the pick does
    not depend on order. Their ids, at most ``max_rows``, are broadcast; of
    rows that repeat an id the least text counts, once."""
    one = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.max(label).cast("long").alias("label"))
    one = one.where(keep).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(one), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    found = rows.mapInArrow(tidy(_features), "label long, terms binary, counts binary").toArrow()
    read = lambda c: [np.frombuffer(b, "<i4") for b in found.column(c).to_pylist()]
    return fit(list(zip(found.column("label").to_pylist(), read("terms"), read("counts"))), max_terms=max_terms)


def severity(docs: DataFrame, model: Ordinal | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, expected_severity, grade) of every row.

    score is P(grade >= 1), grade the likeliest grade (the lowest of equals).
    Whole texts are read; a null or empty one has no features and gets what the
    thresholds give. Without a model all are 0. Repeated rows get a row
    each; other columns are not read; an empty table gives no rows.
    """
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _Terms()
        table = np.zeros(SPACE)
        if model:
            table[model.terms] = model.weights
        for batch in slices(batches, "text"):
            value = np.array([float((table[i] * (1 + np.log(c))).sum()) for i, c in (_counts(terms, t) for t in texts_of(batch, "text"))])
            above = model.above(value) if model else np.zeros((len(value), GRADES))
            each = -np.diff(np.concatenate([np.ones((len(value), 1)), above, np.zeros((len(value), 1))], axis=1), axis=1)
            cols = [batch.column("doc_id"), pa.array(above[:, 0]), pa.array(above.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "score", "expected_severity", "grade"])

    return narrow.mapInArrow(tidy(run), "doc_id long, score double, expected_severity double, grade int")
