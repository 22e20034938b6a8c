"""Quality rules over lines: a linear-chain CRF marks content and boilerplate.

The base rules count repeated words, lines and symbols and fail texts with
fixed limits. In all texts every line with a word gets features, and Viterbi
decoding of a linear-chain conditional random field with two labels marks it as
content or boilerplate; the share of words in content lines decides.

Only texts are labelled, so the labels of training lines are hidden. At first the lines of
good texts count as content and those of bad ones as boilerplate, and line weights
alone are learnt. Then, in turns, every training line gets the label that its own features ask for, where
leaving its text's label costs ``trust``, and the weights are learnt anew. So a line of a good text that
looks like those of bad texts becomes boilerplate and prose in a bad text content. The last
turn learns the whole field by maximum likelihood, so its transitions know where labels change.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices, stored, texts_of, tidy

#: Fixed values of the base rules.
SYMBOLS, LEAST_WORDS, WINDOW, REPEAT_PERCENT = b"#*$%&|<>", 20, 8, 30
#: Most labelled texts to learn from, most training chains, and lines of a chain: longer texts give several.
MAX_FIT_ROWS, MAX_FIT_CHAINS, CHAIN = 4_000, 8_000, 64
FEATURES = 14


class _Numbers(dict):
    """Word -> a fixed random 64-bit number."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def repeated_words(numbers: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    n = len(numbers) - window + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        x = np.zeros(n, np.uint64)
        for i in range(window):
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + numbers[i : i + n]
    order = np.argsort(x, kind="stable")
    same = np.diff(x[order]) == 0
    twice = np.zeros(n, bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    cover = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def line_features(lines: list[bytes], words: list[list[bytes]]) -> np.ndarray:
    """A row of features for each line (all have a word)."""
    out = np.zeros((len(lines), FEATURES))
    seen: set[bytes] = set()
    for i, (line, w) in enumerate(zip(lines, words)):
        n, size = len(w), max(1, len(line))
        count = np.bincount(np.frombuffer(line, np.uint8), minlength=128)
        upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
        symbols = int(count[list(SYMBOLS)].sum())
        out[i] = (
            1.0,
            min(n, 50) / 50,
            n <= 3,
            line.rstrip()[-1] in b".!?:;\"'",
            upper / max(1, upper + lower),
            min(1.0, symbols / n),
            int(count[33] > n / 2),
            int(count[48:58].sum()) / size,
            1 - len(set(w)) / n,
            sum(a == b for a, b in zip(w, w[1:])) / n,
            sum(len(x) <= 3 for x in w) / n,
            min(1.0, (size - n) / n / 12),
            line in seen,
            int(count[44] + count[46]) / n,
        )
        seen.add(line)
    return out


@dataclass
class Field:
    """Emission weights (2 x FEATURES) and transition weights (2 x 2)."""

    emit: np.ndarray
    move: np.ndarray

    def viterbi(self, x: np.ndarray) -> np.ndarray:
        """The likeliest labels of a chain, 1 for content; of equals label 1."""
        s = x @ self.emit.T
        best, back = s[0], np.zeros((len(s), 2), np.int64)
        for t in range(1, len(s)):
            come = best[:, None] + self.move
            back[t] = 1 - np.argmax(come[::-1], axis=0)
            best = come[back[t], (0, 1)] + s[t]
        label = np.zeros(len(s), np.int64)
        label[-1] = int(best[1] >= best[0])
        for t in range(len(s) - 1, 0, -1):
            label[t - 1] = back[t, label[t]]
        return label


def likeliest(chains: list[np.ndarray], labels: list[np.ndarray], weight: np.ndarray, start: Field | None = None, rounds: int = 150, ridge: float = 1e-3) -> Field:
    """The field of maximum likelihood for chains with a label for each line, by gradient
    steps (Adam) from ``start``. ``weight``: of a line of each chain."""
    order = sorted(range(len(chains)), key=lambda i: -len(chains[i]))
    longest, k = len(chains[order[0]]), len(chains)
    x = np.zeros((k, longest, FEATURES))
    want = np.zeros((k, longest, 2))
    on = np.zeros((k, longest), bool)
    for i, j in enumerate(order):
        n = len(chains[j])
        x[i, :n], on[i, :n] = chains[j], True
        want[i, np.arange(n), labels[j]] = 1
    weight = weight[order]
    g_want = np.einsum("ktl,ktf,k->lf", want, x, weight)
    m_want = np.einsum("kta,ktb,k->ab", want[:, :-1], want[:, 1:], weight)
    p = np.concatenate([start.emit.ravel(), start.move.ravel()]) if start else np.zeros(2 * FEATURES + 4)
    m, v = np.zeros_like(p), np.zeros_like(p)
    live = on.sum(axis=0)  # chains are in descending length, so the first ones are alive
    last = on.sum(axis=1) - 1
    for t in range(1, rounds + 1):
        emit, move = p[: 2 * FEATURES].reshape(2, FEATURES), p[2 * FEATURES :].reshape(2, 2)
        s = x @ emit.T
        ahead, back = np.zeros((k, longest, 2)), np.zeros((k, longest, 2))
        ahead[:, 0] = s[:, 0]
        for j in range(1, longest):
            a = live[j]
            ahead[:a, j] = np.logaddexp(ahead[:a, j - 1, :1] + move[0], ahead[:a, j - 1, 1:] + move[1]) + s[:a, j]
        for j in range(longest - 2, -1, -1):
            a = live[j + 1]
            nxt = back[:a, j + 1] + s[:a, j + 1]
            back[:a, j] = np.logaddexp(move[:, 0] + nxt[:, :1], move[:, 1] + nxt[:, 1:])
        z = np.logaddexp(*ahead[np.arange(k), last].T)
        own = np.exp(np.minimum(ahead + back - z[:, None, None], 0)) * on[:, :, None]
        g_emit = np.einsum("ktl,ktf,k->lf", own, x, weight) - g_want
        pair = ahead[:, :-1, :, None] + move + (s + back)[:, 1:, None, :] - z[:, None, None, None]
        pair = np.exp(np.minimum(pair, 0)) * on[:, 1:, None, None]
        g_move = np.einsum("ktab,k->ab", pair, weight) - m_want
        g = np.concatenate([g_emit.ravel(), g_move.ravel()]) + ridge * p
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Field(p[: 2 * FEATURES].reshape(2, FEATURES), p[2 * FEATURES :].reshape(2, 2))


def line_weights(x: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 12) -> Field:
    """The likeliest field without transitions, where lines are independent: Newton's steps of a logistic regression."""
    b = np.zeros(FEATURES)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ b)))
        slope = x.T @ (weight * (p - label)) + ridge / 2 * b
        b = b - np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge / 2 * np.eye(FEATURES), slope)
    return Field(np.array([-b / 2, b / 2]), np.zeros((2, 2)))


def fit(chains: list[tuple[int, np.ndarray]], sweeps: int = 4, trust: float = 1.0) -> Field | None:
    """The field of chains of which only the text's label is known: hidden line labels and
    line weights in turns, ``sweeps`` times, then all weights. None unless both labels are there."""
    if len({y for y, _ in chains}) < 2:
        return None
    y, x = np.array([c[0] for c in chains]), [c[1] for c in chains]
    sizes = np.array([len(rows) for rows in x])
    # both labels weigh the same, whatever their numbers of lines
    weight = np.where(y == 1, 0.5 / sizes[y == 1].sum(), 0.5 / sizes[y == 0].sum())
    lines, text, each = np.concatenate(x), np.repeat(y, sizes), np.repeat(weight, sizes)
    label = text
    field = line_weights(lines, label, each)
    for _ in range(sweeps):
        # by the line alone: transitions would draw each line to its text's label again
        label = (lines @ (field.emit[1] - field.emit[0]) + np.where(text == 1, trust, -trust) >= 0).astype(np.int64)
        field = line_weights(lines, label, each)
    return likeliest(x, np.split(label, np.cumsum(sizes)[:-1]), weight, field, rounds=75)


def _lines(raw: bytes) -> tuple[list[bytes], list[list[bytes]]]:
    both = [(x, w) for x in raw.split(b"\n") if (w := x.split())]
    return [x for x, _ in both], [w for _, w in both]


def learn(docs: DataFrame, labels: DataFrame, keep: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_FIT_ROWS, max_chains: int = MAX_FIT_CHAINS) -> Field | None:
    """The field of at most ``max_rows`` labelled texts that ``keep`` (over
    doc_id) lets in, half of each label where there are as many: those with the
    smallest hash of their id. Their ids, at most ``max_rows``, are broadcast;
    of rows that repeat an id the least text counts, once. Whole texts give chains of
    CHAIN lines; at most ``max_chains`` of them, half of each label, come to the driver, again by
    smallest hash, for learning only."""
    one = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.min(label).cast("long").alias("label")).where(keep)
    pick = [one.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows // 2) for y in (0, 1)]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(pick[0].unionByName(pick[1])), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for i, y, t in zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), texts_of(batch, "text")):
                x = line_features(*_lines(t.encode("utf-8", "replace"))).astype("<f4")
                cuts = range(0, len(x), CHAIN)
                made = [x[a : a + CHAIN].tobytes() for a in cuts]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(([i] * len(made), [y] * len(made), list(cuts), made), kinds)], ["doc_id", "label", "line", "features"])

    made = stored(rows.mapInArrow(tidy(run), "doc_id long, label long, line long, features binary"), "chains")
    halves = [made.where(F.col("label") == y).orderBy(F.xxhash64("doc_id", "line"), "doc_id", "line").limit(max_chains // 2) for y in (0, 1)]
    found = halves[0].unionByName(halves[1]).select("label", "features").toArrow()
    chains = [(y, np.frombuffer(b, "<f4").reshape(-1, FEATURES).astype(np.float64)) for y, b in zip(found.column("label").to_pylist(), found.column("features").to_pylist())]
    # in a fixed order, so that a rerun learns the same weights
    return fit(sorted(chains, key=lambda c: (c[0], c[1].tobytes())))


def line_rules(docs: DataFrame, field: Field | None, doc_id: str = "doc_id", text: str = "text", least_share: float = 0.5) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, content_share) of every row.

    kept is false where the base rules fail, else true if content lines have
    at least ``least_share`` of the words (all without a field). The lines of
    texts that the base rules fail are marked too, for their share. A null text is
    empty: it has no words, so the base rules fail it, and its share is 0.
    Repeated rows get the same each; other columns are not read; an empty
    table gives no rows.
    """
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"]

    def one(raw: bytes, chars: int, numbers: _Numbers) -> tuple:
        words = raw.split()
        n = len(words)
        lines, by_line = _lines(raw)
        repeats = repeated_words(np.array(list(map(numbers.__getitem__, words)), np.uint64))
        failed = n < LEAST_WORDS or 100 * repeats > REPEAT_PERCENT * n
        share = 1.0 if n else 0.0
        if field and n:
            label = field.viterbi(line_features(lines, by_line))
            share = sum(len(w) for w, y in zip(by_line, label) if y) / n
        space = sum(raw.count(b) for b in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
        symbols = sum(raw.count(bytes([b])) for b in SYMBOLS)
        return n, chars - space, symbols, len(lines) - len(set(lines)), repeats, failed, not failed and share >= least_share, share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers()
        for batch in slices(batches, "text"):
            rows = [one(t.encode("utf-8", "replace"), len(t), numbers) for t in texts_of(batch, "text")]
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], ["doc_id", *names])

    return narrow.mapInArrow(tidy(run), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double")
