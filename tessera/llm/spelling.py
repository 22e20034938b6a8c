"""Spelling variants by a dictionary of trie-node pairs.

The nodes of the trie of all words (distinct beginnings) and of the trie of
all reversed words (distinct ends) get integer numbers. A word cut after
its i-th code point is a pair (prefix node, suffix node); with the code point after
the cut skipped it is another. Two words that differ by

* one replaced code point have the same skipping pair at its place,
* one inserted code point have one pair in common: skipping in the longer
  word, not skipping in the shorter one.

A pair of numbers fixes both strings, so words that meet are neighbours and need no
check. In a run of equal code points, any of which can be skipped, only the last
counts, so two words meet once. No pairs of words are made: in a window over
one pair of nodes each word takes the count and the best of the others from running values.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import slices, stored, texts_of, tidy
from tessera.llm.ordering import numbered

#: Latin letters as Latin-1 bytes, after A-Z were lower-cased.
LETTERS = rb"[a-z\xc0-\xff]+"
#: Words counted in a task before it hands its counts on; label rows of a batch.
MAX_COUNTED, LABEL_ROWS = 200_000, 50_000
#: Nodes up to this depth are numbered by their code points (21 bits each), deeper ones by rank;
#: labels deeper than PLAIN code points are chained digests.
SHALLOW, PLAIN = 3, 24


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", damage: int | None = None, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n) of the runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF) in all texts,
    A-Z lower-cased, of ``min_length`` code points and ``min_count`` occurrences or more.

    With ``damage``, a run for which it divides h = crc32 of ``<doc_id>:<run>``
    loses its code point h % length first (a null id is an empty text). Null
    texts have no runs. Counts are summed up in each task before they are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, total = re.compile(LETTERS).findall, Counter()

        def flush() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in slices(batches, "text", 1 << 20):
            for doc, t in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
                # what Latin-1 lacks becomes a question mark; bytes are lower-cased as ASCII
                counts = Counter(find(t.encode("latin-1", "replace").lower()))
                if damage:
                    start = zlib.crc32(b"%s:" % (b"" if doc is None else b"%d" % doc))
                    for w, n in counts.items():
                        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                        if h % damage == 0:
                            w = w[: h % len(w)] + w[h % len(w) + 1 :]
                        if len(w) >= min_length:
                            total[w] += n
                else:
                    for w, n in counts.items():
                        if len(w) >= min_length:
                            total[w] += n
                if len(total) >= MAX_COUNTED:
                    yield flush()
        yield flush()

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = narrow.mapInArrow(tidy(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


def _node_labels(letters: list[str]) -> list[tuple[int | None, bytes | None]]:
    """(number, None) or (None, label) of the nodes on the way through a trie, the root first."""
    out: list[tuple[int | None, bytes | None]] = [(-1, None)]
    number, label = 0, b""
    for i, c in enumerate(letters):
        label = label + c.encode("utf-8", "surrogatepass") if i < PLAIN else b"\0" + hashlib.blake2b(label + c.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if i < SHALLOW:
            number = (number << 21) + ord(c) + 1
            out.append((-1 - number, None))
        else:
            out.append((None, label))
    return out


#: Kinds of a pair: the whole word cut in two, or with a code point skipped that does or doesn't count.
WHOLE, SKIPPED, REPEATED = range(3)


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of every word: the nodes' numbers, or labels that are yet to be numbered."""
    names = ["rank", "kind", "p", "head", "s", "tail"]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary())
    rows: list[tuple] = []

    def made() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
        rows.clear()
        return out

    for batch in batches:
        for rank, word in zip(batch.column("rank").to_pylist(), batch.column("word").to_pylist()):
            letters = list(word)
            heads, tails = _node_labels(letters), _node_labels(letters[::-1])[::-1]
            for i, head in enumerate(heads):
                rows.append((rank, WHOLE, *head, *tails[i]))
                if i < len(letters):
                    same = i + 1 < len(letters) and letters[i] == letters[i + 1]
                    rows.append((rank, REPEATED if same else SKIPPED, *head, *tails[i + 1]))
                if len(rows) >= LABEL_ROWS:
                    yield made()
    if rows:
        yield made()


def _with_numbers(cuts: DataFrame, label: str, number: str) -> DataFrame:
    """Labels replaced by the rank of the node among all labelled ones of its trie."""
    labelled = cuts.where(F.col(label).isNotNull())
    nodes = numbered(labelled.select(label).distinct(), label, name="__node", tag=f"trie-{label}")
    found = labelled.join(nodes, label).withColumn(number, F.col("__node")).drop("__node")
    return cuts.where(F.col(label).isNull()).unionByName(found).drop(label)


def neighbours(words: DataFrame) -> DataFrame:
    """(rank, n_near, best) of the words (rank, word) that have a near one: how many, and the least rank among them."""
    cuts = stored(words.select("rank", "word").mapInArrow(tidy(_cuts), "rank long, kind int, p long, head binary, s long, tail binary"), "cuts")
    keys = _with_numbers(_with_numbers(cuts, "head", "p"), "tail", "s")
    skipped = F.when(F.col("kind") != WHOLE, F.col("rank"))
    counted = F.when(F.col("kind") == SKIPPED, F.col("rank"))
    pair = Window.partitionBy("p", "s")
    seen = keys.select(
        "rank", "kind",
        F.max(F.when(F.col("kind") == WHOLE, F.col("rank"))).over(pair).alias("whole"),
        F.count(skipped).over(pair).alias("n_skipped"), F.min(skipped).over(pair).alias("first"),
        F.count(counted).over(pair).alias("n_counted"), F.min(counted).over(pair).alias("first_counted"),
        F.lead("rank").over(pair.orderBy(F.col("kind") == WHOLE, "rank")).alias("following"),
    )
    whole = F.when(F.col("kind") == SKIPPED, F.col("whole"))
    other = F.when(F.col("rank") != F.col("first"), F.col("first")).when(F.col("n_skipped") > 1, F.col("following"))
    met = seen.select(
        "rank",
        F.when(F.col("kind") == WHOLE, F.col("n_counted")).otherwise(F.col("n_skipped") - 1 + whole.isNotNull().cast("long")).alias("n_near"),
        F.when(F.col("kind") == WHOLE, F.col("first_counted")).otherwise(F.least(other, whole)).alias("best"),
    )
    return met.where("n_near > 0").groupBy("rank").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _last(links: DataFrame) -> DataFrame:
    """(rank, root): where the links (rank, up) lead in the end, by doubling."""
    now = links
    while True:
        onward = now.select(F.col("rank").alias("up"), F.col("up").alias("onward"))
        step = stored(now.join(onward, "up", "left"), "roots")
        now = step.select("rank", F.coalesce("onward", "up").alias("up"))
        if step.where("onward is not null").isEmpty():
            return now.withColumnRenamed("up", "root")


def spelling_forms(counts: DataFrame, factor: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``counts`` (word, n).

    Words are near that differ by exactly one inserted, deleted or replaced code point. The
    form is the near word of largest n, of equal ones the first in code-point order, if its n is
    ``factor`` (more than 1) times the word's or more; else null. The root is where forms lead
    in the end, the word itself without one. Words are distinct; null words are left out. Counts
    grow along the forms, so they form no circles. An empty table gives no rows.
    """
    known = counts.where("word is not null").select("word", "n")
    words = numbered(known, F.desc("n"), F.asc("word"), name="rank", tag="ranked-words")
    near = neighbours(words)
    best = words.select(F.col("rank").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    near = near.join(best, "best").join(words.select("rank", "n"), "rank")
    holds = F.col("form_n") >= factor * F.col("n")
    near = near.select("rank", "n_near", *(F.when(holds, F.col(c)).alias(c) for c in ("best", "form", "form_n")))
    near = stored(near, "near-words")
    roots = _last(near.where("best is not null").select("rank", F.col("best").alias("up")))
    named = roots.join(words.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root").select("rank", "root_word")
    out = words.join(near, "rank", "left").join(named, "rank", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
