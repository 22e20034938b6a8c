"""Jaccard self-join of word shingle sets with several global token orders.

1. Every text becomes a set of hashed shingles. Tokens go, packed and dealt
   by hash, to buckets that find those which two sets or more hold; a set of
   which fewer than ``threshold`` are shared has no partner. Equal sets fall
   into one class, and the step is done once more over the classes left.
2. Of the rest, each global order (rarest first, then two by hash) has a
   prefix; a pair that reaches the threshold shares a prefix token under
   every order. Pairs come from the prefixes of the first order.
3. Not all pairs of a token's sets are made. In each star round a token's
   sets are compared with one pivot only, the set with the fewest tokens of its
   own, then the links merge components; at last, sets outside their token's
   largest component are compared with its sets of other components. A pair
   that is left out lies in one component already, so components are exact.
4. A pair is checked under the other orders, then by its whole sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import release, slices, stored, texts_of, tidy, unused
from tessera.llm.components import connected_components

#: Sets and tokens of a chunk, the unit in which tokens travel.
CHUNK_SETS, CHUNK_TOKENS = 65_000, 500_000
U = np.uint64


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the result."""
    with np.errstate(over="ignore"):
        x = x + U(0x9E3779B97F4A7C15) * U(seed + 1)
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers in as many bytes each as the largest needs."""
    values = np.ascontiguousarray(values, U)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(-1, data[0])
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, : data[0]] = raw
    return out.view(U).reshape(-1)


Row = tuple[int | None, int, np.ndarray, bytes]
Reader = Callable[[Iterator[pa.RecordBatch]], Iterator[Row]]


class _Words(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 100_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[Row]:
    """(doc_id, set size, 64-bit shingle hashes, digest of the set) of every row
    with columns doc_id and text. A-Z are lower-cased, words are what ASCII white space
    parts; fewer words than a shingle has count as one shingle."""
    hashes = _Words()
    with np.errstate(over="ignore"):
        for batch in slices(batches, "text", 1 << 20):
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
                w = np.array(list(map(hashes.__getitem__, text.encode("utf-8", "replace").lower().split())), U)
                k = min(words, len(w))
                x = np.full(max(0, len(w) - words) + 1 if k else 0, k, U)
                for i in range(k):
                    x = mix(x + w[i : i + len(x)], i)
                x = np.unique(x)
                yield doc, len(x), x, hashlib.blake2b(x.tobytes(), digest_size=16).digest()


def stored_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
    """The same of a table of classes with packed tokens: only a part of a set is
    left, so the class itself is the digest."""
    for batch in batches:
        for row, n, tokens in zip(*(batch.column(c).to_pylist() for c in ("row", "n", "tokens"))):
            yield row, n, unpack(tokens) << U(16), row.to_bytes(16, "big")


def _deal(read: Reader, buckets: int):
    """Rows (key = bucket, chunk, info, docs, tokens): for each chunk of sets
    its tokens by bucket, and in one bucket what is known of its sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        for ids, sizes, own, digests, sets in _chunks(read(batches)):
            lens = np.array([len(s) for s in sets], np.int64)
            tokens = (np.concatenate(sets) if sets else np.empty(0, U)) >> U(16)
            docs = np.repeat(np.arange(len(sets)).astype(U), lens)
            order = np.argsort(tokens, kind="stable")
            tokens, docs = tokens[order], docs[order]
            cuts = np.searchsorted(tokens, np.array([(b << 48) // buckets for b in range(buckets + 1)], U))
            info = pack(np.array([0 if i is None else i & (2**64 - 1) for i in ids], U)), pack(np.array([i is None for i in ids], U)), pack(np.array(sizes, U)), pack(np.array(own, U))
            rows = [(chunk % buckets, chunk, [*info, b"".join(digests)], None, None)]
            for b in np.flatnonzero(np.diff(cuts)):
                part = tokens[cuts[b] : cuts[b + 1]]
                rows.append((int(b), chunk, None, pack(docs[cuts[b] : cuts[b + 1]]), pack(np.diff(part, prepend=U(0)))))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.binary(), pa.binary()))], ["key", "chunk", "info", "docs", "tokens"])
            chunk += 1

    return run


def _chunks(sets) -> Iterator[tuple]:
    """Groups of rows: ids, sizes, the number of each row's set, and the
    distinct sets with their digests."""
    ids, sizes, own, digests, kept, number, held = [], [], [], [], [], {}, 0
    for i, n, tokens, digest in sets:
        if digest not in number:
            number[digest] = len(kept)
            kept.append(tokens)
            digests.append(digest)
            held += len(tokens)
        ids.append(i)
        sizes.append(n)
        own.append(number[digest])
        if held >= CHUNK_TOKENS or len(ids) >= CHUNK_SETS:
            yield ids, sizes, own, digests, kept
            ids, sizes, own, digests, kept, number, held = [], [], [], [], [], {}, 0
    if ids:
        yield ids, sizes, own, digests, kept


def _meet(group: pa.Table) -> pa.Table:
    """Of a bucket: the tokens that two sets or more hold, by chunk, and how many."""
    keys, infos, docs, tokens = (group.column(c).to_pylist() for c in ("chunk", "info", "docs", "tokens"))
    rows = [(k, i, None, None, None) for k, i in zip(keys, infos) if i is not None]
    at = [j for j, i in enumerate(infos) if i is None]
    if at:
        all_tokens = [np.cumsum(unpack(tokens[j]), dtype=U) for j in at]
        lens = np.array([len(t) for t in all_tokens], np.int64)
        flat = np.concatenate(all_tokens)
        order = np.argsort(flat, kind="stable")
        new = np.concatenate([[True], np.diff(flat[order]) != 0])
        count = np.diff(np.concatenate([np.flatnonzero(new), [len(flat)]]))
        times = np.empty(len(flat), np.int64)
        times[order] = np.repeat(count, count)
        for j, a, b in zip(at, np.cumsum(lens) - lens, np.cumsum(lens)):
            on = times[a:b] > 1
            if on.any():
                rows.append((keys[j], None, pack(unpack(docs[j])[on]), pack(np.diff(flat[a:b][on], prepend=U(0))), pack(times[a:b][on].astype(U))))
    cols = list(zip(*rows)) if rows else [()] * 5
    kinds = (pa.int64(), pa.list_(pa.binary()), pa.binary(), pa.binary(), pa.binary())
    release()
    return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], ["key", "info", "docs", "tokens", "counts"])


def _gather(num: int, den: int):
    """Of a chunk: a row for each of its rows; the first row of a set that may
    have a partner has the set's shared tokens in ascending order, and how
    many sets hold each."""

    def run(group: pa.Table) -> pa.Table:
        infos, docs, tokens, counts = (group.column(c).to_pylist() for c in ("info", "docs", "tokens", "counts"))
        chunk = group.column("key")[0].as_py()
        info = next(i for i in infos if i is not None)
        ids, none, sizes, own = (unpack(x) for x in info[:4])
        at = [j for j, i in enumerate(infos) if i is None]
        d = np.concatenate([np.empty(0, U), *(unpack(docs[j]) for j in at)])
        t = np.concatenate([np.empty(0, U), *(np.cumsum(unpack(tokens[j]), dtype=U) for j in at)])
        c = np.concatenate([np.empty(0, U), *(unpack(counts[j]) for j in at)])
        order = np.lexsort((t, d))
        t, c = t[order], c[order]
        cut = np.searchsorted(d[order], np.arange(len(info[4]) // 16 + 1).astype(U))
        first = np.zeros(len(own), bool)
        first[np.unique(own, return_index=True)[1]] = True
        rows = []
        for i, (doc, null, n, s, new) in enumerate(zip(ids.astype(np.int64).tolist(), none.tolist(), sizes.tolist(), own.tolist(), first.tolist())):
            a, b = int(cut[s]), int(cut[s + 1])
            new = new and n > 0 and den * (b - a) >= num * n
            rows.append(((chunk << 16) + i, None if null else doc, n, b - a, info[4][16 * s : 16 * s + 16], pack(t[a:b]) if new else None, pack(c[a:b]) if new else None))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        release()
        return pa.table([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["row", "id", "n", "shared", "digest", "tokens", "counts"])

    return run


def shared_tokens(source: DataFrame, read: Reader, num: int, den: int) -> DataFrame:
    """Stored rows (row, id, n, shared, digest, tokens, counts) of all sets.

    There are twice as many buckets as the source has partitions, so a bucket's
    tokens are about half of one partition's at any size of input. Tokens are
    kept only of sets that may have a partner: at least ``num / den`` of theirs are shared.
    """
    buckets = max(8, 2 * source.rdd.getNumPartitions())
    dealt = source.mapInArrow(tidy(_deal(read, buckets)), "key long, chunk long, info array<binary>, docs binary, tokens binary")
    met = dealt.groupBy("key").applyInArrow(_meet, "key long, info array<binary>, docs binary, tokens binary, counts binary")
    rows = met.groupBy("key").applyInArrow(_gather(num, den), "row long, id long, n long, shared long, digest binary, tokens binary, counts binary")
    return stored(rows, "shared-tokens")


def _prefixes(num: int, den: int):
    """Prefix tokens of every set under the three orders. A set's tokens of its
    own come first under each of them, so they only shorten what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, tokens, counts in zip(*(batch.column(c).to_pylist() for c in ("n", "tokens", "counts"))):
                t = unpack(tokens)
                k = len(t) + (-num * n) // den + 1  # shared - ceil(threshold * n) + 1
                rare = t[np.lexsort((mix(t, 1), unpack(counts)))[:k]]
                out.append((rare.astype(np.int64).tolist(), *(pack(np.sort(t[np.argsort(mix(t, s), kind="stable")[:k]])) for s in (2, 3))))
            cols = list(zip(*out)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("row", "n", "shared", "tokens")] + [pa.array(c, t) for c, t in zip(cols, (pa.list_(pa.int64()), pa.binary(), pa.binary()))], ["row", "n", "shared", "tokens", "first", "second", "third"])

    return run


def _verified(num: int, den: int):
    """Pairs that share prefix tokens under the other orders and reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            on = []
            for i in range(batch.num_rows):
                meets = all(len(np.intersect1d(unpack(get[f"a_{o}"][i]), unpack(get[f"b_{o}"][i]), True)) for o in ("second", "third"))
                if meets:
                    both = len(np.intersect1d(unpack(get["a_tokens"][i]), unpack(get["b_tokens"][i]), True))
                    meets = den * both >= num * (get["a_n"][i] + get["b_n"][i] - both)
                on.append(meets)
            yield batch.select(["a", "b"]).filter(pa.array(on, pa.bool_()))

    return run


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    threshold: tuple[int, int] = (80, 100),
    stars: int = 2,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Two rows link when den * intersection >= num * union of their sets of
    ``words``-word shingles, with ``threshold`` = (num, den). component_id is
    the smallest doc_id that links reach, the row's own included; null ids
    count only where no other is there. A text without words, null included,
    has no shingles and links with nothing. Repeated rows are in one component.
    Other columns are not read, an empty table gives no rows. ``docs``
    should be a stored table, as rows are named by partition and place.
    """
    num, den = threshold
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    every = shared_tokens(narrow, lambda batches: shingle_sets(batches, words), num, den)
    hopeful = every.where("tokens is not null")
    first = hopeful.groupBy("digest").agg(F.min("row").alias("row")).select("row")
    left = stored(hopeful.join(first, "row", "left_semi").select("row", "n", "tokens"), "classes")
    again = shared_tokens(left, stored_sets, num, den).where("tokens is not null")
    again = again.select(F.col("id").alias("row"), "n", "shared", "tokens", "counts")
    sets = again.mapInArrow(tidy(_prefixes(num, den)), "row long, n long, shared long, tokens binary, first array<long>, second binary, third binary")
    sets = stored(sets, "prefixes")
    links = _links(sets, num, den, stars)

    # row of a class -> digest -> component over the smallest doc_ids
    classes = every.groupBy("digest").agg(F.min("id").alias("least"))
    named = every.select("row", "digest").join(links, "row")
    named = named.join(classes, "digest").select("digest", "component", "least")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("digest", "component_id")
    out = every.select("id", "n", "digest").join(classes, "digest").join(named, "digest", "left")
    whole = F.when(F.col("n") > 0, F.coalesce("component_id", "least")).otherwise(F.col("id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), whole.alias("component_id"))


def _links(sets: DataFrame, num: int, den: int, stars: int) -> DataFrame:
    """(row, component) of every set that has a link."""
    spark = sets.sparkSession
    postings = sets.select(F.posexplode("first").alias("place", "token"), "row", "n", "shared")
    postings = postings.select("token", "row", "n", (F.col("shared") - F.col("place")).alias("rest"))
    many = postings.groupBy("token").count().where("count > 1").select("token")
    postings = stored(postings.join(many, "token"), "postings")
    none = spark.createDataFrame([], "row long, component long")
    component, tried = none, None
    for turn in range(stars + 1):
        now = postings.join(component, "row", "left").withColumn("component", F.coalesce("component", "row"))
        state = now.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
        now = stored(now.join(state.select("token"), "token", "left_semi"), f"open-{turn}")
        if now.isEmpty():
            break
        # at the first token that a pair shares, no more than the rest of either set can be shared
        fit = F.expr(f"{den + num} * least(rest, o_rest) >= {num} * (n + o_n)")
        own = F.struct(F.expr("(n - rest) / n").alias("own"), "row", "n", "rest")
        if turn < stars:
            if turn == 0:
                # the pivot: the set with the fewest tokens of its own
                pivot = now.groupBy("token").agg(F.min(F.struct(own.alias("best"), "component")).alias("p"))
            else:
                # such a set outside the largest component; the join is stored, so a token of very many components is split there
                by = now.groupBy("token", "component").agg(F.count("*").alias("size"), F.min(own).alias("best"))
                top = by.groupBy("token").agg(F.max(F.struct("size", "component")).alias("top"))
                by = stored(by.join(top, "token").select("token", "component", "best", F.expr("component = top.component").alias("largest")), f"pivots-{turn}")
                pivot = by.groupBy("token").agg(F.min(F.struct("largest", "best", "component")).alias("p"))
            pairs = now.join(pivot, "token").where("component <> p.component")
            pairs = pairs.select("row", "n", "rest", F.col("p.best.row").alias("o_row"), F.col("p.best.n").alias("o_n"), F.col("p.best.rest").alias("o_rest"))
        else:
            by = now.groupBy("token", "component").count()
            top = by.groupBy("token").agg(F.max(F.struct("count", "component")).alias("top"))
            state = now.join(top, "token").withColumn("outside", F.expr("component <> top.component")).drop("top")
            pairs = _banded(stored(state, "outside"), num, den)
        pairs = pairs.where(fit).select(F.least("row", "o_row").alias("a"), F.greatest("row", "o_row").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, f"pairs-{turn}")
        tried = pairs if tried is None else tried.unionByName(pairs)
        whole = pairs
        for side in ("a", "b"):
            whole = whole.join(sets.select(F.col("row").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in ("n", "tokens", "second", "third"))), side)
        found = stored(whole.mapInArrow(tidy(_verified(num, den)), "a long, b long"), f"links-{turn}")
        for side in ("a", "b"):
            c = component.select(F.col("row").alias(side), F.col("component").alias(f"{side}_c"))
            found = found.join(c, side, "left").withColumn(f"{side}_c", F.coalesce(f"{side}_c", side))
        merged = connected_components(found, "a_c", "b_c").withColumnRenamed("component", "now")
        ends = found.select(F.col("a_c").alias("row")).unionByName(found.select(F.col("b_c").alias("row"))).distinct()
        base = component.unionByName(ends.join(component, "row", "left_anti").select("row", F.col("row").alias("component")))
        base = base.join(merged, base["component"] == merged["node"], "left")
        component = stored(base.select("row", F.coalesce("now", "component").alias("component")), f"components-{turn}")
    return component


#: Sizes of a band differ by a fiftieth.
BAND = 1.02


def _banded(state: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of a token's sets of different components, one of them outside the token's largest component,
    of which the sizes allow the threshold.

    A set of n tokens, ``rest`` of which can still be shared, fits smaller sets of num/den * n tokens
    or more, up to ``most``. It asks the bands of sizes between, the smaller sets lie in one
    band each. So sets that a shared passage brings together, but whose sizes rule a link out, never
    meet: pages of one template, each too long for its passage, ask no band that holds any.
    """
    band = lambda n: F.floor(F.log(n) / F.log(F.lit(BAND))).cast("int")
    most = F.floor((F.lit(den + num) * F.col("rest") - num * F.col("n")) / num)
    least = F.ceil(F.lit(num) * F.col("n") / den)
    asks = state.where(most >= least).select("token", "row", "n", "rest", "component", "outside", F.explode(F.sequence(band(least), band(F.least("n", most)))).alias("band"))
    held = state.select("token", band(F.col("n")).alias("band"), *(F.col(c).alias(f"o_{c}") for c in ("row", "n", "rest", "component", "outside")))
    out = None
    for x, y in ((asks.where("outside"), held), (asks.where("NOT outside"), held.where("o_outside"))):
        met = x.join(y, ["token", "band"]).where("component <> o_component AND o_n <= n")
        out = met if out is None else out.unionByName(met)
    return out.select("row", "n", "rest", "o_row", "o_n", "o_rest")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with the first id of their component, with all
    their columns. Rows that share an id stay if one of them does."""
    found = near_duplicates(docs, doc_id, text, **options)
    (own,) = unused(docs, "id")
    kept = found.where("doc_id <=> component_id").select(F.col("doc_id").alias(own)).distinct()
    return docs.join(kept, docs[doc_id].cast("long").eqNullSafe(kept[own]), "left_semi")
