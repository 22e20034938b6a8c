"""Exact duplicates by deterministic block naming.

Each normalised text is cut into blocks of fixed size. The distinct blocks,
compared byte by byte in one aggregation and sorted by hash, get integer names;
then the names of adjacent blocks are paired and the distinct pairs sorted and named in
turn, until one name is left of each document. Two documents have the
same (level, name) exactly if their texts are the same. A name is the rank
in sorted order, whatever the partitions: key ranges are sorted
apart, and the counts of the ranges before are added.

Text is shuffled once, by the aggregation that names the blocks; it combines
copies on the map side, so a text that a third of all rows share leaves each
task once. Rows find their block's name through a 128-bit hash that the
aggregation has proved to be free of collisions; if it isn't, all is hashed
again with another salt.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WS, stored, unused
from tessera.llm.ordering import numbered, ranked

BLOCK = 4096


def normalised(text: str | Column) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    text = F.col(text) if isinstance(text, str) else text
    # a single space stays as it is, so only the other runs are replaced
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"[\x09-\x0D][{WS}]*|\x20[{WS}]+", " ")


def block_hash(salt: int, block: Column) -> Column:
    return F.struct(F.xxhash64(F.lit(salt), block).alias("a"), F.xxhash64(F.lit(salt + 1), block).alias("b"))


def _blocks(size: int) -> Column:
    count = F.greatest(F.lit(1), F.ceil(F.length("__bytes") / size)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(F.col("__bytes"), i * size + 1, F.lit(size)))


def ranks(distinct: DataFrame, *order: str) -> DataFrame:
    """Distinct rows with ``name``, their rank from 0 along ``order``."""
    sorted_ = numbered(distinct, *order, name="__number", tag="names")
    return ranked(sorted_.withColumn("__all", F.lit(0)), "__all", "__number").withColumnRenamed("pos", "name").drop("__all", "n")


def exact_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
    hashed: Callable[[int, Column], Column] = block_hash,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised forms are; null counts as empty. Of
    a group the smallest doc_id stays (a null doc_id comes last); of repeated
    rows with that id one row is kept. Other columns are not read. An empty
    table gives no rows.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.encode(normalised(text), "utf-8").alias("__bytes"))
    for salt in itertools.count(0, 2):
        split = base.select(F.explode(_blocks(block)).alias("block"))
        blocks = split.select(hashed(salt, F.col("block")).alias("h"), "block").distinct()
        hashes = stored(blocks.select("h"), "blocks")
        if hashes.groupBy("h").count().where("count > 1").isEmpty():
            break
    names = stored(ranks(hashes, "h"), "block-names")
    rows = base.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.unhex(F.sha2("__bytes", 256)).alias("sha"),
        F.transform(_blocks(block), lambda b: hashed(salt, b)).alias("hs"),
    )
    rows = stored(rows.withColumn("n", F.size("hs")), "rows")
    whole = rows.where("n = 1").select("row", "doc_id", "sha", F.col("hs")[0].alias("h")).join(names, "h")
    whole = whole.select("row", "doc_id", "sha", F.lit(0).alias("level"), "name")

    at = rows.where("n > 1").select("row", "n", F.posexplode("hs").alias("pos", "h")).join(names, "h").select("row", "n", "pos", "name")
    most = rows.agg(F.max("n")).first()[0] or 1
    level, ended = 0, []
    while most > 1:
        level, most = level + 1, (most + 1) // 2
        at = at.groupBy("row", F.shiftright("pos", 1).alias("pos")).agg(
            F.max("n").alias("n"), F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
        )
        at = stored(at, f"pairs-{level}")
        pairs = stored(ranks(at.select("left", "right").distinct(), "left", "right"), f"pair-names-{level}")
        at = at.join(pairs, ["left", "right"]).select("row", F.expr("(n + 1) div 2").cast("int").alias("n"), "pos", "name")
        ended.append(at.where("n = 1").select("row", F.lit(level).alias("level"), "name"))
        at = at.where("n > 1")
    for part in ended:
        whole = whole.unionByName(rows.where("n > 1").select("row", "doc_id", "sha").join(part, "row"))
    found = stored(whole, "identities")

    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    groups = found.groupBy("level", "name").agg(first, F.count("*").alias("group_size"))
    out = found.join(groups, ["level", "name"])
    return out.select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group.
    Of several rows with that id and text, the first by the other columns' JSON, then by the text."""
    id_, sha, own, n = unused(docs, "id", "sha", "own_sha", "n")
    kept = exact_groups(docs, doc_id, text, **options).where("kept").select(F.col("doc_id").alias(id_), F.col("text_sha256").alias(sha))
    marked = docs.withColumn(own, F.sha2(F.encode(normalised(text), "utf-8"), 256))
    joined = marked.join(kept, marked[own].eqNullSafe(kept[sha]) & marked[doc_id].cast("long").eqNullSafe(kept[id_]))
    others = [marked[c] for c in docs.columns if c != text]
    again = Window.partitionBy(sha, id_).orderBy(F.to_json(F.struct(*others)), marked[text])
    return joined.withColumn(n, F.row_number().over(again)).where(F.col(n) == 1).select(*(marked[c] for c in docs.columns))
