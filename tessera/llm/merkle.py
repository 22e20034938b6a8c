"""Merkle manifest of a dataset: a tree per group of rows, and one above the groups.

A level is a table (g, pos, n, hash): nodes of group ``g``, ``n`` in all, by place.
Every 16 consecutive nodes make a run. In one window over a run, columns
at fixed offsets (lag 1 to 15, lead 1 to 15), masked by the node's slot and the
run's length, give each node its siblings, left and right; the row in the first
slot hashes itself and what leads to the parent. A window holds 16 rows at most, so a
group with a third of all rows is spread over all tasks, and each level has
a sixteenth of the rows of the one below.

Proofs go the other way: each node's path is its own siblings and its parent's
path, joined on (group, run). So a leaf's row takes what the levels above share
from one row for its run, and texts never leave the scan: only digests are shuffled.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.llm.ordering import numbered, ranked

RUN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


class Manifest(NamedTuple):
    """Levels of the groups' trees, leaves first, and of the tree above them."""

    groups: list[DataFrame]
    top: list[DataFrame]


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def entry(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    """Hash of a row's fields; no two different rows have the same entries."""
    return digest(*map(entry, fields))


def _siblings(nodes: DataFrame) -> DataFrame:
    """Nodes with ``slot``, ``run`` and the digests to the left and right in their run."""
    x = nodes.selectExpr("*", f"pos % {RUN} AS slot", f"pos div {RUN} AS run", f"least({RUN}, n - pos div {RUN} * {RUN}) AS length")
    own = "OVER (PARTITION BY g, run ORDER BY pos)"
    lags = [f"CASE WHEN slot >= {k} THEN lag(hash, {k}) {own} END" for k in range(RUN - 1, 0, -1)]
    leads = [f"CASE WHEN slot + {k} < length THEN lead(hash, {k}) {own} END" for k in range(1, RUN)]
    return x.selectExpr("*", f"concat_ws('', {', '.join(lags)}) AS left", f"concat_ws('', {', '.join(leads)}) AS right")


def _levels(leaves: DataFrame, tag: str) -> list[DataFrame]:
    """The leaves and the levels above, until one node is left of each group."""
    most = leaves.agg(F.max("n")).first()[0] or 1
    levels = [leaves]
    while most > 1:
        most = -(-most // RUN)
        first = _siblings(levels[-1].where("n > 1").select("g", "pos", "n", "hash")).where("slot = 0")
        above = first.select("g", F.col("run").alias("pos"), F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n"), digest(F.col("hash"), F.col("right")).alias("hash"))
        levels.append(stored(above, f"{tag}-{len(levels)}"))
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    """(g, hash) of the node that is left of each group."""
    out = levels[0].where("n = 1").select("g", "hash")
    for level in levels[1:]:
        out = out.unionByName(level.where("n = 1").select("g", "hash"))
    return out


def _paths(levels: list[DataFrame], start: DataFrame) -> DataFrame:
    """The leaves with their ``path``: (left, right) per level, the lowest first.

    ``start`` has a row for each group: g, the path from the group's root on,
    and other columns, which every leaf takes over.
    """
    carried = [c for c in start.columns if c not in ("g", "path")]
    found = None
    for level in reversed(levels):
        own = [c for c in level.columns if c not in ("pos", "n", "g")]
        at = level.where("n = 1").join(start, "g").select("g", "pos", *own, "path", *carried)
        if found is not None:
            above = found.select("g", F.col("pos").alias("run"), F.col("path").alias("above"), *carried)
            inner = _siblings(level.where("n > 1")).join(above, ["g", "run"])
            path = F.concat(F.array(F.struct("left", "right")), "above").alias("path")
            at = at.unionByName(inner.select("g", "pos", *own, path, *carried))
        found = at
    return found


def manifest(rows: DataFrame, group: str, order: str, hashed: str, keep: tuple[str, ...] = ()) -> Manifest:
    """The trees over ``rows``, whose column ``hashed`` has the leaves' digests.

    Leaves of a group ascend by ``order`` (null first, then by digest); groups by
    UTF-8 bytes, null first, null being a group of its own. Columns ``keep`` stay with the leaves.
    Repeated rows are leaves of their own. An empty table gives empty levels.
    """
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # keeps the order, null first
    narrow = rows.select(g.alias("g"), F.col(order).alias("__order"), F.col(hashed).alias("hash"), *(F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)))
    narrow = stored(narrow, "merkle-leaves").withColumn("__row", F.monotonically_increasing_id())
    leaves = numbered(narrow, "g", "__order", "hash", "__row", name="number", tag="merkle-sorted").drop("__order", "__row")
    groups = _levels(ranked(leaves, "g", "number"), "merkle")
    roots = numbered(_roots(groups).withColumnRenamed("g", "name"), "name", name="number", tag="merkle-subroots")
    top = _levels(ranked(roots.withColumn("g", F.lit("")), "g", "number"), "merkle-top")
    return Manifest(groups, top)


def nodes(trees: Manifest) -> DataFrame:
    """The manifest as a table: tree (``group`` or ``top``), g, level, pos, hash.

    ``g`` is the group's value behind ``=``, or empty for null and in the top tree.
    """
    parts = [
        level.select(F.lit(tree).alias("tree"), "g", F.lit(i).alias("level"), "pos", "hash")
        for tree, levels in (("group", trees.groups), ("top", trees.top))
        for i, level in enumerate(levels)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def proofs(trees: Manifest, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each leaf: the columns kept, leaf, subroot, root and ``path``,
    the siblings (left, right) of each level up to the root."""
    root = _roots(trees.top).select("g", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("hash").alias("root"))
    start = _paths(trees.top, root).select(F.col("name").alias("g"), "path", "root", F.col("hash").alias("subroot"))
    out = _paths(trees.groups, stored(start, "merkle-subroot-paths"))
    return out.select(*(F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)), F.col("hash").alias("leaf"), "subroot", "root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, level: digest(level["left"], h, level["right"]))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), ""), 256)


def tamper_check(docs: DataFrame, tampered: Column, changed: Column, fields: tuple[str, ...] = FIELDS, group: str = "source", order: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: order, leaf, subroot, root, proof_sha256, folded_root, verified.

    Where ``tampered`` holds, the leaf is made again with ``changed`` in place of
    the text, and folded with the siblings of the manifest; ``verified`` says whether the
    root comes out. A null in ``tampered`` counts as false, null fields
    as null entries, a null group as a group. Other columns are not read.
    """
    other = [changed if c == text else F.col(c) for c in fields]
    rows = docs.select(
        F.col(group).alias("group"), F.col(order).alias("id"), leaf([F.col(c) for c in fields]).alias("leaf"),
        F.when(tampered, leaf(other)).alias("other"),
    )
    keep = ("id", "other")
    found = proofs(manifest(rows, "group", "id", "leaf", keep), keep)
    found = found.withColumns({"proof_sha256": proof_digest(F.col("path")), "folded_root": folded(F.coalesce("other", "leaf"), F.col("path"))})
    return found.select(F.col("id").alias(order), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
