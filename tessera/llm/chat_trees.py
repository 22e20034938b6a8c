"""Reply trees formatted as conversations.

Messages point to the message they answer. Iterative self-joins by pointer
doubling give every message its depth and the score of its branch, in as many
rounds as the depth has binary digits; each leaf ends a branch, the branches of a tree
are ranked by score, and the same pointers, taken from the longest to the
shortest, enumerate the messages of the branches chosen. Each becomes one text.

Template: ``[TURN role]text</s>`` and a line feed for each turn, with a
backslash before each of ``\\ [ ] <`` inside roles and texts, so no text can
hold a control string and the output can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored, tidy

OPEN, MID, CLOSE = "[TURN ", "]", "</s>\n"
SPAN = "array<struct<start:int,end:int>>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\\[\]<])", r"\\$1")


def branches(messages: DataFrame, best: int | None = None) -> DataFrame:
    """(tree, leaf, rank, score, place, node) for every message of the chosen
    branches; place counts from the root.

    ``messages`` has tree, node, parent and score; a tree's nodes are unique. A
    null parent, or one that is not there, makes a root; a null score counts
    0. Branches are ranked by total score, then length (longer first), then
    leaf; ``best`` keeps so many of each tree, None all. Messages on or under a
    cycle belong to no branch; rows with a null tree or node are left out.
    """
    own = messages.where("tree is not null and node is not null").select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    own = stored(own, "messages")
    there = own.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    state = own.join(there, ["tree", "parent"], "left")
    state = state.select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), F.lit(1).alias("steps"), F.col("score").alias("total"))
    # a tree of n messages has at most n on a path; what still points upward then, points into a cycle
    most = own.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    live = stored(state, "pointers-0")
    ended = [live.where("up is null")]
    pointers: list[DataFrame] = []
    live = live.where("up is not null")
    while (1 << len(pointers)) <= most and not live.isEmpty():
        pointers.append(live.select("tree", "node", "up"))
        # a message that has reached its root is looked up by others, but not joined again
        above = live
        for part in ended:
            above = above.unionByName(part)
        above = above.select("tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("total").alias("plus"))
        moved = live.join(above, ["tree", "up"]).select(
            "tree", "node", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("total") + F.col("plus")).alias("total")
        )
        moved = stored(moved, f"pointers-{len(pointers)}")
        ended.append(moved.where("up is null"))
        live = moved.where("up is not null")
    state = ended[0]
    for part in ended[1:]:
        state = state.unionByName(part)
    parents = own.select("tree", F.col("parent").alias("node")).distinct()
    leaves = state.join(parents, ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("steps"), "node")
    leaves = leaves.withColumn("rank", F.row_number().over(order))
    if best is not None:
        leaves = leaves.where(F.col("rank") <= best)
    paths = leaves.select("tree", F.col("node").alias("leaf"), "rank", F.col("total").alias("score"), (F.col("steps") - 1).alias("place"), "node")
    for k in reversed(range(len(pointers))):
        up = paths.join(pointers[k], ["tree", "node"]).withColumns({"node": F.col("up"), "place": F.col("place") - (1 << k)}).drop("up")
        paths = paths.unionByName(up)
        paths = stored(paths, f"paths-{k}")
    return paths


def formatted(turns: DataFrame, keys: list[str], role: str = "role", text: str = "text", place: str = "place", learn_from: str = "assistant") -> DataFrame:
    """(keys, formatted, loss_mask) of each group of turns: one text, and the
    (start, end) code points of the texts to learn from. Null roles and
    texts are empty. Turns of equal place are in order of role and text."""
    part = F.struct(F.col(place).alias("place"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = turns.groupBy(*keys).agg(F.array_sort(F.collect_list(part)).alias("t"))
    rows = rows.withColumn("t", F.transform("t", lambda x: F.struct((x["role"] == learn_from).alias("on"), F.concat(F.lit(OPEN), escaped(x["role"]), F.lit(MID)).alias("head"), escaped(x["text"]).alias("body"))))
    mask = F.aggregate(
        "t",
        F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["head"]) + F.length(x["body"]) + len(CLOSE)).alias("at"),
            F.when(
                x["on"], F.concat(a["out"], F.array(F.struct((a["at"] + F.length(x["head"])).alias("start"), (a["at"] + F.length(x["head"]) + F.length(x["body"])).alias("end"))))
            ).otherwise(a["out"]).alias("out"),
        ),
        lambda a: a["out"],
    )
    text_ = F.array_join(F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "")
    return rows.select(*keys, text_.alias("formatted"), mask.alias("loss_mask"))


def parsed(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted text."""
    plain = lambda s: re.sub(r"\\(.)", r"\1", s, flags=re.S)
    turn = re.compile(r"\[TURN ((?:[^\\\]]++|\\.)*+)\]((?:[^\\<]++|\\.)*+)</s>\n", re.S)
    return [(plain(m[1]), plain(m[2])) for m in turn.finditer(text)]


def digests(rows: DataFrame, key: str) -> DataFrame:
    """What is read back of formatted texts: (key, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars)."""
    narrow = rows.select(F.col(key).alias("key"), "formatted", F.transform("loss_mask", lambda s: s["start"]).alias("starts"), F.transform("loss_mask", lambda s: s["end"]).alias("ends"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("formatted", "starts", "ends"))):
                turns = parsed(text)
                whole = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(re.sub(r"\\(.)", r"\1", text[a:b], flags=re.S) for a, b in zip(starts, ends))
                out.append((len(turns), *(hashlib.sha256(x.encode("utf-8", "replace")).hexdigest() for x in (whole, loss)), len(loss), len(text)))
            n, turns_sha, loss_sha, loss_n, size = zip(*out) if out else [()] * 5
            cols = [pa.array(n, pa.int64()), pa.array(turns_sha, pa.string()), pa.array(loss_n, pa.int64()), pa.array(loss_sha, pa.string()), pa.array(size, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *cols], ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = narrow.schema["key"].dataType.simpleString()
    out = narrow.mapInArrow(tidy(run), f"key {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return out.withColumnRenamed("key", key)


def conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, formatted, loss_mask) of a table of turns.

    Each turn answers the one before it, so a conversation is a tree of one
    branch. Rows of equal turn, repeated ones too, follow each other in order of
    role and text; a null turn comes first, null roles and texts are empty, rows
    with a null conv_id are one conversation. Other columns are not read; no rows give no rows.
    """
    plain = rows.select(
        F.coalesce(F.col(conv_id).cast("string"), F.lit("")).alias("tree"), F.col(conv_id).alias("id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    plain = stored(plain.withColumn("node", F.row_number().over(order).cast("long")), "turns")
    messages = plain.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"))
    chosen = branches(messages, best=1).select("tree", "node", "place")
    whole = formatted(chosen.join(plain, ["tree", "node"]), ["tree", "id"])
    return whole.select(F.col("id").alias(conv_id), "formatted", "loss_mask")
