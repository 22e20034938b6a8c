"""Reply trees and their format against plain versions."""

import random
import re

import pytest

from tessera.llm import chat_trees

SCHEMA = "tree string, node long, parent long, score double, leaf string, rank int, place int"


def plain(messages, best):
    out = set()
    trees = {}
    for tree, node, parent, score in messages:
        if tree is not None and node is not None:
            trees.setdefault(tree, {})[node] = (parent, score or 0.0)
    for tree, nodes in trees.items():
        parents = {p for p, _ in nodes.values()}
        found = []
        for leaf in nodes:
            if leaf in parents:
                continue
            path, at = [], leaf
            while at in nodes and at not in path:
                path.append(at)
                at = nodes[at][0]
            if at in path:
                continue
            found.append((-sum(nodes[n][1] for n in path), -len(path), leaf, path[::-1]))
        for rank, (score, _, leaf, path) in enumerate(sorted(found)[:best], 1):
            out |= {(tree, leaf, rank, -score, place, node) for place, node in enumerate(path)}
    return out


@pytest.mark.parametrize("best", [None, 1, 3])
def test_branches(spark, best):
    r = random.Random(best or 0)
    rows = []
    for t in range(12):
        for n in range(r.randint(1, 40)):
            parent = None if n == 0 or r.random() < 0.05 else r.randrange(max(0, n - 4), n)
            rows.append((f"t{t}", n, parent, r.choice([None, 0.0, 1.0, 2.5, -1.0])))
    rows += [("chain", i, i - 1 if i else None, 1.0) for i in range(70)]
    rows += [("loop", 1, 2, 1.0), ("loop", 2, 1, 1.0), ("loop", 3, 2, 1.0), ("loop", 4, None, 1.0), ("lost", 1, 99, 1.0), (None, 1, None, 1.0), ("t0", None, 0, 9.0)]
    messages = spark.createDataFrame([(*x, "l", 1, 2) for x in rows], SCHEMA)
    out = chat_trees.branches(messages, best).collect()
    assert {(x["tree"], x["leaf"], x["rank"], x["score"], x["place"], x["node"]) for x in out} == plain(rows, best)


def test_format_reads_back(spark):
    r = random.Random(3)
    bits = ["[TURN user]", "</s>\n", "\\", "[", "]", "<", "</s>", "\\]", "é🙂", "\n", "plain text ", "[INST]", "\\\\["]
    rows = []
    for c in range(60):
        for t in range(r.randint(1, 6)):
            rows.append((c, t, r.choice(["user", "assistant", "system", None, "odd]role", "a\nb"]), r.choice([None, "".join(r.choice(bits) for _ in range(r.randint(0, 9)))])))
    rows += [(100, 0, "user", "same"), (100, 0, "user", "same"), (100, None, "system", "first"), (None, 0, "user", "no id"), (101, 0, "assistant", "x" * 200_000 + "[" * 1000)]
    turns = spark.createDataFrame([(*x, 1, 2, "t", "p") for x in rows], "conv_id long, turn long, role string, text string, node long, tree long, formatted string, place string")
    out = chat_trees.conversations(turns).collect()
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert {x["conv_id"] for x in out} == set(want)
    for x in out:
        own = [(role, text) for _, _, role, text in sorted(want[x["conv_id"]])]
        assert chat_trees.parsed(x["formatted"]) == own
        masked = [re.sub(r"\\(.)", r"\1", x["formatted"][s["start"] : s["end"]], flags=re.S) for s in x["loss_mask"]]
        assert masked == [text for role, text in own if role == "assistant"]
    assert chat_trees.digests(chat_trees.conversations(turns), "conv_id").count() == len(want)


def test_no_conversations(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_trees.digests(chat_trees.conversations(turns), "conv_id").count() == 0
