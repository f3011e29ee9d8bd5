"""The conversation trie against a plain one, in one shard and in many."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tillstream.llm import conversation_trie as trie
from tillstream.llm.ternary import TernaryTree, medians

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_nodes(sequences):
    """{conv_id: [(turn, words)]} to node rows."""
    nodes, ends = {}, {}
    for conv_id, sequence in sequences.items():
        for depth in range(len(sequence) + 1):
            nodes.setdefault(tuple(sequence[:depth]), []).append(conv_id)
        ends.setdefault(tuple(sequence), []).append(conv_id)
    out = []
    for node, members in nodes.items():
        children = [n for n in nodes if len(n) == len(node) + 1 and n[:len(node)] == node]
        below = [n for n in nodes if n[:len(node)] == node]
        leaves = [n for n in below if not any(len(m) > len(n) and m[:len(n)] == n for m in nodes)]
        saved = sum((len(nodes[n]) - 1) * n[-1][1] for n in below if n)
        listed = ",".join(map(str, sorted(ends.get(node, []))))
        out.append((min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members),
                    len(children), len(leaves), saved, hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out, key=str)


def brute(rows):
    convs = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [((r, t), len(t.split())) for _, _, r, t in sorted(own)] for c, own in convs.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    return brute_nodes(rebuilt)


def found(nodes):
    return sorted((tuple(r) for r in nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256").collect()), key=str)


def conversations(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def nodes_of(frame):
    return trie.prefix_trie(trie.rebuilt(trie.numbered(frame)))


def some_rows(seed, convs=60):
    rng = random.Random(seed)
    return [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["a", "b b", "c c c", ""]))
            for c in range(convs) for t in range(rng.randrange(1, 6))]


def test_median_insertion_is_balanced():
    tree = TernaryTree()
    for at in medians(1023):
        tree.path([at])
    assert sorted(medians(10)) == list(range(10))
    assert tree.height() == 10


@pytest.mark.parametrize("partitions", ["1", "4", "37"])
def test_shards_are_merged(spark, partitions):
    """However the sorted sequences are cut, the nodes at the cuts come out whole."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = some_rows(1)
        assert found(nodes_of(conversations(spark, rows))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_many_equal_conversations_and_a_long_one(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(40) for t in range(3)]
    rows += [(100, t, "user", f"turn {t % 7}") for t in range(200)]
    assert found(nodes_of(conversations(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    from pyspark.sql import functions as F

    rows = [(None, 1, "user", "x"), (20, None, None, None), (20, 1, "user", "hello there"),
            (21, 1, "user", ""), (22, 1, "", "user"), (23, 5, "user", "w " * 50_000),
            (24, 1, "user", "hello there"), (24, 1, "user", "hello there"), (-3, 1, "user", "minus"),
            (45, 0, "user", "without a base"), (46, 0, "user", "without a base")]
    frame = conversations(spark, rows)
    for name in ("i", "digest", "words", "part", "base", "shared", "ids", "key", "edge"):
        frame = frame.withColumn(name, F.lit("x"))
    # -3 belongs to the family of 0 or -20 as the remainder is taken; neither is there.
    assert found(nodes_of(frame)) == brute(rows)


def test_no_rows(spark):
    assert found(nodes_of(conversations(spark, []))) == []
