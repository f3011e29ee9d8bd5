"""A trie of conversation prefixes, built as ternary search trees over shards of sorted sequences.

Turns (role, text) are encoded by a dictionary table. Every conversation becomes its sequence of turn
ids; sequences are range-partitioned and sorted, so equal ones and those with a common start are
neighbours. A task reads its shard once: equal sequences are folded as they come (the digest of their
conversations included), the distinct ones are put into a ternary search tree, medians first, and
members, children, leaves and savings are summed up from the last node to the first. Nodes on the
paths of a shard's first and last sequence, the root among them, may go on in a neighbouring shard:
of these a shard reports only its share. Shares are merged by node, and what lies below is summed over
the tree of these nodes in as many steps as its depth has binary digits.

Rows are ordered by turn, null first; rows with the same turn by the digest of role and text. Null
roles and texts count as empty, rows without conv_id are left out, extra columns are not looked at.
Repeated rows are turns of their own. An empty table has no nodes, not even a root. A task holds the
turn ids of the distinct sequences of its shard, and of a whole conversation, never the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstream.llm.common import WORD, crc32_sql, ship, table, word_count, written
from tillstream.llm.ternary import NONE, TernaryTree, medians

# Conversations that share their first turns, and how many turns they share at most.
FAMILY, MOST_SHARED = 20, 3
SHARD_TURNS = 500_000
NOTHING = hashlib.sha256(b"").hexdigest()

PART = pa.schema([
    ("edge", pa.bool_()), ("key", pa.binary()), ("parent_key", pa.binary()),
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("words", pa.int64()), ("ends_sha256", pa.string())])
PART_SQL = ("edge boolean, key binary, parent_key binary, conv_id long, depth long, "
            "parent_conv_id long, n_convs long, n_children long, n_leaves long, "
            "saved_tokens long, words long, ends_sha256 string")


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, i (from 0), turn_id, words of every row."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
                       .cast("binary"), 256)).alias("digest"),
        word_count(text).alias("words"))
    along = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    placed = written(turns.withColumn("i", F.row_number().over(along) - 1).drop("turn"), "turns")
    dictionary = written(placed.groupBy("digest").agg(F.max("words").alias("words")).withColumn(
        "turn_id", F.monotonically_increasing_id()), "turn-dictionary")
    return written(placed.drop("words").join(dictionary, "digest").drop("digest"), "turn-ids")


def shared_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string")) % (MOST_SHARED + 1)).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, ids and words: the sequences after the first turns are taken from the family's."""
    every = turns.select("conv_id").distinct().withColumns({
        "shared": shared_turns(F.col("conv_id")),
        "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("i") < MOST_SHARED)).select(
        F.col("conv_id").alias("base"), "i", "turn_id", "words")
    taken = every.join(heads, "base").filter("i < shared").select(
        "conv_id", F.lit(0).alias("part"), "i", "turn_id", "words")
    own = turns.filter(F.col("i") >= shared_turns(F.col("conv_id"))).select(
        "conv_id", F.lit(1).alias("part"), "i", "turn_id", "words")
    # Conversations without turns stay.
    none = every.select("conv_id", *[F.lit(None).cast("int").alias(c) for c in ("part", "i")],
                        *[F.lit(None).cast("long").alias(c) for c in ("turn_id", "words")])
    rows = taken.unionByName(own).unionByName(none).groupBy("conv_id").agg(F.sort_array(
        F.collect_list(F.when(F.col("part").isNotNull(), F.struct("part", "i", "turn_id", "words")))
    ).alias("turns"))
    return rows.select("conv_id", F.col("turns.turn_id").alias("ids"),
                       F.col("turns.words").alias("words"))


class _Shard:
    """The distinct sequences of a shard, in order, with what is known of their conversations."""

    def __init__(self):
        self.sequences: list[list[int]] = []
        self.words: list[list[int]] = []
        self.count: list[int] = []
        self.least: list[int] = []
        self.digests: list = []

    def read(self, conv_id: int, ids: list[int], words: list[int]) -> None:
        if self.sequences and self.sequences[-1] == ids:
            self.count[-1] += 1
            self.digests[-1].update(b",%d" % conv_id)
        else:
            if self.digests:
                self.digests[-1] = self.digests[-1].hexdigest()
            self.sequences.append(ids)
            self.words.append(words)
            self.count.append(1)
            self.least.append(conv_id)
            self.digests.append(hashlib.sha256(b"%d" % conv_id))

    def nodes(self) -> Iterator[tuple]:
        """Rows of PART."""
        self.digests[-1] = self.digests[-1].hexdigest()
        tree, paths = TernaryTree(), {}
        ends: dict[int, int] = {}
        size: list[int] = []
        last = len(self.sequences) - 1
        for at in medians(len(self.sequences)):
            path = tree.path(self.sequences[at])
            # New nodes end the path.
            size += self.words[at][len(path) - (len(tree.label) - len(size)):]
            ends[path[-1] if path else NONE] = at
            if at in (0, last):
                paths[at] = path
        edge = {NONE, *paths[0], *paths[last]}

        # The root comes last, where index -1 finds it.
        total = len(tree.label) + 1
        members, least = [0] * total, [None] * total
        children, leaves, saved = [0] * total, [0] * total, [0] * total
        for node in range(total - 2, NONE - 1, -1):
            end = ends.get(node)
            if end is not None:
                members[node] += self.count[end]
                if least[node] is None or self.least[end] < least[node]:
                    least[node] = self.least[end]
            if node not in edge:
                leaves[node] = leaves[node] or 1
                saved[node] += (members[node] - 1) * size[node]
            if node == NONE:
                break
            parent = tree.parent[node]
            members[parent] += members[node]
            if least[parent] is None or least[node] < least[parent]:
                least[parent] = least[node]
            if node not in edge:
                children[parent] += 1
                leaves[parent] += leaves[node]
                saved[parent] += saved[node]

        keys = {NONE: b""}
        for path in paths.values():
            above = NONE
            for node in path:
                keys[node] = hashlib.blake2b(
                    keys[above] + b"%d" % tree.label[node], digest_size=16).digest()
                above = node
        depth = [0] * total
        for node in range(total - 1):
            depth[node] = 1 if tree.parent[node] == NONE else depth[tree.parent[node]] + 1
        for node in range(NONE, total - 1):
            parent = tree.parent[node] if node != NONE else None
            inner = parent is not None and parent not in edge
            yield (node in edge, keys.get(node), keys.get(parent), least[node],
                   depth[node] if node != NONE else 0, least[parent] if inner else None,
                   members[node], children[node], leaves[node], saved[node],
                   size[node] if node != NONE else 0,
                   self.digests[ends[node]] if node in ends else None)


def _shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by sequence and conversation."""
    shard = _Shard()
    for batch in batches:
        for conv_id, ids, words in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            shard.read(conv_id, ids, words)
    if not shard.sequences:
        return
    rows = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PART, strict=True)],
            schema=PART)

    for row in shard.nodes():
        rows.append(row)
        if len(rows) == 20_000:
            yield batch_of(rows)
            rows = []
    if rows:
        yield batch_of(rows)


def _summed_below(nodes: DataFrame) -> DataFrame:
    """key, n_leaves, saved_tokens over the subtree, of (key, parent_key, n_leaves, saved_tokens).

    Before step k a node holds the sums of what is less than 2**k levels below, and `up` is the node
    2**k levels above.
    """
    held = nodes.select("key", F.col("parent_key").alias("up"), "n_leaves", "saved_tokens")
    while not held.filter("up IS NOT NULL").isEmpty():
        below = held.filter("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        above = held.select(F.col("key").alias("up"), F.col("up").alias("next_up"))
        held = written(held.join(below, "key", "left").join(above, "up", "left").select(
            "key", F.col("next_up").alias("up"),
            (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens")),
            "trie-sums")
    return held.drop("up")


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of (conv_id, ids, words): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = sequences.sparkSession
    ship(spark)
    stored = written(sequences, "sequences")
    turns = stored.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // shard_turns)
    parts = written(stored.repartitionByRange(shards, "ids").sortWithinPartitions("ids", "conv_id")
                    .mapInArrow(_shard_nodes, PART_SQL), "trie-parts")

    merged = parts.filter("edge").groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"), F.max("words").alias("words"),
        F.max("ends_sha256").alias("ends_sha256"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    below = merged.filter("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(
        F.count(F.lit(1)).alias("edge_children"))
    edges = written(merged.join(below, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("edge_children", F.lit(0))).withColumns({
            "n_leaves": F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")}),
        "trie-edges")
    summed = edges.drop("n_leaves", "saved_tokens").join(_summed_below(edges), "key")
    parents = edges.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("edge_conv_id"))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
             "saved_tokens", "ends_sha256"]
    inner = parts.filter("NOT edge")
    inside = inner.filter("parent_key IS NULL")
    hanging = inner.filter("parent_key IS NOT NULL").drop("parent_conv_id").unionByName(
        summed.drop("edge_children"), allowMissingColumns=True).join(
        parents, "parent_key", "left").withColumnRenamed("edge_conv_id", "parent_conv_id")
    return inside.select(*names).unionByName(hanging.select(*names)).withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(numbered(table(spark, sf_dir, "conversations"))))


OP12_SQL = rf"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS i,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS e,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % {FAMILY} AS base,
         {crc32_sql("conv_id::VARCHAR")} % {MOST_SHARED + 1} AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
parts AS (
  SELECT c.conv_id, 0 AS part, t.i, t.e, t.words FROM convs c
  JOIN turns t ON t.conv_id = c.base AND t.i < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.i, t.e, t.words FROM convs c
  JOIN turns t ON t.conv_id = c.conv_id AND t.i >= c.h),
prefixes AS (
  SELECT conv_id, row_number() OVER own AS depth, words,
         md5(array_to_string(list(e) OVER own, ',')) AS node
  FROM parts WINDOW own AS (PARTITION BY conv_id ORDER BY part, i)
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs),
linked AS (
  SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
         depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM prefixes),
nodes AS (
  SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent,
         count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), ''))
           AS ends_sha256
  FROM linked GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT DISTINCT a.node AS top, b.node FROM prefixes a
  JOIN prefixes b ON b.conv_id = a.conv_id AND b.depth >= a.depth),
sums AS (
  SELECT b.top AS node, sum((n.n_convs - 1) * n.words)::BIGINT AS saved_tokens,
         count(*) FILTER (c.n IS NULL) AS n_leaves
  FROM below b JOIN nodes n ON n.node = b.node LEFT JOIN children c ON c.node = b.node
  GROUP BY b.top)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN children c ON c.node = n.node
LEFT JOIN nodes p ON p.node = n.parent
"""
