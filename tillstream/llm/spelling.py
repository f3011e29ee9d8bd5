"""Spelling variants: words one edit apart, by composing acceptors with a one-edit transducer.

Words are runs of letters, lower-cased in A-Z only and altered as the query says; those of at least
`LEAST_LETTERS` code points that occur `LEAST_COUNT` times or more make the vocabulary. Two words are
near if they differ by one inserted, deleted or replaced code point. A word's form is the near word
that occurs most, if it occurs `FACTOR` times as often; the root is where following forms ends.

One edit leaves one half of the shorter word as it is. The composed machine is therefore cut at the
states that are reached with that half read: a shard holds the words of one length and those one
longer that have the half in common, and the acceptor of what is open in them is composed with the
transducer and itself. Shards of more than `SHARD` words are cut in the same way again, until they are
small enough or a single letter is open, so no task holds more than a shard's words. A pair whose
extra letter could belong to either half is found where the first half is in common. Words of a
shard with links come out as one row each (links and best link so far); pairs are not written.

Null texts have no words, empty tables no rows; repeated rows count as often as they come. Columns
other than id and text are not looked at; a null id reads as `null` where a word is altered.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.acceptor import Acceptors, allow_depth
from tillstream.llm.common import UPPER, ascii_lower, crc32_sql, ship, table, written

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS, LEAST_COUNT, FACTOR, ALTERED = 7, 2, 10, 31
SHARD = 50_000

FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()),
                   ("form", pa.string())])


def _altered(run: Column, doc_id: Column) -> Column:
    """The run, without one letter where the checksum says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    rest = F.char_length(run)
    return F.when(h % ALTERED == 0, F.concat(
        F.substring(run, F.lit(1), at), F.substring(run, at + 2, rest))).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n. Runs that are too short stay so when a letter goes, so they are not even split off."""
    pattern = F.lit(f"[{LETTERS}]{{{LEAST_LETTERS},}}")
    runs = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.regexp_extract_all(
        ascii_lower(F.col(text_col)), pattern, F.lit(0))).alias("run"))
    words = runs.select(_altered(F.col("run"), F.col("doc_id")).alias("word")).filter(
        F.char_length("word") >= LEAST_LETTERS)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") >= LEAST_COUNT)


def _cut(rows: DataFrame) -> DataFrame:
    """Every row twice: with the first half of its open letters fixed, and with the second.

    `width` letters from `start` on are open, one more in the longer words (`extra` = 1). `early`
    tells that letters after the open ones were fixed while those before were open.
    """
    half = F.floor(F.col("width") / 2).cast("int")
    word, start, width = F.col("word"), F.col("start"), F.col("width")
    first = F.struct(
        F.concat("shard", F.lit("<"), F.substring(word, start, half)).alias("shard"),
        (start + half).alias("start"), (width - half).alias("width"), F.col("early"))
    second = F.struct(
        F.concat("shard", F.lit(">"), F.substring(word, start + half + F.col("extra"), width - half))
        .alias("shard"), start.alias("start"), half.alias("width"), F.lit(True).alias("early"))
    return rows.select("word", "n", "extra", F.explode(F.array(first, second)).alias("cut")).select(
        "word", "n", "extra", "cut.*")


def shards(words: DataFrame, most: int = SHARD) -> DataFrame:
    """word, n, extra, shard, start, width, early: every word in the shards it can have links in."""
    length = F.char_length("word")
    roles = F.array(*[F.struct((length - extra).alias("width"), F.lit(extra).alias("extra"))
                      for extra in (0, 1)])
    rows = _cut(words.select("word", "n", F.explode(roles).alias("role")).select(
        "word", "n", "role.*").filter(F.col("width") >= LEAST_LETTERS).select(
        "word", "n", "extra", F.col("width").cast("string").alias("shard"),
        F.lit(1).alias("start"), "width", F.lit(False).alias("early")))
    done = None
    while True:
        # There are at most as many large shards as `most` goes into the rows.
        large = written(rows.filter("width > 1").groupBy("shard").count().filter(
            F.col("count") > most).select("shard"), "large-shards")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, "shard", "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = _cut(rows.join(large, "shard", "left_semi"))


class _Best:
    """Links of the words of one shard: how many, and the best."""

    def __init__(self):
        self.count: dict[str, int] = {}
        self.best: dict[str, tuple[int, str]] = {}

    def link(self, word: str, n: int, near: str, near_n: int) -> None:
        for a, b in ((word, (-near_n, near)), (near, (-n, word))):
            self.count[a] = self.count.get(a, 0) + 1
            if a not in self.best or b < self.best[a]:
                self.best[a] = b

    def rows(self) -> list[tuple]:
        return [(word, count, -self.best[word][0], self.best[word][1])
                for word, count in self.count.items()]


def _links(rows: list[tuple]) -> list[tuple]:
    """Rows of FOUND of one shard's rows (word, n, extra, start, width, early)."""
    start, width, early = rows[0][3] - 1, rows[0][4], rows[0][5]
    # What is open tells the words of a shard apart, and sorts as they do.
    sides = [sorted((word[start:start + width + extra], word, n)
                    for word, n, more, *_ in rows if more == extra) for extra in (0, 1)]
    if not sides[0] or len(rows) < 2:
        return []
    allow_depth(width)
    machine, found = Acceptors(), _Best()
    own, more = (machine.add([open_ for open_, _, _ in side]) for side in sides)
    for i, j in machine.replaced(own):
        (_, word, n), (_, near, near_n) = sides[0][i], sides[0][j]
        found.link(word, n, near, near_n)
    if sides[1]:
        for i, j in machine.inserted(own, more):
            (open_, word, n), (longer, near, near_n) = sides[0][i], sides[1][j]
            if not (early and longer[:width] == open_):
                found.link(word, n, near, near_n)
    return found.rows()


def _linked_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard; one shard is held at a time."""
    shard, rows, out = None, [], []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, FOUND, strict=True)], schema=FOUND)

    for piece in batches:
        for key, *row in zip(*[column.to_pylist() for column in piece.columns], strict=True):
            if key != shard:
                if len(rows) > 1:
                    out += _links(rows)
                    if len(out) > 20_000:
                        yield batch()
                        out = []
                shard, rows = key, []
            rows.append(row)
    if len(rows) > 1:
        out += _links(rows)
    if out:
        yield batch()


def near_words(words: DataFrame, most: int = SHARD) -> DataFrame:
    """word, n, n_near, form (null where no near word occurs often enough), form_n."""
    ship(words.sparkSession)
    rows = shards(words, most).select("shard", "word", "n", "extra", "start", "width", "early")
    found = rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(
        _linked_words, "word string, n_near long, form_n long, form string")
    every = words.select("word", "n", F.lit(0).cast("long").alias("n_near"),
                         F.lit(None).cast("long").alias("form_n"),
                         F.lit(None).cast("string").alias("form"))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("n"), "form")))
    folded = every.unionByName(found.withColumn("n", F.lit(None).cast("long"))).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    often = -F.col("best.n") >= FACTOR * F.col("n")
    return folded.select("word", "n", "n_near", F.when(often, F.col("best.form")).alias("form"),
                         F.when(often, -F.col("best.n")).alias("form_n"))


def with_roots(words: DataFrame) -> DataFrame:
    """Adds `root`. Every step doubles the way; forms occur ten times as often, so ways are short."""
    steps = written(words.filter("form IS NOT NULL").select("word", F.col("form").alias("root")),
                    "forms")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if steps.join(further, "root", "left_semi").isEmpty():
            break
        steps = written(steps.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root")), "forms")
    return words.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             most: int = SHARD) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = written(vocabulary(docs, id_col, text_col), "vocabulary")
    return with_roots(written(near_words(words, most), "near-words")).select(
        "word", "form", "root", "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


OP13_SQL = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, '{UPPER}', '{UPPER.lower()}'), '[{LETTERS}]{{{LEAST_LETTERS},}}')) AS run
  FROM documents),
summed AS (
  SELECT run, {crc32_sql("coalesce(doc_id::VARCHAR, 'null') || ':' || run")} AS h FROM runs),
altered AS (
  SELECT CASE WHEN h % {ALTERED} = 0 THEN substring(run, 1, (h % length(run))::INT)
                                          || substring(run, (h % length(run))::INT + 2)
              ELSE run END AS word FROM summed),
words AS (
  SELECT word, count(*) AS n FROM altered WHERE length(word) >= {LEAST_LETTERS}
  GROUP BY word HAVING count(*) >= {LEAST_COUNT}),
gaps AS (
  SELECT word, i, substring(word, 1, i::INT - 1) || substring(word, i::INT + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS word, b.word AS near FROM gaps a JOIN gaps b
    ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.rest FROM gaps a JOIN words b ON b.word = a.rest
  UNION SELECT a.rest, a.word FROM gaps a JOIN words b ON b.word = a.rest),
linked AS (
  SELECT w.word, w.n, count(p.near) AS n_near,
         first(p.near ORDER BY x.n DESC, p.near) AS best,
         max(x.n) AS best_n
  FROM words w LEFT JOIN pairs p ON p.word = w.word LEFT JOIN words x ON x.word = p.near
  GROUP BY w.word, w.n),
formed AS (
  SELECT word, n, n_near, CASE WHEN best_n >= {FACTOR} * n THEN best END AS form,
         CASE WHEN best_n >= {FACTOR} * n THEN best_n END AS form_n FROM linked),
walk AS (
  SELECT word, word AS place, 0 AS step FROM formed
  UNION ALL
  SELECT w.word, f.form, step + 1 FROM walk w JOIN formed f ON f.word = w.place
  WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT word, arg_max(place, step) AS root FROM walk GROUP BY word) r
  ON r.word = f.word
"""
