"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are put in a shuffled order (by the MD5 of their id). Copy k of a document
gets the virtual finish time (k * source size + words of its source up to and with it) / target.
All copies, sorted by that time, are taken until the total budget is used up.

Nothing is gathered per source: sums per (source, slice of the shuffled order) are cumulated
first, then each slice is numbered on its own; the number of slices grows with the square root of
the rows. The point at which the budget ends is looked up in a histogram of finish times, of which
one bin is then ordered in full.

Sources come by code point, null last, and weigh 5, 2, 1, repeating. A target above
`max_epochs` times its source's size is cut to that, and the rest reshared by weight; since the
caps are reached in the order of size / weight, that ends in one ordered sum over the sources.

A null text has size 0, documents of size 0 add nothing, sources of size 0 have target 0, and empty
input gives empty output. Rows that repeat an id are scheduled as documents of their own; which of
two rows alike in id, source and size comes first makes no difference to the plan. Null ids come
last. Extra
columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstream.llm.common import table, word_count, written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# Copies whose finish times are numbered in one task, about.
RANGE_ROWS = 1 << 16


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, source_size, target); the sizes' sum is the budget."""
    ranked = sizes.withColumn("place", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.col("place") % len(weights) + 1).cast("int")).cast("long")
    capped = ranked.withColumns({"weight": weight, "cap": F.col("source_size") * max_epochs})
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "place")
    everything = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    # If all before this source are at their caps, its own fair share is rest * weight / open.
    shared = capped.withColumns({
        "rest": F.sum("source_size").over(everything)
        - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "open": F.sum("weight").over(everything)
        - F.coalesce(F.sum("weight").over(before), F.lit(0)),
    }).withColumn("full", F.col("cap") * F.col("open") < F.col("rest") * F.col("weight"))
    first_open = F.min(F.when(~F.col("full"), F.struct(
        F.col("cap") / F.col("weight"), F.col("place"), F.col("rest"), F.col("open")))
    ).over(everything)
    level = shared.withColumns({"rest": first_open["rest"], "open": first_open["open"]})
    fair = F.col("weight").cast("double") * F.col("rest").cast("double") / F.col("open")
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(fair)
    return level.select("source", "source_size", target.alias("target"))


def schedule(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
             max_epochs: int = MAX_EPOCHS, key: Column | None = None) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, finish (per copy), copies.

    A `key` over the columns of `docs` comes out as a further column of that name.
    """
    kept = [] if key is None else ["key"]
    sized = written(docs.select(
        *([] if key is None else [key.alias("key")]),
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("~"))).alias("shuffled")), "sizes")
    by_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    by_source = written(by_source, "sources")
    count, budget = by_source.agg(F.sum("n"), F.sum("source_size")).first()
    shares = written(targets(by_source.drop("n"), weights, max_epochs), "targets")

    slices = math.ceil(math.sqrt(count or 1))
    number = F.conv(F.substring("shuffled", 1, 8), 16, 10).cast("long")
    sliced = sized.withColumn("slice", F.shiftright(number * slices, 32))
    sums = sliced.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    in_source = Window.partitionBy("source").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = sums.select("source", "slice", F.coalesce(
        F.sum("words").over(in_source), F.lit(0)).alias("base"))
    in_slice = Window.partitionBy("source", "slice").orderBy(
        "shuffled", "doc_id", "size", *kept)
    numbered = sliced.withColumn("within", F.sum("size").over(
        in_slice.rowsBetween(Window.unboundedPreceding, 0)))
    based = numbered.join(bases, numbered["source"].eqNullSafe(bases["source"])
                          & (numbered["slice"] == bases["slice"])).select(
        *kept, "doc_id", numbered["source"], "size", "shuffled",
        (F.col("base") + F.col("within")).alias("upto"))
    timed = based.join(shares, based["source"].eqNullSafe(shares["source"])).select(
        *kept, "doc_id", "size", "shuffled", "source_size", "target",
        F.array(*[F.try_divide(F.col("source_size") * k + F.col("upto"), F.col("target"))
                  for k in range(max_epochs)]).alias("finish"))
    timed = written(timed, "finish-times")
    return timed.withColumn("copies", _copies(timed, budget or 0, slices, max_epochs)).drop(
        "shuffled")


def _copies(timed: DataFrame, budget: int, bins: int, max_epochs: int) -> Column:
    """How many copies come before the point at which the budget is used up."""
    # Whatever ends by time 1 fits the budget, so the end lies shortly after it.
    def bin_of(time: Column) -> Column:
        return F.least(F.floor(time * bins), F.lit(2 * bins)).cast("long")

    copies = timed.filter("size > 0").select(
        "size", "shuffled", "doc_id", F.posexplode("finish").alias("copy", "time"))
    copies = copies.withColumn("bin", bin_of(F.col("time")))
    histogram = copies.groupBy("bin").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    upto = F.sum("words").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    over = histogram.withColumn("upto", upto).filter(F.col("upto") > budget).orderBy("bin").first()
    if over is None:
        return F.when(F.col("target") > 0, max_epochs).otherwise(0)
    order = [F.col("time"), F.col("shuffled"), F.col("doc_id").asc_nulls_last(), F.col("copy")]
    before = over["upto"] - over["words"]
    # Times may be equal throughout a bin, so it is range-sorted and only the range with the end in
    # it is numbered row by row.
    ranged = written(
        copies.filter(F.col("bin") == over["bin"]).repartitionByRange(
            1 + over["n"] // RANGE_ROWS, *order).withColumn("part", F.spark_partition_id()),
        "last-bin")
    parts = ranged.groupBy("part").agg(F.sum("size").alias("words")).withColumn("upto", F.sum(
        "words").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) + before)
    cut = parts.filter(F.col("upto") > budget).orderBy("part").first()
    in_part = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    backwards = [F.col("time").desc(), F.col("shuffled").desc(), F.col("copy").desc()]
    last = (ranged.filter(F.col("part") == cut["part"])
            .withColumn("upto", F.sum("size").over(in_part) + (cut["upto"] - cut["words"]))
            .filter(F.col("upto") <= budget).orderBy(F.col("upto").desc(), *backwards).first())
    if last is None:
        last = ranged.filter(F.col("part") < cut["part"]).orderBy(*backwards).first()
    total = F.lit(0)
    for k in range(max_epochs):
        time = F.element_at("finish", k + 1)
        taken = bin_of(time) < over["bin"]
        if last is not None:
            at = F.struct(time.alias("t"), F.col("shuffled").alias("s"), F.lit(k).alias("k"))
            end = F.struct(F.lit(last["time"]).alias("t"), F.lit(last["shuffled"]).alias("s"),
                           F.lit(last["copy"]).alias("k"))
            taken = taken | ((bin_of(time) == over["bin"]) & (at <= end))
        total = total + F.when(taken, 1).otherwise(0)
    return total


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
          max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: the rows of `docs`, once per copy, range-sorted by virtual finish time.

    Plan and rows meet by a key of id, source and text, none of which makes it null; rows alike in
    all three are numbered.
    """
    key = F.sha2(F.to_json(F.struct(
        F.col(id_col).cast("string").alias("id"), F.col(source_col).alias("source"),
        F.sha2(F.col(text_col).cast("binary"), 256).alias("text"))), 256)
    plan = schedule(docs, id_col, text_col, source_col, weights, max_epochs, key)
    alike = Window.partitionBy("key").orderBy(F.element_at("finish", 1))
    taken = written(plan.select(
        F.col("key").alias("__key"), F.row_number().over(alike).alias("__number"),
        F.col("doc_id").alias("__id"), F.col("copies").alias("__copies"),
        F.col("finish").alias("__finish")), "mix-plan")
    rows, by = docs.withColumn("__key", key), ["__key"]
    if not taken.filter("__number > 1").isEmpty():
        rows, by = rows.withColumn("__number", F.row_number().over(
            Window.partitionBy("__key").orderBy(F.lit(0)))), ["__key", "__number"]
    return (rows.join(taken.filter("__copies > 0"), by)
            .withColumn("__time", F.explode(F.slice("__finish", 1, F.col("__copies"))))
            .orderBy("__time", "__id").select(*docs.columns))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = schedule(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"))


OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS shuffled,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST([5, 2, 1][place % 3 + 1] AS BIGINT) AS weight, 3 * source_size AS cap
  FROM sources),
shared AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS BIGINT) AS rest,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS BIGINT) AS open
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT rest, open FROM shared WHERE cap * open >= rest * weight
  ORDER BY cap / weight, place LIMIT 1),
targets AS (
  SELECT s.source, s.source_size,
         CASE WHEN s.cap * s.open < s.rest * s.weight THEN CAST(s.cap AS DOUBLE)
              ELSE CAST(s.weight AS DOUBLE) * CAST(l.rest AS DOUBLE) / l.open END AS target
  FROM shared s, level l),
placed AS (
  SELECT d.doc_id, d.size, d.shuffled, t.source_size, t.target,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.shuffled, d.doc_id, d.size
              ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT p.doc_id, p.size, sum(p.size) OVER (
           ORDER BY (p.source_size * k.k + p.upto) / p.target, p.shuffled, p.doc_id, k.k
           ROWS UNBOUNDED PRECEDING) AS total
  FROM placed p, (VALUES (0), (1), (2)) k(k) WHERE p.size > 0),
taken AS (
  SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM copies
  WHERE total <= (SELECT sum(source_size) FROM sources) GROUP BY doc_id)
SELECT p.doc_id, p.size, p.source_size, p.target, coalesce(t.taken, 0) AS taken
FROM placed p LEFT JOIN taken t USING (doc_id)
"""
