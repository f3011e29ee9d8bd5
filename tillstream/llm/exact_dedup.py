"""Exact duplicates against a persistent digest index.

The index is a table (digest, keep_id, group_size), bucketed and sorted by digest. A new batch is
folded to one row per digest (partial aggregation, so a text with a third of all rows sends one row
per task) and joined to the index bucket by bucket; digests without a partner are new and appended.
Documents then look up the batch's own digests; that join is an ordinary shuffle, so that Spark can
split a skewed digest. The index is read once a batch, and neither copied nor shuffled. The number of
buckets belongs to the folder: an index that is opened again keeps the one it began with.

Texts are equal when identical after lower-casing A-Z only; a null text counts as empty. Within a
batch the largest doc_id of a digest stays; a digest that an earlier batch stored keeps that
batch's row, and every newer copy goes. Null ids are smaller than any other. Rows that repeat an
id together with its text are reported alike; `keep_rows` keeps one of them. Empty input gives
empty output and leaves the index as it was. Extra columns pass through unchanged; names that
start with `__` are reserved.

The index lives in one folder that has one writer at a time.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.common import ascii_lower, table, written
from tillstream.session import scratch_folder

BUCKETS = 64
INDEX_SCHEMA = "digest BINARY, keep_id BIGINT, group_size BIGINT"


def digest_of(text: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the normalised text."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


class DigestIndex:
    """Opens the index in a folder, or begins one there with so many buckets.

    A new index should have some 100 MB of digests a bucket once it is full.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("ignore").parquet(
            f"{folder}.buckets")
        self.spark, self.folder = spark, folder
        self.buckets = buckets = spark.read.parquet(f"{folder}.buckets").first()["buckets"]
        self.name = f"digest_index_{os.urandom(6).hex()}"
        spark.sql(
            f"CREATE TABLE {self.name} ({INDEX_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{folder}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def looked_up(self, digests: DataFrame) -> DataFrame:
        """Each digest of a batch (doc_id, digest) with its keep_id, group_size and is_new."""
        folded = digests.groupBy("digest").agg(
            F.max("doc_id").alias("new_id"), F.count(F.lit(1)).alias("new_size"))
        stored = self.rows().hint("merge").withColumn("known", F.lit(True))
        known = F.col("known").isNotNull()
        return folded.join(stored, "digest", "left").select(
            "digest", F.when(known, F.col("keep_id")).otherwise(F.col("new_id")).alias("keep_id"),
            F.when(known, F.col("group_size")).otherwise(F.col("new_size")).alias("group_size"),
            (~known).alias("is_new"))

    def add(self, digests: DataFrame) -> DataFrame:
        """Adds the digests that the index does not hold yet; returns what was looked up."""
        # Written aside: a table cannot be read and appended to in one job.
        batch = written(self.looked_up(digests), "batch-digests")
        (batch.filter("is_new").drop("is_new").repartition(self.buckets, "digest").write
         .mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
         .option("path", self.folder).saveAsTable(self.name))
        return batch


def decisions(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. Extends the index.

    `group_size` counts the copies in the batch that brought the digest.
    """
    digests = written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.unhex(digest_of(F.col(text_col))).alias("digest")), "digests")
    found = digests.join(index.add(digests), "digest")
    kept = F.col("is_new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"),
                        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_rows(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, once each, with their own columns."""
    def key(digest: Column, doc_id: Column) -> Column:
        return F.concat_ws(":", digest, doc_id.cast("string"))

    stay = decisions(docs, index, id_col, text_col).filter("kept").select(
        key(F.col("text_sha256"), F.col("doc_id")).alias("__key")).distinct()
    marked = docs.withColumn("__key", key(digest_of(F.col(text_col)), F.col(id_col).cast("long")))
    # Join and folding share one key, so texts are shuffled once.
    return marked.join(stay, "__key", "left_semi").dropDuplicates(["__key"]).select(*docs.columns)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against a new index."""
    index = DigestIndex(spark, scratch_folder(spark, "digest-index"))
    return decisions(table(spark, sf_dir, "documents"), index)


OP3_SQL = """
WITH texts AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM texts
"""
