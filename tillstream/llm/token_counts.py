"""Token counts of documents in flat token streams that have no index.

A stream is a run of unsigned 16- or 32-bit ids in which an end-of-document id closes each
document. It comes in blocks of any size, cut anywhere: rows (stream, block, payload). Each block is
searched for the end id in one vectorised comparison and leaves only a summary: how many ids, where
the ends are. A prefix scan over the summaries gives every block its first position, the number
of documents closed before it and the last end before it; from these the documents of all blocks
follow, also those that cross one or many blocks.

`flat_streams` writes documents as such streams (one per input partition) and a manifest that
says which document is the n-th of its stream. `blocks_of_files` reads raw binary files.

A null text is empty and counts 0 tokens. Rows that repeat an id are counted one by one. Ids after
the last end form a document that is reported as not closed. Empty streams and empty tables give no
rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstream.llm.common import table, written
from tillstream.llm.tokens import encoder, vocabulary_path

END_ID = 50256
BLOCK_BYTES = 1 << 20
BLOCKS = "stream long, block long, payload binary"


def flat_streams(docs: DataFrame, vocabulary: str, end_id: int = END_ID,
                 block_bytes: int = BLOCK_BYTES, dtype: str = "<u2", id_col: str = "doc_id",
                 text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(blocks, manifest) of stored streams; the manifest has (stream, ordinal, doc_id)."""
    schema = pa.schema([("stream", pa.int64()), ("block", pa.int64()), ("payload", pa.binary()),
                        ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64()))])

    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, stream = encoder(vocabulary).ordinary, TaskContext.get().partitionId()
        rest, block, done = bytearray(), 0, 0

        def rows(payloads: list[bytes], first: int, ids: list) -> pa.RecordBatch:
            nothing = [None] * len(payloads)
            return pa.RecordBatch.from_arrays([
                pa.array([stream] * (len(payloads) + 1), pa.int64()),
                pa.array([*range(block, block + len(payloads)), None], pa.int64()),
                pa.array([*payloads, None], pa.binary()),
                pa.array([*nothing, first], pa.int64()),
                pa.array([*nothing, ids], pa.list_(pa.int64()))], schema=schema)

        for batch in batches:
            ids, full = batch.column(0).to_pylist(), []
            for text in batch.column(1):
                tokens = encode(text.as_py() or "")
                tokens.append(end_id)
                rest += np.array(tokens, dtype).tobytes()
                while len(rest) >= block_bytes:
                    full.append(bytes(rest[:block_bytes]))
                    del rest[:block_bytes]
            yield rows(full, done, ids)
            block, done = block + len(full), done + len(ids)
        if rest:
            yield rows([bytes(rest)], done, [])

    both = written(docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        flatten, f"{BLOCKS}, first long, doc_ids array<long>"), "token-streams")
    blocks = both.filter("payload is not null").select("stream", "block", "payload")
    manifest = both.filter("doc_ids is not null").select(
        "stream", "first", F.posexplode("doc_ids").alias("nth", "doc_id")).select(
        "stream", (F.col("first") + F.col("nth")).alias("ordinal"), "doc_id")
    return blocks, manifest


def blocks_of_files(spark: SparkSession, folder: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of raw token files; `stream` is a hash of the file's path, files stay below 2 GB."""
    files = spark.read.format("binaryFile").load(folder)
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)),
                        F.lit(block_bytes).cast("long"))
    return files.filter("length > 0").select(
        F.xxhash64("path").alias("stream"), "content", F.posexplode(starts).alias("block", "start")
    ).select("stream", F.col("block").cast("long").alias("block"), F.substring(
        "content", (F.col("start") + 1).cast("int"), F.lit(block_bytes)).alias("payload"))


def scan(blocks: DataFrame, end_id: int = END_ID, dtype: str = "<u2") -> DataFrame:
    """stream, ordinal, start, n_tokens, closed of each document; positions count ids."""
    schema = pa.schema([("stream", pa.int64()), ("block", pa.int64()), ("n", pa.int64()),
                        ("ends", pa.list_(pa.int64()))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends = [], []
            for payload in batch.column("payload"):
                ids = np.frombuffer(payload.as_buffer(), dtype)
                sizes.append(len(ids))
                ends.append(np.flatnonzero(ids == end_id))
            yield pa.RecordBatch.from_arrays(
                [batch.column("stream"), batch.column("block"), pa.array(sizes, pa.int64()),
                 pa.array(ends, pa.list_(pa.int64()))], schema=schema)

    found = blocks.select("stream", "block", "payload").mapInArrow(
        search, "stream long, block long, n long, ends array<long>")
    in_order = Window.partitionBy("stream").orderBy("block")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    based = found.withColumns({
        "base": F.coalesce(F.sum("n").over(before), F.lit(0)),
        "closed": F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)),
        "next": F.lead("block").over(in_order)})
    # Where the document that is open at this block's first id began.
    last_end = F.when(F.size("ends") > 0, F.col("base") + F.try_element_at("ends", F.lit(-1)) + 1)
    carried = based.withColumn("open", F.coalesce(F.max(last_end).over(before), F.lit(0)))
    absolute = F.transform("ends", lambda end: end + F.col("base"))
    tail = F.col("base") + F.col("n")
    after_last = F.when(F.size("ends") > 0, F.col("base") + F.try_element_at("ends", F.lit(-1)) + 1).otherwise(
        F.col("open"))
    unclosed = F.col("next").isNull() & (tail > after_last)
    listed = carried.select(
        "stream", "closed", "open", F.size("ends").alias("n_ends"),
        F.when(unclosed, F.concat(absolute, F.array(tail))).otherwise(absolute).alias("stops"))
    starts = F.concat(F.array("open"), F.transform("stops", lambda stop: stop + 1))
    spans = F.arrays_zip(F.slice(starts, 1, F.size("stops")).alias("start"), "stops")
    each = listed.select("stream", "closed", "n_ends", F.posexplode(spans).alias("nth", "span"))
    return each.select(
        "stream", (F.col("closed") + F.col("nth")).alias("ordinal"),
        F.col("span.start").alias("start"),
        (F.col("span.stops") - F.col("span.start")).alias("n_tokens"),
        (F.col("nth") < F.col("n_ends")).alias("closed"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, found in their flat streams."""
    blocks, manifest = flat_streams(table(spark, sf_dir, "documents"), vocabulary_path())
    counted = scan(blocks)
    return counted.join(manifest, ["stream", "ordinal"]).select(
        "doc_id", "stream", "ordinal", "start", "n_tokens")
