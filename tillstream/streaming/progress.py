"""How far a running query has come, as rows for `operators.lag` and as metric samples."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OFFSETS = "topic string, partition int, ts timestamp, high long, committed long"


def _offsets(text) -> dict[tuple[str, int], int]:
    """(topic, partition) to offset, of a topic source's JSON; nothing of other sources."""
    value = json.loads(text) if isinstance(text, str) else text or {}
    return {(topic, int(partition)): int(offset) for topic, parts in value.items()
            if isinstance(parts, dict) for partition, offset in parts.items()}


def topic_offsets(spark: SparkSession, progress: list[dict]) -> DataFrame:
    """topic, partition, ts, high, committed of progress reports, as `query.recentProgress` has them.

    `committed` is where the batch ended, which the checkpoint holds when the report is made; `high`
    is the latest offset that the source saw. There are a few reports per query, a row per partition.
    """
    rows = []
    for report in progress:
        ts = datetime.fromisoformat(report["timestamp"].replace("Z", "+00:00"))
        for source in report["sources"]:
            done = _offsets(source.get("endOffset"))
            for place, high in (_offsets(source.get("latestOffset")) or done).items():
                rows.append((*place, ts, high, done.get(place)))
    return spark.createDataFrame(rows, OFFSETS)


def file_offsets(spark: SparkSession, folder: str, checkpoint: str, topic: str) -> DataFrame:
    """The same for a stream of files: how many are there, and how many committed batches have read.

    The checkpoint lists the files of each batch, and the batches that are committed.
    """
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(
        folder).select("path").agg(F.count(F.lit(1)).alias("high"))
    entry = F.from_json("value", "path string, batchId long")
    read = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{")).select(
        entry["path"].alias("path"), entry["batchId"].alias("batch")).distinct()
    ended = spark.read.text(f"{checkpoint}/commits").select(F.element_at(F.split(
        F.input_file_name(), "/"), -1).alias("batch")).where(
        F.col("batch").rlike("^[0-9]+$")).agg(F.max(F.col("batch").cast("long")).alias("last"))
    done = read.join(F.broadcast(ended)).where("batch <= last").agg(
        F.count(F.lit(1)).alias("committed"))
    return there.join(F.broadcast(done)).select(
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"),
        F.current_timestamp().alias("ts"), "high", "committed")


def lag_samples(offsets: DataFrame, group: str) -> DataFrame:
    """`metric, labels, ts, value`: the offsets per partition, and the group's lag per topic."""
    lag = F.greatest(F.col("high") - F.coalesce("committed", F.lit(0)), F.lit(0))
    places = offsets.select(
        F.lit("kafka_topic_partition_current_offset").alias("metric"),
        F.create_map(F.lit("topic"), "topic", F.lit("partition"),
                     F.col("partition").cast("string")).alias("labels"),
        "ts", F.col("high").cast("double").alias("value"))
    sums = offsets.groupBy("topic", "ts").agg(F.sum(lag).cast("double").alias("value")).select(
        F.lit("kafka_consumergroup_lag_sum").alias("metric"),
        F.create_map(F.lit("consumergroup"), F.lit(group), F.lit("topic"), "topic").alias("labels"),
        "ts", "value")
    return places.unionByName(sums)
