"""Topics as DataFrames: the Kafka connector, or files with the same six columns."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from tillstream.schemas import MESSAGE_SCHEMA
from tillstream.session import prepare
from tillstream.settings import Settings

COLUMNS = MESSAGE_SCHEMA.fieldNames()


def kafka_options(
    settings: Settings, topic: str | None = None, partitions: list[int] | None = None,
    starting: str = "earliest", min_partitions: int | None = None,
) -> dict[str, str]:
    """Source options. `starting` only matters on a first run; later the checkpoint decides.

    `min_partitions` splits the few partitions of a topic over more tasks.
    """
    topic = topic or settings.topic
    options = {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
        # Shows up in the broker's tools only; offsets are kept in the checkpoint.
        "groupIdPrefix": settings.retry_consumer_group if topic == settings.retry_topic
        else settings.consumer_group,
    }
    if partitions is None:
        options["subscribe"] = topic
    else:
        options["assign"] = json.dumps({topic: partitions})
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_stream(
    spark: SparkSession, settings: Settings, topic: str | None = None, starting: str = "earliest",
    min_partitions: int | None = None,
) -> DataFrame:
    reader = prepare(spark).readStream.format("kafka").options(
        **kafka_options(settings, topic, starting=starting, min_partitions=min_partitions))
    return reader.option("maxOffsetsPerTrigger", settings.max_per_batch).load().select(*COLUMNS)


def kafka_batch(
    spark: SparkSession, settings: Settings, topic: str | None = None,
    partitions: list[int] | None = None, min_partitions: int | None = None,
) -> DataFrame:
    """Everything a topic holds now, from the lowest to the highest offset."""
    options = kafka_options(settings, topic, partitions, min_partitions=min_partitions)
    return prepare(spark).read.format("kafka").options(
        **options, endingOffsets="latest").load().select(*COLUMNS)


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of parquet files in message shape, picked up as they arrive."""
    reader = prepare(spark).readStream.schema(MESSAGE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def file_batch(spark: SparkSession, path: str) -> DataFrame:
    return prepare(spark).read.schema(MESSAGE_SCHEMA).parquet(path)


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a source with fewer splits than cores, dealt out so that all cores can parse.

    A source with enough splits, as any large one has, is left alone.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows
