"""What a topic holds: scans, offsets per partition, and a look at single messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions import parsing
from tillstream.functions.text import lossy_key, lossy_text
from tillstream.session import prepare


def one_partition(messages: DataFrame, partition: int) -> DataFrame:
    return messages.where(F.col("partition") == partition)


def message_rows(messages: DataFrame) -> DataFrame:
    """Position, key and value as text."""
    return messages.select(
        "topic", "partition", "offset",
        F.expr(lossy_key("key")).alias("key"), F.expr(lossy_text("value")).alias("value"))


def summary(messages: DataFrame) -> DataFrame:
    """Low and high offset and messages per partition; a row without partition is the total."""
    per_partition = messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("low"), (F.max("offset") + 1).alias("high"))
    totals = per_partition.rollup("topic", "partition").agg(
        F.max("low").alias("low"), F.max("high").alias("high"),
        F.sum(F.col("high") - F.col("low")).alias("messages"))
    single = F.col("partition").isNotNull()
    return totals.where(F.col("topic").isNotNull()).select(
        "topic", "partition",
        F.when(single, F.col("low")).alias("low"), F.when(single, F.col("high")).alias("high"),
        "messages")


def peek(messages: DataFrame, count: int = 20) -> DataFrame:
    """The first messages in (partition, offset) order; JSON values in compact form."""
    prepare(messages.sparkSession)
    first = messages.orderBy("partition", "offset").limit(count)
    rows = message_rows(first)
    shown = F.when(F.expr(parsing.is_json("value")), F.get_json_object("value", "$"))
    return rows.withColumn("value", F.coalesce(shown, F.col("value")))
