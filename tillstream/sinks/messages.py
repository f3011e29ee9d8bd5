"""Events as keyed JSON messages, to a topic or to files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillstream.functions.timing import iso_text
from tillstream.settings import Settings


def to_messages(events: DataFrame) -> DataFrame:
    """`key` (the user, null when missing) and `value` (JSON; absent optional fields are left out)."""
    value = F.to_json(F.struct(
        "event_id", "event_type", iso_text(F.col("event_timestamp")).alias("timestamp"),
        "user_id", "product_id", "quantity", "unit_price"))
    key = F.when(F.col("user_id") != "", F.col("user_id")).cast("binary")
    return events.select(key.alias("key"), value.cast("binary").alias("value"))


def write_topic(messages: DataFrame, settings: Settings, topic: str) -> int:
    """Publishes `key, value` and returns how many were sent; a failed write raises."""
    if messages.isEmpty():
        return 0
    counted, observed = _counted(messages)
    counted.write.format("kafka").options(**{
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.retries": "5",
        "kafka.retry.backoff.ms": "500",
        "topic": topic,
    }).save()
    return observed.get["sent"]


def publisher(settings: Settings, topic: str | None = None) -> Callable[[DataFrame], int]:
    """What sends messages to a topic, the dead-letter topic unless another is named."""
    return lambda messages: write_topic(messages, settings, topic or settings.dlq_topic)


def write_files(messages: DataFrame, path: str) -> int:
    # Spark does not run a plan that it knows to be empty, and then nothing would be counted.
    if messages.isEmpty():
        return 0
    counted, observed = _counted(messages)
    counted.write.mode("append").parquet(path)
    return observed.get["sent"]


def _counted(messages: DataFrame) -> tuple[DataFrame, Observation]:
    observed = Observation()
    return messages.observe(observed, F.count(F.lit(1)).alias("sent")), observed
