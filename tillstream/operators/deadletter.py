"""Dead letters: build, list, select for replay, unwrap and re-queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions import parsing
from tillstream.functions.text import lossy_key, lossy_text
from tillstream.functions.timing import iso_text
from tillstream.operators.classify import classify, once, rejected
from tillstream.schemas import DLQ_COLUMNS, DLQ_SCHEMA, VALID
from tillstream.session import prepare


def dlq_id(rows: DataFrame) -> Column:
    """The same message and attempt always give the same id, so a repeated write can be dropped.

    A new message is told by its position. Of a retry the payload counts too, which may have been
    corrected and need not say where it came from, and so does the retry message's own position.
    """
    origin = ["topic", "partition", "offset", "retry_count"]
    if "retry_position" not in rows.columns:
        return F.md5(F.concat_ws(":", *origin))
    again = F.col("retry_position").isNotNull()
    return F.md5(F.concat_ws(":", *origin, F.when(again, F.md5("payload")), "retry_position"))


def build_dlq(classified: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """Dead-letter records of rejected messages, with the message key beside them.

    `retry_count` is taken from the input where it is there (a failed retry), else 0.
    """
    stamp = F.current_timestamp() if failed_at is None else failed_at
    rows = rejected(classified)
    attempts = F.col("retry_count") if "retry_count" in rows.columns else F.lit(0)
    rows = rows.withColumn("retry_count", F.coalesce(attempts, F.lit(0)))
    return rows.select(
        F.col("message_key").alias("key"),
        dlq_id(rows).alias("dlq_id"),
        F.col("outcome").alias("reason"),
        "errors",
        F.col("topic").alias("original_topic"),
        F.col("partition").cast("int").alias("original_partition"),
        F.col("offset").cast("long").alias("original_offset"),
        F.col("payload").alias("raw_payload"),
        iso_text(stamp).alias("failed_at"),
        F.col("retry_count").cast("int").alias("retry_count"),
    )


def error_text(errors: str = "errors") -> Column:
    """All messages of a reject in one line."""
    return F.array_join(errors, "; ")


def dlq_messages(records: DataFrame, *more: Column) -> DataFrame:
    """Records as `key`, `value` (JSON) for a topic; null members are written as JSON nulls."""
    value = F.to_json(F.struct(*DLQ_COLUMNS), {"ignoreNullFields": "false"})
    return records.select(F.col("key").cast("binary").alias("key"),
                          value.cast("binary").alias("value"), *more)


def _parsed_records(messages: DataFrame) -> DataFrame:
    """Messages with their `record` and whether they are a record at all (`is_record`)."""
    prepare(messages.sparkSession)
    schema = f"{DLQ_SCHEMA.simpleString()[7:-1].replace(':', ' ')}, corrupt string"
    rows = messages.withColumns({
        "text": F.expr(lossy_text("value")),
        "message_key": F.expr(lossy_key("key")),
    })
    rows = rows.withColumn("record", F.from_json("text", schema, {
        "columnNameOfCorruptRecord": "corrupt", "allowSingleQuotes": "false",
        "allowNonNumericNumbers": "false"}))
    return once(rows.withColumn("is_record", F.coalesce(
        F.expr("is_valid_utf8(cast(value AS string))")
        & F.col("record").isNotNull() & F.col("record.corrupt").isNull()
        & F.expr(parsing.is_one_object("text")), F.lit(False))))


def skipped(messages: DataFrame) -> DataFrame:
    """Messages on a retry topic that are not JSON objects; they are reported, never re-queued."""
    return _parsed_records(messages).where(~F.col("is_record")).select(*messages.columns)


def read_dlq(messages: DataFrame) -> DataFrame:
    """Dead-letter topic messages as records; messages that are not JSON objects are skipped.

    Members that are absent get their defaults: retry_count 0, raw_payload '', topic 'unknown',
    partition and offset -1. `retry_position` is where the message itself stood, '' if it has none.
    """
    return _records(_parsed_records(messages).where("is_record"))


def _records(rows: DataFrame, *more: Column) -> DataFrame:
    defaults = {"retry_count": 0, "raw_payload": "", "original_topic": "unknown",
                "original_partition": -1, "original_offset": -1}
    place = [name for name in ("topic", "partition", "offset") if name in rows.columns]
    return rows.select(F.col("message_key").alias("key"), *[
        F.coalesce(F.col(f"record.{name}"), F.lit(defaults[name])).alias(name)
        if name in defaults else F.col(f"record.{name}").alias(name)
        for name in DLQ_COLUMNS
    ], F.concat_ws(":", *place).alias("retry_position"), *more)


def select_replay(
    records: DataFrame, dlq_id: str | None = None, skip_exhausted: bool = False,
    max_retry_count: int = 3,
) -> DataFrame:
    """Records to send through the retry topic."""
    if dlq_id is not None:
        records = records.where(F.col("dlq_id") == dlq_id)
    if skip_exhausted:
        records = records.where(F.coalesce("retry_count", F.lit(0)) < max_retry_count)
    return records


def listing(records: DataFrame) -> DataFrame:
    """What a dry run shows: id, reason, attempts and where the message came from."""
    return records.select(
        "dlq_id", "reason", "retry_count",
        F.format_string(
            "[%s p%d o%d]", "original_topic", "original_partition", "original_offset",
        ).alias("original"),
    )


def retry_input(records: DataFrame) -> DataFrame:
    """Unwrapped records in message shape: the payload again, under its original position.

    `retry_count` is the number the record would carry if it failed once more.
    """
    position = F.col("retry_position") if "retry_position" in records.columns else F.lit("")
    return records.select(
        F.col("key").cast("binary").alias("key"),
        F.col("raw_payload").cast("binary").alias("value"),
        F.col("original_topic").alias("topic"),
        F.col("original_partition").alias("partition"),
        F.col("original_offset").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        (F.col("retry_count") + 1).alias("retry_count"),
        F.col("dlq_id").alias("retried_id"),
        position.alias("retry_position"),
        *[name for name in ("skipped", "whole") if name in records.columns],
    )


def unwrapped(messages: DataFrame) -> DataFrame:
    """Retry messages in message shape; those that are no record stay and are marked `skipped`."""
    rows = _records(_parsed_records(messages), (~F.col("is_record")).alias("skipped"),
                    F.col("value").alias("whole"))
    given = retry_input(rows)
    return given.withColumn("value", F.when(F.col("skipped"), F.col("whole")).otherwise(
        F.col("value"))).drop("whole")


def reprocess(records: DataFrame) -> DataFrame:
    """Records put through the same parsing, normalising and validation as new messages."""
    return classify(retry_input(records))


def severity(max_attempts: int = 3) -> Column:
    """Of the notice about a record that failed again; a first failure has none."""
    attempts = F.col("retry_count")
    return F.when(attempts >= max_attempts, "CRITICAL").when(attempts > 0, "WARNING")


def requeue(reprocessed: DataFrame, max_attempts: int = 3,
            failed_at: Column | None = None) -> DataFrame:
    """Records that failed again: origin kept, attempts + 1, with the severity of the notice."""
    return build_dlq(reprocessed, failed_at).withColumn("severity", severity(max_attempts))


def retry_stats(reprocessed: DataFrame, skipped: int = 0) -> DataFrame:
    """Consumed, recovered (duplicates count too) and sent-back totals."""
    good = F.col("outcome") == VALID
    return reprocessed.agg(
        (F.count("*") + F.lit(skipped)).alias("consumed"),
        F.count_if(good).alias("recovered"),
        F.count_if(~good).alias("sent_back"),
    )


def failed_by_reason(records: DataFrame) -> DataFrame:
    return records.groupBy("reason").agg(F.count("*").alias("failed"))
