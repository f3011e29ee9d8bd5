"""What became of consumed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.operators.dedup import ttl_anchors
from tillstream.schemas import VALID
from tillstream.session import enable_checkpoints


def ingest_stats(classified: DataFrame, stored: DataFrame, ttl_seconds: float = 300.0
                 ) -> DataFrame:
    """Consumed, inserted, recent-id duplicates, table duplicates and invalid messages.

    A valid message is a recent-id duplicate within the time-to-live of its anchor; the others
    reach the table, which takes each id once and none that it already holds.
    """
    enable_checkpoints(classified.sparkSession)
    # Three narrow columns, written once, instead of parsing all payloads for each figure.
    classified = classified.select("outcome", "event_id", "timestamp").checkpoint()
    valid = classified.where(F.col("outcome") == VALID)
    seen = classified.agg(
        F.count("*").alias("consumed"), F.count_if(F.col("outcome") != VALID).alias("invalid"))
    reached = ttl_anchors(valid, ttl_seconds).agg(F.count("*").alias("reached"))
    inserted = valid.select("event_id").distinct().join(
        stored.select("event_id"), "event_id", "left_anti").agg(F.count("*").alias("inserted"))
    figures = seen.unionByName(reached, allowMissingColumns=True).unionByName(
        inserted, allowMissingColumns=True)
    totals = figures.agg(*[
        F.sum(name).alias(name) for name in ("consumed", "invalid", "reached", "inserted")])
    return totals.select(
        "consumed", "inserted",
        (F.col("consumed") - F.col("invalid") - F.col("reached")).alias("cache_dup"),
        (F.col("reached") - F.col("inserted")).alias("db_dup"),
        "invalid")
