"""Mergeable sketches per day, for figures that do not add up: distinct users and percentiles.

A day is one row, whatever its number of events: a HyperLogLog sketch of the users, a KLL sketch of
the seconds from event to storage, and plain counts. Any range of days is answered from its rows
alone. `business.active_users` and `business.processing_latency` stay the exact way.

Errors: `USERS_ERROR` is three times the relative standard error of the distinct count
(1.04 / 2**(LG_USERS / 2)); the rank of a quantile is off by at most `RANK_ERROR` of all events, with
99 % confidence. Both hold for merged sketches. Null users and events without both times count for
neither sketch; a day without any has an empty one.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_USERS, KLL_K = 14, 400
USERS_ERROR = 3 * 1.04 / 2 ** (LG_USERS / 2)
# Documented for KLL sketches: 2.296 / k**0.9021 for a single quantile.
RANK_ERROR = 2.296 / KLL_K ** 0.9021


def latency_seconds() -> Column:
    return F.floor((F.unix_micros("ingested_at") - F.unix_micros("event_timestamp"))
                   / F.lit(1_000_000)).cast("long")


def daily_sketches(events: DataFrame) -> DataFrame:
    """day, events, users and latency (sketches), timed (events with a latency)."""
    latency = latency_seconds()
    return events.groupBy(F.col("event_timestamp").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("events"), F.count(latency).alias("timed"),
        F.max(latency).alias("max_seconds"),
        F.hll_sketch_agg("user_id", F.lit(LG_USERS)).alias("users"),
        F.kll_sketch_agg_bigint(latency, F.lit(KLL_K)).alias("latency"))


def refresh_sketches(events: DataFrame, path: str, first: date, last: date) -> None:
    """Recomputes the days `first` to `last` of a folder of sketches; others stay."""
    day = F.col("event_timestamp").cast("date")
    rows = daily_sketches(events.where(day.between(F.lit(first), F.lit(last))))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "day").parquet(path)


def between(sketches: DataFrame, first: date, last: date) -> DataFrame:
    return sketches.where(F.col("day").between(F.lit(first), F.lit(last)))


def active_users(sketches: DataFrame, *by: Column) -> DataFrame:
    """active_users (about) and how many rows were read, of all or per group of days."""
    return sketches.groupBy(*by).agg(
        F.count(F.lit(1)).alias("days"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("users")), F.lit(0)).alias("active_users"))


def processing_latency(sketches: DataFrame, percentiles: tuple[float, ...] = (0.5, 0.95, 0.99),
                       *by: Column) -> DataFrame:
    """events, max_seconds and percentiles (about) in whole seconds; null without any latency."""
    merged = sketches.where("timed > 0").groupBy(*by).agg(
        F.sum("timed").alias("events"), F.max("max_seconds").alias("max_seconds"),
        F.kll_merge_agg_bigint("latency").alias("latency"))
    return merged.select(
        *[c for c in merged.columns if c != "latency"],
        *[F.when(F.col("events") > 0, F.kll_sketch_get_quantile_bigint("latency", F.lit(p)))
          .alias(f"p{round(p * 100)}_seconds") for p in percentiles])
