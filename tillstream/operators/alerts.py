"""Alert rules: a threshold that must hold for a while without a gap."""

from __future__ import annotations

from dataclasses import dataclass
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.operators import series, timeline


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    hold_seconds: int
    # Texts with {label}, {value}, {threshold} and {hold} (minutes) in them.
    summary: str
    description: str
    value_format: str = "%s"


# The alert rules, with their thresholds below.
CONSUMER_LAG = Rule(
    "ConsumerLagGrowingUnbounded", "critical", 600,
    "{consumergroup} lag stuck above {threshold} on {topic}",
    "Consumer group {consumergroup}'s lag on {topic} has been above {threshold} messages for at "
    "least {hold} minutes ({value} now): it is not keeping up or has stopped.", "%.0f")
DLQ_RATE = Rule(
    "DLQVolumeSpiking", "warning", 300, "DLQ receiving messages faster than expected",
    "Dead letters have been growing at {value} msg/sec for at least {hold} minutes: something "
    "upstream keeps producing events that are rejected.", "%.2f")
TARGET_DOWN = Rule(
    "ServiceHealthCheckFailing", "critical", 120, "{job} target down",
    "job={job} (instance={instance}) could not be scraped for at least {hold} minutes.")
LAG_THRESHOLD = 1000
DLQ_RATE_THRESHOLD = 0.1
DLQ_RATE_RANGE_SECONDS = 300
STEP_SECONDS = 15
LAG_GROUPS = "ingestion-service|retry-service"


def sustained(
    samples: DataFrame, breach: Column, hold_seconds: int, keys: list[str],
    max_gap_seconds: int = 300,
) -> DataFrame:
    """Breaching samples with `active_since` and `state` (pending, or firing once held).

    A sample that does not breach, or a pause longer than `max_gap_seconds`, starts over.
    """
    rows = samples.withColumn("breach", F.coalesce(breach, F.lit(False)))
    rows = timeline.with_run_start(rows, keys, "ts", "breach", max_gap_seconds)
    held = F.unix_micros("ts") - F.unix_micros("run_start") >= hold_seconds * 1_000_000
    return rows.where("breach").withColumn(
        "state", F.when(held, "firing").otherwise("pending")).drop("breach").withColumnRenamed(
        "run_start", "active_since")


def _text(pattern: str, known: dict[str, Column]) -> Column:
    """The pattern with its names filled in; what is not known is a label."""
    parts = []
    for plain, name, _, _ in Formatter().parse(pattern):
        parts.append(F.lit(plain))
        if name:
            parts.append(known.get(name, F.coalesce(F.col("labels")[name], F.lit(""))))
    return F.concat(*parts)


def evaluate(samples: DataFrame, rule: Rule, breach: Column, max_gap_seconds: int = 300,
             hold_seconds: int | None = None, threshold: float | None = None) -> DataFrame:
    """A rule's pending and firing samples, with severity, summary and description."""
    rows = samples.withColumn("series", series.series_key(F.col("labels")))
    hold = rule.hold_seconds if hold_seconds is None else hold_seconds
    return described(sustained(rows, breach, hold, ["series"], max_gap_seconds), rule, hold,
                     threshold)


def described(rows: DataFrame, rule: Rule, hold: int, threshold: float | None = None) -> DataFrame:
    """Adds the rule's name, severity and texts to `labels, ts, value, active_since, state`."""
    known = {"value": F.format_string(rule.value_format, "value"), "hold": F.lit(f"{hold / 60:g}"),
             "threshold": F.lit(f"{threshold or 0:g}")}
    return rows.select(
        F.lit(rule.name).alias("alert"), F.lit(rule.severity).alias("severity"), "labels", "ts",
        "value", "active_since", "state", _text(rule.summary, known).alias("summary"),
        _text(rule.description, known).alias("description"))


def lag_alert(samples: DataFrame, threshold: float = LAG_THRESHOLD, groups: str = LAG_GROUPS,
              max_gap_seconds: int = 300, hold_seconds: int | None = None) -> DataFrame:
    lags = series.select(
        samples, "kafka_consumergroup_lag_sum", matching={"consumergroup": groups})
    return evaluate(lags, CONSUMER_LAG, F.col("value") > threshold, max_gap_seconds, hold_seconds,
                    threshold)


def dlq_rate(samples: DataFrame, topic: str, range_seconds: int = DLQ_RATE_RANGE_SECONDS,
             step_seconds: int = STEP_SECONDS) -> DataFrame:
    offsets = series.select(samples, "kafka_topic_partition_current_offset", {"topic": topic})
    return series.total(series.rate_at_steps(offsets, range_seconds, step_seconds))


def dlq_alert(samples: DataFrame, topic: str, threshold: float = DLQ_RATE_THRESHOLD,
              range_seconds: int = DLQ_RATE_RANGE_SECONDS, max_gap_seconds: int = 300,
              hold_seconds: int | None = None, step_seconds: int = STEP_SECONDS) -> DataFrame:
    rates = dlq_rate(samples, topic, range_seconds, step_seconds).withColumn(
        "labels", F.expr("cast(map() AS map<string,string>)"))
    return evaluate(rates, DLQ_RATE, F.col("value") > threshold, max_gap_seconds, hold_seconds,
                    threshold)


def down_alert(samples: DataFrame, max_gap_seconds: int = 300, hold_seconds: int | None = None
               ) -> DataFrame:
    return evaluate(series.select(samples, "up"), TARGET_DOWN, F.col("value") == 0,
                    max_gap_seconds, hold_seconds)
