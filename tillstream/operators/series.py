"""Metric samples as a table `metric, labels, ts, value`: selecting, rates, sums, arithmetic.

A series is a metric with one set of labels; it has one sample per time.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.operators import timeline


def series_key(labels: Column) -> Column:
    """Labels as canonical text, usable as a grouping key."""
    return F.to_json(F.array_sort(F.map_entries(labels)))


def select(
    samples: DataFrame, metric: str | None = None, equal: dict[str, str] | None = None,
    matching: dict[str, str] | None = None,
) -> DataFrame:
    """Samples of a metric by label: equal to a text, or fully matching a regular expression."""
    rows = samples if metric is None else samples.where(F.col("metric") == metric)
    for name, value in (equal or {}).items():
        rows = rows.where(F.coalesce(F.col("labels")[name], F.lit("")) == value)
    for name, pattern in (matching or {}).items():
        rows = rows.where(F.coalesce(F.col("labels")[name], F.lit("")).rlike(rf"^(?:{pattern})\z"))
    return rows


def latest(samples: DataFrame, at: datetime | str, lookback_seconds: int = 300) -> DataFrame:
    """The last value of each series at a time, unless it is older than the lookback."""
    moment = F.lit(str(at)).cast("timestamp")
    oldest = moment - F.make_dt_interval(secs=F.lit(lookback_seconds))
    recent = samples.where((F.col("ts") <= moment) & (F.col("ts") > oldest))
    return recent.groupBy("metric", series_key(F.col("labels")).alias("series")).agg(
        F.max_by("labels", "ts").alias("labels"), F.max_by("value", "ts").alias("value"),
        F.max("ts").alias("ts"))


def rate(samples: DataFrame, range_seconds: int) -> DataFrame:
    """Increase per second of each counter over the trailing range, at each of its samples.

    The increase between the first and last sample in the range (both ends included) is divided
    by the time between them; a drop means the counter restarted from zero. Nothing is
    extrapolated to the range's borders. Ranges with a single sample give no row.
    """
    rows = timeline.with_lookback(
        samples.withColumn("series", series_key(F.col("labels"))), "ts", range_seconds)
    by_series = ["metric", "series", "slice"]
    ordered = Window.partitionBy(*by_series).orderBy("at")
    before = F.lag("value").over(ordered)
    step = F.when(F.col("value") >= before, F.col("value") - before).otherwise(
        F.when(before.isNotNull(), F.col("value")).otherwise(F.lit(0.0)))
    rows = rows.withColumn("at", F.unix_micros("ts")).withColumn("step", step)
    rows = rows.withColumn("total", F.sum("step").over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    trailing = ordered.rangeBetween(-range_seconds * 1_000_000, Window.currentRow)
    rows = rows.withColumn("start", F.first(F.struct("at", "total")).over(trailing))
    seconds = (F.col("at") - F.col("start.at")) / F.lit(1_000_000)
    return rows.where(~F.col("borrowed") & (F.col("at") > F.col("start.at"))).select(
        "metric", "series", "labels", "ts",
        ((F.col("total") - F.col("start.total")) / seconds).alias("value"))


def _step_of(ts: str, step_seconds: int) -> Column:
    """Microseconds of the first step at or after a time."""
    step = step_seconds * 1_000_000
    return (F.ceil(F.unix_micros(ts) / F.lit(step)) * step).cast("long")


def at_steps(samples: DataFrame, step_seconds: int, lookback_seconds: int = 300) -> DataFrame:
    """The value of each series at every step: its last sample, unless older than the lookback.

    Steps are multiples of `step_seconds`, the same for all series, so that sums and differences
    of series sampled at different times line up. Only the last sample before a step counts; it
    serves the steps until the next one does, or the lookback ends, and is copied to these when
    nothing is shuffled any more: what is shuffled does not depend on the lookback.
    """
    step = step_seconds * 1_000_000
    last = samples.withColumn("series", series_key(F.col("labels"))).groupBy(
        "metric", "series", _step_of("ts", step_seconds).alias("first")).agg(
        F.max_by("labels", "ts").alias("labels"), F.max_by("value", "ts").alias("value"),
        F.max(F.unix_micros("ts")).alias("at"))
    reach = F.col("at") + lookback_seconds * 1_000_000 - 1
    followed = timeline.with_next(last, ["metric", "series"], "first")
    until = F.least(reach, F.col("next") - step)
    served = followed.withColumn("until", until).where("first <= until").withColumn(
        "step", F.explode(F.sequence("first", "until", F.lit(step).cast("long"))))
    return served.select(
        "metric", "series", "labels", F.timestamp_micros("step").alias("ts"), "value")


def rate_at_steps(samples: DataFrame, range_seconds: int, step_seconds: int) -> DataFrame:
    """Increase per second of each counter at every step, over the samples of the range before it.

    As `rate`, but at times that all series share; the range is open at its start and a multiple
    of the step. Samples are folded to one row per series and step before ranges are taken.
    """
    if range_seconds % step_seconds:
        raise ValueError("the range must be a multiple of the step")
    step, reach = step_seconds * 1_000_000, (range_seconds - step_seconds) * 1_000_000
    rows = timeline.with_previous(
        samples.withColumn("series", series_key(F.col("labels"))), ["metric", "series"], "ts",
        ["value"])
    before = F.col("previous.value")
    rise = F.when(before.isNull(), F.lit(0.0)).when(
        F.col("value") >= before, F.col("value") - before).otherwise(F.col("value"))
    folded = rows.withColumn("rise", rise).groupBy(
        "metric", "series", _step_of("ts", step_seconds).alias("own")).agg(
        F.max_by("labels", "ts").alias("labels"), F.sum("rise").alias("rise"),
        F.min_by("rise", "ts").alias("first_rise"),
        F.min(F.unix_micros("ts")).alias("first_at"), F.max(F.unix_micros("ts")).alias("last_at"))
    served = folded.withColumn("step", F.explode(F.sequence(
        "own", F.col("own") + reach, F.lit(step).cast("long"))))
    # What the earliest sample rose lies before the range.
    rates = served.groupBy("metric", "series", "step").agg(
        F.max_by("labels", "last_at").alias("labels"),
        (F.sum("rise") - F.min_by("first_rise", "first_at")).alias("rise"),
        ((F.max("last_at") - F.min("first_at")) / F.lit(1_000_000)).alias("seconds"))
    return rates.where("seconds > 0").select(
        "metric", "series", "labels", F.timestamp_micros("step").alias("ts"),
        (F.col("rise") / F.col("seconds")).alias("value"))


def _aggregate(samples: DataFrame, value: Column, by: tuple[str, ...]) -> DataFrame:
    names = [F.col("labels")[name].alias(name) for name in by]
    return samples.groupBy("ts", *names).agg(value.alias("value"))


def total(samples: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return _aggregate(samples, F.sum("value"), by)


def average(samples: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return _aggregate(samples, F.avg("value"), by)


def count(samples: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return _aggregate(samples, F.count("*"), by)


def minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Difference of two metrics for equal labels and times."""
    a = left.select(series_key(F.col("labels")).alias("series"), "labels", "ts", "value")
    b = right.select(series_key(F.col("labels")).alias("series"), "ts", F.col("value").alias("other"))
    return a.join(b, ["series", "ts"]).select(
        "labels", "ts", (F.col("value") - F.col("other")).alias("value"))


def busy_percent(idle_rate: DataFrame) -> DataFrame:
    """100 - 100 * average idle rate, per time."""
    return average(idle_rate).withColumn("value", 100 - F.col("value") * 100)
