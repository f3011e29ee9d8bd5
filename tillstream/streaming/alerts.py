"""Alert rules on a running stream of samples: the batch form's rows, whatever the batches cut.

Per series the state is one row: the last sample's time and, if that sample breached, since when the
run lasts. It is never given up, so the state grows with the number of series and not with time; no
timer is needed, as a pause is seen at the sample that ends it. Any state store will do, also the
default one. Samples of a series arrive in the order of their times over micro-batches; inside one
they are sorted. A sample that is not newer than the last one of an earlier batch is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillstream.operators import alerts, series
from tillstream.session import ship

RUN = "last long, since long"
OUT = "labels_json string, ts_micros long, value double, since long"


def _runs(max_gap_seconds: int) -> Callable[..., Iterator[pd.DataFrame]]:
    """Breaching samples of a series with the start of their run, in microseconds."""
    gap = max_gap_seconds * 1_000_000

    def follow(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState
               ) -> Iterator[pd.DataFrame]:
        samples = pd.concat(list(rows)).sort_values("ts_micros", kind="stable")
        last, since = state.get if state.exists else (None, None)
        oldest, found = last, []
        for labels, ts, value, breach in zip(
                samples["labels_json"], samples["ts_micros"], samples["value"], samples["breach"],
                strict=True):
            if pd.isna(ts):
                # As in the batch form, a sample without a time belongs to no run.
                if breach:
                    found.append((labels, None, value, None))
                continue
            ts = int(ts)
            if oldest is not None and ts <= oldest:
                continue
            if not breach:
                since = None
            else:
                if since is None or ts - last > gap:
                    since = ts
                found.append((labels, ts, value, since))
            last = ts
        if last is not None:
            state.update((last, since))
        if found:
            yield pd.DataFrame(found, columns=["labels_json", "ts_micros", "value", "since"]).astype(
                {"ts_micros": "Int64", "since": "Int64"})

    return follow


def evaluate(samples: DataFrame, rule: alerts.Rule, breach: Column, max_gap_seconds: int = 300,
             hold_seconds: int | None = None, threshold: float | None = None) -> DataFrame:
    """As `operators.alerts.evaluate`, of a stream of samples (labels, ts, value)."""
    ship(samples.sparkSession)
    # Spark keeps no more than the rows of one series and micro-batch in a group.
    keyed = samples.select(
        series.series_key(F.col("labels")).alias("series"),
        F.to_json("labels").alias("labels_json"), F.unix_micros("ts").alias("ts_micros"),
        F.col("value").cast("double").alias("value"),
        F.coalesce(breach, F.lit(False)).alias("breach"))
    runs = keyed.groupBy("series").applyInPandasWithState(
        _runs(max_gap_seconds), OUT, RUN, "append", GroupStateTimeout.NoTimeout)
    hold = rule.hold_seconds if hold_seconds is None else hold_seconds
    held = F.col("ts_micros") - F.col("since") >= hold * 1_000_000
    rows = runs.select(
        F.from_json("labels_json", "map<string,string>").alias("labels"),
        F.timestamp_micros("ts_micros").alias("ts"), "value",
        F.timestamp_micros("since").alias("active_since"),
        F.when(held, "firing").otherwise("pending").alias("state"))
    return alerts.described(rows, rule, hold, threshold)


def lag_alert(samples: DataFrame, threshold: float = alerts.LAG_THRESHOLD,
              groups: str = alerts.LAG_GROUPS, max_gap_seconds: int = 300,
              hold_seconds: int | None = None) -> DataFrame:
    lags = series.select(samples, "kafka_consumergroup_lag_sum", matching={"consumergroup": groups})
    return evaluate(lags, alerts.CONSUMER_LAG, F.col("value") > threshold, max_gap_seconds,
                    hold_seconds, threshold)


def down_alert(samples: DataFrame, max_gap_seconds: int = 300, hold_seconds: int | None = None
               ) -> DataFrame:
    return evaluate(series.select(samples, "up"), alerts.TARGET_DOWN, F.col("value") == 0,
                    max_gap_seconds, hold_seconds)
