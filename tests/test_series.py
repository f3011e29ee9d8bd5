from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tillstream.operators import alerts, lag, series, timeline
from tillstream.schemas import METRIC_SCHEMA

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def samples(spark, rows):
    """Rows of (metric, labels, seconds, value)."""
    return spark.createDataFrame(
        [(m, labels, START + timedelta(seconds=s), float(v)) for m, labels, s, v in rows],
        METRIC_SCHEMA)


def seconds(ts):
    return int((ts.replace(tzinfo=timezone.utc) - START).total_seconds())


def test_select_by_label(spark):
    rows = samples(spark, [("m", {"a": "x"}, 0, 1), ("m", {"a": "xy"}, 0, 2), ("m", {}, 0, 3),
                           ("n", {"a": "x"}, 0, 4)])
    assert [r.value for r in series.select(rows, "m", {"a": "x"}).collect()] == [1]
    matched = series.select(rows, "m", matching={"a": "x|z"}).collect()
    assert [r.value for r in matched] == [1]


def test_latest_respects_lookback(spark):
    rows = samples(spark, [("m", {"a": "x"}, 0, 1), ("m", {"a": "x"}, 60, 2),
                           ("m", {"a": "x"}, 400, 9), ("m", {"a": "old"}, 0, 3)])
    found = series.latest(rows, "2024-01-01 00:05:10", 300).collect()
    assert [(r.labels, r.value) for r in found] == [({"a": "x"}, 2.0)]


def brute_force_rate(points, width):
    result = {}
    for i, (t, _) in enumerate(points):
        inside = [p for p in points[: i + 1] if p[0] >= t - width]
        rise = sum(b - a if b >= a else b for (_, a), (_, b) in zip(inside, inside[1:]))
        if len(inside) > 1:
            result[t] = rise / (t - inside[0][0])
    return result


def test_rate_across_slices_and_resets(spark, monkeypatch):
    """Slices of 100 seconds: every range of 70 crosses a border now and then."""
    monkeypatch.setattr(timeline.with_lookback, "__defaults__", (100,))
    pick = random.Random(3)
    expected, rows = {}, []
    for name in ("a", "b"):
        total, points, t = 0, [], 0
        for _ in range(120):
            t += pick.choice([5, 10, 10, 45])
            total = pick.randrange(4) if pick.random() < 0.1 else total + pick.randrange(9)
            points.append((t, total))
        rows += [("c", {"s": name}, t, v) for t, v in points]
        expected |= {(name, t): r for t, r in brute_force_rate(points, 70).items()}
    found = {(r.labels["s"], seconds(r.ts)): r.value
             for r in series.rate(samples(spark, rows), 70).collect()}
    assert found == pytest.approx(expected)


def test_sum_average_count_minus(spark):
    rows = samples(spark, [("m", {"a": "x", "b": "1"}, 0, 4), ("m", {"a": "x", "b": "2"}, 0, 2)])
    assert series.total(rows).first().value == 6
    assert series.average(rows, ("a",)).first().asDict()["value"] == 3
    assert series.count(rows).first().value == 2
    other = samples(spark, [("n", {"b": "1", "a": "x"}, 0, 1), ("n", {"a": "z"}, 0, 1)])
    assert [r.value for r in series.minus(rows, other).collect()] == [3.0]
    assert series.busy_percent(samples(spark, [("i", {}, 0, 0.25)])).first().value == 75


def test_steps_line_series_up(spark):
    """Three counters at 1/s each, scraped 7 s apart: 3/s in total at every step."""
    rows = samples(spark, [("c", {"s": str(k)}, t + 7 * k, t + 7 * k)
                           for k in range(3) for t in range(0, 600, 30)])
    found = {seconds(r.ts): r.value
             for r in series.total(series.rate_at_steps(rows, 120, 30)).collect()}
    assert all(found[t] == pytest.approx(3.0) for t in range(90, 600, 30))


def test_values_at_steps(spark):
    rows = samples(spark, [("m", {"a": "x"}, 10, 1), ("m", {"a": "x"}, 55, 2),
                           ("m", {"a": "x"}, 60, 3), ("m", {"a": "x"}, 200, 4)])
    found = sorted((seconds(r.ts), r.value) for r in series.at_steps(rows, 30, 70).collect())
    assert found == [(30, 1.0), (60, 3.0), (90, 3.0), (120, 3.0), (210, 4.0), (240, 4.0)]


def test_rate_at_steps_against_brute_force(spark):
    pick = random.Random(8)
    rows, points, t, total = [], [], 0, 0
    for _ in range(150):
        t += pick.choice([3, 10, 25, 90])
        total = pick.randrange(4) if pick.random() < 0.1 else total + pick.randrange(9)
        points.append((t, total))
    rows = samples(spark, [("c", {}, t, v) for t, v in points])
    expected = {}
    for step in range(0, t + 120, 20):
        inside = [p for p in points if step - 80 < p[0] <= step]
        if len(inside) > 1:
            rise = sum(b - a if b >= a else b for (_, a), (_, b) in zip(inside, inside[1:]))
            expected[step] = rise / (inside[-1][0] - inside[0][0])
    found = {seconds(r.ts): r.value for r in series.rate_at_steps(rows, 80, 20).collect()}
    assert found == pytest.approx(expected)


def test_previous_is_carried_over_slices(spark):
    rows = samples(spark, [("m", {}, s, s) for s in (0, 50, 99, 100, 500, 501)]).withColumn(
        "k", F.lit("k"))
    found = timeline.with_previous(rows, ["k"], "ts", ["value"], seconds=100).orderBy("ts")
    assert [r.previous and r.previous.value for r in found.collect()] == [
        None, 0, 50, 99, 100, 500]


def brute_force_runs(points, gap):
    result, start, before = {}, None, None
    for t, flag in points:
        if flag and (before is None or not before[1] or t - before[0] > gap):
            start = t
        if flag:
            result[t] = start
        before = (t, flag)
    return result


@pytest.mark.parametrize("share", [0.5, 0.97])
def test_run_starts_across_slices(spark, share):
    pick = random.Random(5)
    points, t = [], 0
    for _ in range(200):
        t += pick.choice([10, 10, 10, 40])
        points.append((t, pick.random() < share))
    rows = samples(spark, [("m", {}, t, 1 if f else 0) for t, f in points]).withColumns(
        {"k": F.lit("k"), "flag": F.col("value") > 0})
    found = timeline.with_run_start(rows, ["k"], "ts", "flag", 30, seconds=100).where("flag")
    assert {seconds(r.ts): seconds(r.run_start) for r in found.collect()} == brute_force_runs(
        points, 30)


def test_firing_starts_when_held_long_enough(spark):
    up = [("up", {"job": "kafka", "instance": "a"}, s, 0 if 10 <= s else 1)
          for s in range(0, 200, 10)]
    found = alerts.down_alert(samples(spark, up)).orderBy("ts").collect()
    assert [(seconds(r.ts), r.state) for r in found if seconds(r.ts) in (10, 120, 130)] == [
        (10, "pending"), (120, "pending"), (130, "firing")]
    assert found[0].summary == "kafka target down" and found[0].severity == "critical"


def test_lag_and_dlq_rules(spark):
    groups = [("kafka_consumergroup_lag_sum", {"consumergroup": g, "topic": "t"}, s, 1001)
              for g in ("ingestion-service", "other") for s in range(0, 901, 100)]
    firing = alerts.lag_alert(samples(spark, groups)).where("state = 'firing'").collect()
    assert {r.labels["consumergroup"] for r in firing} == {"ingestion-service"}
    assert min(seconds(r.ts) for r in firing) == 600
    assert firing[0].summary == "ingestion-service lag stuck above 1000 on t"
    assert "above 1000 messages for at least 10 minutes (1001 now)" in firing[0].description
    low = alerts.lag_alert(samples(spark, groups), threshold=85, hold_seconds=90).first()
    assert "above 85 on" in low.summary and "above 85 messages for at least 1.5 minutes" in (
        low.description)
    offsets = [("kafka_topic_partition_current_offset", {"topic": "d", "partition": "0"}, s, s / 5)
               for s in range(0, 901, 60)]
    firing = alerts.dlq_alert(samples(spark, offsets), "d").where("state = 'firing'").collect()
    # Two samples, 60 s apart, give the first rate.
    assert min(seconds(r.ts) for r in firing) == 360
    assert "growing at 0.20 msg/sec" in firing[0].description


def test_consumer_lag_and_trend(spark):
    high = spark.createDataFrame([("t", 0, 10), ("t", 1, 7), ("t", 2, 5), ("t", 3, 4)],
                                 "topic string, partition int, high long")
    committed = spark.createDataFrame([("t", 0, 4), ("t", 1, -1001), ("t", 3, 9)],
                                      "topic string, partition int, committed long")
    lags = lag.consumer_lag(high, committed)
    assert [r["lag"] for r in lags.orderBy("partition").collect()] == [6, 7, 5, 0]
    assert lag.total_lag(lags).first()["lag"] == 18
    history = spark.createDataFrame(
        [("t", 0, START + timedelta(days=d), v) for d, v in enumerate([5, 7, 7, 2])],
        "topic string, partition int, ts timestamp, lag long")
    trend = lag.with_trend(history, ["topic", "partition"]).orderBy("ts").collect()
    assert [r.trend for r in trend] == [" ", "^", "=", "v"]


def test_what_steps_shuffle_does_not_depend_on_the_lookback(spark):
    """Samples are copied to the steps they serve after the last exchange, each step once."""
    import re

    rows = spark.range(2000).select(
        F.lit("m").alias("metric"), F.create_map(F.lit("i"), (F.col("id") % 3).cast("string")).alias(
            "labels"), F.timestamp_seconds(F.col("id") * 37).alias("ts"),
        F.col("id").cast("double").alias("value"))
    for lookback in (60, 86_400):
        steps = series.at_steps(rows, 15, lookback)
        plan = steps._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.index("Generate") < plan.index("Exchange")
        assert len(re.findall("Generate", plan)) == 1
        assert steps.groupBy("series", "ts").count().where("count > 1").isEmpty()
    # A step has the last sample before it, also from the day before.
    at = steps.where("ts = TIMESTAMP '1970-01-01 20:00:00'").collect()
    assert sorted(r.value for r in at) == [1943.0, 1944.0, 1945.0]
