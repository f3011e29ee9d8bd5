"""Sketches per day against the exact figures, and digests against full comparison."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from suite import fixtures as fx
from tillstream.plans import business, rollups, snapshot

YEAR = (date(2020, 1, 1), date(2029, 12, 31))


def shop(spark, users, days, rows):
    return spark.range(rows).select(
        F.concat(F.lit("u"), (F.col("id") * 7919 % users).cast("string")).alias("user_id"),
        (F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") % days * 86_400)).alias(
            "event_timestamp"), (F.col("id") * 31 % 977).alias("late")).withColumn(
        "ingested_at", F.col("event_timestamp") + F.make_dt_interval(secs=F.col("late")))


def test_distinct_users_of_a_year(spark, tmp_path):
    events = shop(spark, 30_000, 365, 200_000)
    path = str(tmp_path / "sketches")
    rollups.daily_sketches(events).write.parquet(path)
    row = rollups.active_users(rollups.between(spark.read.parquet(path), *YEAR)).first()
    exact = business.active_users(events).first().active_users
    assert row.days == 365
    assert abs(row.active_users - exact) <= rollups.USERS_ERROR * exact


def test_latency_ranks_of_a_year(spark):
    events = shop(spark, 100, 365, 100_000)
    sketches = rollups.daily_sketches(events)
    row = rollups.processing_latency(sketches).first()
    assert (row.events, row.max_seconds) == (100_000, 976)
    for p in (50, 95, 99):
        value = row[f"p{p}_seconds"]
        below, upto = events.agg(F.avg((F.col("late") < value).cast("int")),
                                 F.avg((F.col("late") <= value).cast("int"))).first()
        assert below - rollups.RANK_ERROR <= p / 100 <= upto + rollups.RANK_ERROR


def test_days_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "sketches")
    events = shop(spark, 50, 3, 300)
    first = events.agg(F.min(F.col("event_timestamp").cast("date"))).first()[0]
    rollups.refresh_sketches(events, path, *YEAR)
    doubled = events.unionByName(events)
    rollups.refresh_sketches(doubled, path, first, first)
    found = spark.read.parquet(path).orderBy("day").collect()
    assert [r.events for r in found] == [200, 100, 100]


def test_nulls_and_empty_days(spark):
    rows = [(None, "2020-01-01 00:00:00", None), ("a", "2020-01-02 00:00:00", "2020-01-02 00:00:09")]
    events = spark.createDataFrame(rows, "user_id string, t string, i string").select(
        "user_id", F.col("t").cast("timestamp").alias("event_timestamp"),
        F.col("i").cast("timestamp").alias("ingested_at"))
    sketches = rollups.daily_sketches(events)
    assert rollups.active_users(sketches).first().asDict() == {"days": 2, "active_users": 1}
    assert rollups.active_users(sketches.where("false")).first().active_users == 0
    row = rollups.processing_latency(sketches).first()
    assert (row.events, row.p50_seconds, row.p99_seconds) == (1, 9, 9)
    assert rollups.processing_latency(sketches.where("timed = 0")).first().p50_seconds is None


@pytest.fixture
def events(spark):
    return fx.raw_events(spark, "/root/testdata/sf0.001")


def test_equal_snapshots_are_told_without_a_shuffle_of_rows(spark, events, tmp_path):
    events.repartition(3).write.parquet(str(tmp_path / "a"))
    other = spark.read.parquet(str(tmp_path / "a")).select(*reversed(events.columns))
    assert snapshot.differing_partitions(events, other, "event_date").isEmpty()
    assert snapshot.difference_by_partition(events, other, "event_date").isEmpty()
    plan = snapshot.differing_partitions(events, other, "event_date")._jdf.queryExecution(
        ).executedPlan().toString()
    assert "partial_sum" in plan and "SortMergeJoin" not in plan


def test_only_changed_partitions_are_compared(spark, events):
    days = [r[0] for r in events.select("event_date").distinct().orderBy("event_date").collect()]
    changed = events.withColumn("quantity", F.when(
        (F.col("event_date") == days[1]) & (F.col("event_type") == "PURCHASE"),
        F.col("quantity") + 1).otherwise(F.col("quantity"))).where(F.col("event_date") != days[2])
    found = {r[0] for r in snapshot.differing_partitions(events, changed, "event_date").collect()}
    assert found == {days[1], days[2]}
    whole, parted = (sorted(map(str, f.collect())) for f in (
        snapshot.difference(events, changed),
        snapshot.difference_by_partition(events, changed, "event_date")))
    assert whole == parted and whole


def test_digests_tell_nulls_copies_and_swapped_values_apart(spark):
    def rows(*values):
        return spark.createDataFrame(list(values), "p int, a string, b string")

    one = rows((1, "x", None), (None, "y", "z"))
    for other in (rows((1, None, "x"), (None, "y", "z")), rows((1, "x", None)),
                  rows((1, "x", None), (1, "x", None), (None, "y", "z")),
                  rows((1, "x", None), (None, "z", "y"))):
        assert not snapshot.difference_by_partition(one, other, "p").isEmpty()
    assert snapshot.difference_by_partition(one, rows((None, "y", "z"), (1, "x", None)), "p").isEmpty()
