from __future__ import annotations

import random

from pyspark.sql import functions as F

from tillstream.operators import dedup


def brute_force_anchors(times, ttl):
    kept = {}
    for key in {k for k, _ in times}:
        last = None
        for t in sorted(t for k, t in times if k == key):
            if last is None or t - last > ttl:
                kept.setdefault(key, []).append(t)
                last = t
    return {(k, t) for k, ts in kept.items() for t in ts}


def sightings(spark, times):
    return spark.createDataFrame(times, "event_id string, s long").select(
        "event_id", F.timestamp_seconds("s").alias("timestamp"),
        F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"))


def anchors(frame, ttl, fold_limit):
    rows = dedup.ttl_anchors(frame, ttl, fold_limit=fold_limit).collect()
    assert len(rows) == len(set(rows))
    return {(r.event_id, r["at"] // 1_000_000) for r in rows}


def test_hits_do_not_refresh_the_anchor(spark):
    times = [("a", t) for t in (0, 200, 350, 640, 700)]
    assert anchors(sightings(spark, times), 300, 1024) == {("a", 0), ("a", 350), ("a", 700)}


def test_exactly_the_time_to_live_is_still_a_duplicate(spark):
    assert anchors(sightings(spark, [("a", 0), ("a", 300), ("a", 301)]), 300, 1024) == {
        ("a", 0), ("a", 301)}


def test_both_ways_agree_with_brute_force(spark):
    """A third of all rows are one id; a low limit sends that one down the join way."""
    pick = random.Random(1)
    times = [("hot" if pick.random() < 0.34 else f"k{pick.randrange(12)}",
              pick.choice([-5_000, 0, 40_000]) + pick.randrange(6_000)) for _ in range(900)]
    expected = brute_force_anchors(times, 70)
    frame = sightings(spark, times).cache()
    for limit in (1024, 100):
        assert anchors(frame, 70, limit) == expected


def test_drop_recent_keeps_first_of_equal_times(spark):
    frame = sightings(spark, [("a", 5), ("a", 5), ("a", 400), ("b", 5)]).coalesce(1).cache()
    kept = dedup.drop_recent(frame).collect()
    assert sorted((r.event_id, r.timestamp.second) for r in kept) == [
        ("a", 5), ("a", 40), ("b", 5)]
    first = min(r.offset for r in frame.where("event_id = 'a'").collect())
    assert first in {r.offset for r in kept}


def test_first_wins(spark):
    rows = spark.createDataFrame(
        [("a", 1, 5, "late"), ("a", 0, 9, "first"), ("b", 0, 1, "only")],
        "event_id string, kafka_partition int, kafka_offset long, note string")
    assert {r.note for r in dedup.first_wins(rows).collect()} == {"first", "only"}


def test_ties_have_a_fixed_winner(spark):
    rows = [("a", 0, 5, note) for note in "qwertz"]
    schema = "event_id string, kafka_partition int, kafka_offset long, note string"
    winners = {dedup.first_wins(spark.createDataFrame(order, schema)).first().note
               for order in (rows, rows[::-1], rows[3:] + rows[:3])}
    assert len(winners) == 1


def test_long_histories_in_small_slices(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SLICE_SPANS", 3)
    pick = random.Random(4)
    times = [("hot", pick.choice([0, 900, 40_000]) + pick.randrange(3_000)) for _ in range(300)]
    assert anchors(sightings(spark, times), 70, 10) == brute_force_anchors(times, 70)


def test_copies_are_dropped_before_the_shuffle(spark):
    rows = spark.range(10).select(
        (F.col("id") % 3).cast("string").alias("event_id"),
        (F.col("id") % 2).cast("int").alias("kafka_partition"),
        F.col("id").alias("kafka_offset"))
    plan = dedup.first_wins(rows)._jdf.queryExecution().sparkPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_surplus_and_new_rows(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,)], "event_id string")
    assert dedup.surplus_copies(rows).first().asDict() == {
        "total_rows": 4, "distinct_ids": 2, "repeated_ids": 1, "surplus_copies": 2}
    stored = spark.createDataFrame([("a",)], "event_id string")
    assert [r.event_id for r in dedup.new_rows(rows.na.drop(), stored).collect()] == ["b"]
