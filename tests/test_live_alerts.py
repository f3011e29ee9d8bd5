"""Alert rules on a stream against the batch form, for several cuts into micro-batches."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from suite.compare import connect, differences
from suite.oracles import ORACLES
from suite.queries import QUERIES
from tillstream.operators import alerts
from tillstream.streaming import alerts as live

SF_DIR = "/root/testdata/sf0.001"

SCHEMA = "metric string, labels map<string,string>, ts timestamp, value double"


def samples(spark, rows):
    """Rows of (group, second, value)."""
    frame = spark.createDataFrame(
        [("kafka_consumergroup_lag_sum", {"consumergroup": g, "topic": "t"}, s, float(v))
         for g, s, v in rows], "metric string, labels map<string,string>, s long, value double")
    return frame.select("metric", "labels", F.timestamp_seconds("s").alias("ts"), "value")


def some_rows(seed=1):
    rng = random.Random(seed)
    rows = []
    for group in ("ingestion-service", "retry-service", "other"):
        second = 0
        for _ in range(120):
            second += rng.choice([15, 15, 30, 400])
            rows.append((group, second, rng.choice([500, 1500, 1500, 1500])))
    return sorted(rows, key=lambda r: r[1])


def stream(spark, folder, parts, rule=live.lag_alert, **options):
    for i, part in enumerate(parts):
        samples(spark, part).coalesce(1).write.mode("append").parquet(str(folder / "in"))
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(
            str(folder / "in"))
        # A new run for every part: the state outlives the query.
        rows = rule(source, **options)
        rows.withColumn("part", F.lit(i)).writeStream.format("parquet").option(
            "path", str(folder / "out")).option("checkpointLocation", str(folder / "o")).trigger(
            availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(str(folder / "out"))


def as_set(rows):
    return sorted(map(str, rows.withColumn("labels", F.to_json("labels")).collect()))


@pytest.mark.parametrize("cuts", [[], [7], [100, 101, 250]])
def test_the_same_rows_however_the_batches_cut(spark, tmp_path, cuts):
    rows = some_rows()
    borders = [0, *cuts, len(rows)]
    # Samples of one time must not be torn apart.
    parts = [rows[a:b] for a, b in zip(borders, borders[1:])]
    options = {"threshold": 1000, "hold_seconds": 60}
    expected = alerts.lag_alert(samples(spark, rows), **options)
    assert as_set(stream(spark, tmp_path, parts, **options)) == as_set(expected)
    assert {r.state for r in expected.collect()} == {"pending", "firing"}


def test_late_samples_are_left_out_and_nulls_do_not_breach(spark, tmp_path):
    group = "ingestion-service"
    parts = [[(group, 100, 2000)], [(group, 90, 2000), (group, 100, 2000), (group, 130, 2000)]]
    found = stream(spark, tmp_path, parts, hold_seconds=30).orderBy("ts").collect()
    assert [(r.ts.second, r.state) for r in found] == [(40, "pending"), (10, "firing")]
    assert found[1].active_since == found[0].ts and "above 1000" in found[1].description


@pytest.fixture
def plain(spark):
    """A session with the state store that Spark takes when nothing is set."""
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass",
                     "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    return session


def test_any_state_store_will_do(plain, tmp_path):
    rows = some_rows(2)
    options = {"threshold": 1000, "hold_seconds": 60}
    expected = alerts.lag_alert(samples(plain, rows), **options)
    assert as_set(stream(plain, tmp_path, [rows[:130], rows[130:]], **options)) == as_set(expected)


def test_the_query_needs_no_setting(plain):
    assert differences(QUERIES["stream_alerts"](plain, SF_DIR),
                       connect(SF_DIR).execute(ORACLES["stream_alerts"])) == []


def test_samples_without_a_time_stand_alone(plain, tmp_path):
    group = "ingestion-service"
    parts = [[(group, 100, 2000), (group, None, 2000)], [(group, None, 500), (group, 130, 2000)]]
    options = {"hold_seconds": 30}
    expected = alerts.lag_alert(samples(plain, sum(parts, [])), **options)
    assert as_set(stream(plain, tmp_path, parts, **options)) == as_set(expected)
    assert expected.where("ts IS NULL AND active_since IS NULL AND state = 'pending'").count() == 1
