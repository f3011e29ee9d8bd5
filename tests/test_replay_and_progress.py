"""Letters sent to the retry topic, and the lag of a running job."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tillstream.operators import lag
from tillstream.plans import business
from tillstream.settings import Settings
from tillstream.sinks import messages as sink
from tillstream.sinks.event_store import EventStore
from tillstream.sources.messages import file_stream
from tillstream.streaming import ingest, progress, replay

FAST = Settings(write_attempts=1, write_backoff_seconds=0.0)


def publish(frame, path):
    frame.coalesce(1).write.mode("append").parquet(str(path))


def test_letters_go_to_the_retry_topic_and_land(spark, tmp_path, messages, event):
    publish(messages([event(event_id="late", quantity="x"), "{broken"]), tmp_path / "in")
    store = EventStore(spark, str(tmp_path / "store"))
    ingest.drain(file_stream(spark, str(tmp_path / "in")), store, str(tmp_path / "o"), FAST)

    def to_retry(rows):
        return sink.write_files(rows.select(
            "key", "value", F.lit("retry").alias("topic"), F.lit(0).alias("partition"),
            F.monotonically_increasing_id().alias("offset"),
            F.lit(None).cast("timestamp").alias("timestamp")), str(tmp_path / "retry"))

    fixed = F.lit(json.dumps(event(event_id="late", quantity=3)))
    letters = store.dead_letters()
    assert replay.send(letters, to_retry, where=F.col("reason") == "VALIDATION_FAILED",
                       corrected=fixed) == 1
    assert replay.send(letters.withColumn("retry_count", F.lit(3)), to_retry) == 0
    assert replay.send(letters, to_retry, dlq_id="none such") == 0
    stream = ingest.with_retries(file_stream(spark, str(tmp_path / "in")),
                                 file_stream(spark, str(tmp_path / "retry")))
    ingest.drain(stream, store, str(tmp_path / "o2"), FAST)
    assert [(r.event_id, r.quantity) for r in store.events().collect()] == [("late", 3)]


def test_lag_of_a_stopped_job_equals_the_files_left(spark, tmp_path, messages, event):
    for i in range(5):
        publish(messages([event(event_id=f"e{i}")], first_offset=i), tmp_path / "in")
    store = EventStore(spark, str(tmp_path / "store"))
    seen = []

    def stop_after_two(batch_id, _):
        seen.append(batch_id)
        if len(seen) == 3:
            raise OSError("cut off")

    with store, pytest.raises(Exception, match="cut off"):
        ingest.start(file_stream(spark, str(tmp_path / "in"), 1), store, str(tmp_path / "o"), FAST,
                     until_drained=True, on_batch=stop_after_two).awaitTermination()
    offsets = progress.file_offsets(spark, str(tmp_path / "in"), str(tmp_path / "o"), "shop")
    found = lag.consumer_lag(offsets.drop("committed"), offsets.drop("high")).first()
    assert (found.high, found.committed, found.lag) == (5, 2, 3)


def test_offsets_of_topic_sources(spark):
    report = {"timestamp": "2024-01-15T10:00:00.000Z", "sources": [
        {"endOffset": '{"shop": {"0": 5, "1": 7}}', "latestOffset": '{"shop": {"0": 9, "1": 7, "2": 4}}'},
        {"endOffset": {"retry": {"0": 3}}, "latestOffset": None},
        {"endOffset": {"logOffset": 4}, "latestOffset": None}]}
    offsets = progress.topic_offsets(spark, [report])
    lags = lag.consumer_lag(offsets.drop("committed"), offsets.drop("high")).collect()
    assert {(r.topic, r.partition): r.lag for r in lags} == {
        ("shop", 0): 4, ("shop", 1): 0, ("shop", 2): 4, ("retry", 0): 0}
    sums = progress.lag_samples(offsets, "ingestion-service").where(
        "metric = 'kafka_consumergroup_lag_sum'").collect()
    assert {(r.labels["topic"], r.value) for r in sums} == {("shop", 8.0), ("retry", 0.0)}


def test_lookup_reaches_the_scan(spark, tmp_path, messages, event):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("ab", 3)], "event_id string, n int")
    rows.write.parquet(str(tmp_path / "t"))
    found = business.by_id(spark.read.parquet(str(tmp_path / "t")), "a", "ab")
    assert sorted(r.n for r in found.collect()) == [1, 3]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(event_id" in plan
