from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tillstream.operators import deadletter, dedup
from tillstream.operators.classify import classify, valid_events
from tillstream.settings import Settings
from tillstream.sinks.event_store import EventStore, with_retry
from tillstream.sources.messages import file_batch, file_stream
from tillstream.streaming import ingest
from tillstream.streaming import sales as sales_stream

FAST = Settings(write_attempts=2, write_backoff_seconds=0.0)


@pytest.fixture(autouse=True)
def closed_stores(monkeypatch):
    """Ends the streams of all stores that a test opened."""
    opened, init = [], EventStore.__init__

    def watched(self, *args):
        opened.append(self)
        init(self, *args)

    monkeypatch.setattr(EventStore, "__init__", watched)
    yield
    for store in opened:
        store.close()


def store_at(spark, path):
    return EventStore(spark, str(path))


def run(spark, source, store, offsets, on_batch=None, settings=FAST, retry=None, max_files=1):
    stream = file_stream(spark, str(source), max_files)
    if retry:
        stream = ingest.with_retries(stream, file_stream(spark, str(retry)))
    ingest.drain(stream, store, str(offsets), settings, on_batch)


def publish(frame, path):
    frame.coalesce(1).write.mode("append").parquet(str(path))


def test_end_to_end(spark, tmp_path, messages, event):
    """Two good events, one sent again, one broken: two rows and one dead letter."""
    publish(messages([event(event_id="v1"), event(event_id="v2"), event(event_id="v1"),
                      event(event_id="b", quantity="NOT_A_NUMBER")]), tmp_path / "in")
    counts = []
    store = store_at(spark, tmp_path / "store")
    run(spark, tmp_path / "in", store, tmp_path / "offsets", lambda _, c: counts.append(c))
    assert sorted(r.event_id for r in store.events().collect()) == ["v1", "v2"]
    letter = store.dead_letters().first()
    assert (letter.reason, letter.errors, letter.retry_count, letter.key) == (
        "VALIDATION_FAILED", ["invalid quantity: 'NOT_A_NUMBER'"], 0, "user_1")
    assert counts == [
        {"consumed": 4, "skipped": 0, "invalid": 1, "inserted": 2, "duplicates": 1,
         "batch_duplicates": 1, "table_duplicates": 0}]


def test_counters_of_batches_without_valid_rows(spark, tmp_path, messages, event):
    """Only broken messages, only copies, copies of both kinds: one set of counters each."""
    for offset, payloads in enumerate([["{", "["], [event(event_id="a")] * 2,
                                       [event(event_id="a")] * 2 + [event(event_id="b")] * 3]):
        publish(messages(payloads, first_offset=10 * offset), tmp_path / "in")
        counts = []
        store = store_at(spark, tmp_path / "store")
        run(spark, tmp_path / "in", store, tmp_path / "offsets", lambda _, c: counts.append(c))
        assert len(counts) == 1
        figures = [counts[0][k] for k in ("consumed", "invalid", "inserted", "batch_duplicates",
                                          "table_duplicates")]
        assert figures == [[2, 2, 0, 0, 0], [2, 0, 1, 1, 0], [5, 0, 1, 3, 1]][offset]


def test_shuffled_copies(spark, tmp_path, messages, event):
    """40 ids, 5 copies each, over several batches: 40 rows."""
    ids = [f"d{i}" for i in range(40)] * 5
    random.Random(7).shuffle(ids)
    for part in range(4):
        publish(messages([event(event_id=i) for i in ids[part::4]], first_offset=100 * part),
                tmp_path / "in")
    store = store_at(spark, tmp_path / "store")
    run(spark, tmp_path / "in", store, tmp_path / "offsets")
    assert dedup.surplus_copies(store.events()).first().asDict() == {
        "total_rows": 40, "distinct_ids": 40, "repeated_ids": 0, "surplus_copies": 0}


@pytest.mark.parametrize("broken", ["_add_candidates", "_add_events", "add_dead_letters"])
def test_restart_after_a_cut_off_batch(spark, tmp_path, messages, event, monkeypatch, broken):
    """The stream dies at one of its writes; a restart loses and repeats nothing."""
    publish(messages([event(event_id=f"e{i}", user_id=f"user_{i % 5}") for i in range(150)]
                     + ["{broken"]), tmp_path / "in")
    store = store_at(spark, tmp_path / "store")

    def fail(_):
        raise OSError("disk gone")

    monkeypatch.setattr(store, broken, fail)
    with pytest.raises(Exception, match="disk gone"):
        run(spark, tmp_path / "in", store, tmp_path / "offsets")
    assert store.events().count() == (150 if broken == "add_dead_letters" else 0)
    monkeypatch.undo()
    store = store_at(spark, tmp_path / "store")
    run(spark, tmp_path / "in", store, tmp_path / "offsets")
    assert store.events().count() == 150
    assert store.events().select("event_id").distinct().count() == 150
    assert store.dead_letters().count() == 1


def test_batch_cut_off_while_it_was_added(spark, tmp_path, messages, event, monkeypatch):
    """Some rows are in the events, the stream did not get to commit: only the rest is added."""
    batch = valid_events(classify(messages([event(event_id="a"), event(event_id="b")])))
    store = store_at(spark, tmp_path / "store")
    add = EventStore._add_events

    def half(self, rows):
        add(self, rows.where("event_id = 'a'"))
        raise OSError("disk gone")

    monkeypatch.setattr(EventStore, "_add_events", half)
    with pytest.raises(Exception, match="disk gone"):
        store.insert(batch)
    monkeypatch.undo()
    assert store_at(spark, tmp_path / "store").insert(batch) == 1
    assert sorted(r.event_id for r in store.events().collect()) == ["a", "b"]


def test_same_store_after_a_failed_write(spark, tmp_path, messages, event, monkeypatch):
    batch = valid_events(classify(messages([event(event_id="a"), event(event_id="b")])))
    store = store_at(spark, tmp_path / "store")
    monkeypatch.setattr(EventStore, "_add_events", lambda *_: 1 / 0)
    with pytest.raises(Exception, match="division by zero"):
        store.insert(batch)
    monkeypatch.undo()
    assert store.insert_with_retry(batch, 1, 0.0) == 2
    assert store.insert_with_retry(batch, 1, 0.0) == 0
    assert store.events().count() == 2


def test_lost_state_is_filled_from_the_events(spark, tmp_path, messages, event):
    import shutil

    store = store_at(spark, tmp_path / "store")
    rows = valid_events(classify(messages([event(event_id=i) for i in "abc"])))
    assert store.insert(rows) == 3
    shutil.rmtree(store.state_path)
    later = valid_events(classify(messages([
        event(event_id=i, timestamp="2025-01-01T00:00:00Z") for i in "bcd"])))
    assert store_at(spark, tmp_path / "store").insert(later) == 1
    assert sorted(r.event_id for r in store.events().collect()) == list("abcd")


def test_cost_follows_the_batch(spark, tmp_path, messages, event, monkeypatch):
    """The twentieth batch reads as many rows as the second, and none of the events."""
    store = store_at(spark, tmp_path / "store")
    store.insert(valid_events(classify(messages([event(event_id="first")]))))
    read = []
    monkeypatch.setattr(store, "events", lambda: 1 / 0)  # called only when the stream starts
    append = store._append

    def watch(fresh):
        read.append(store.spark.read.parquet(store.candidates_path).count())
        return append(fresh)

    monkeypatch.setattr(store, "_append", watch)
    for batch in range(2, 21):
        rows = messages([event(event_id=f"e{batch}-{i}") for i in range(30)])
        assert store.insert(valid_events(classify(rows))) == 30
    # Candidates of the batch before are deleted while the next one runs.
    assert read[0] <= 31 and max(read) <= 60


def test_lost_checkpoint(spark, tmp_path, messages, event):
    publish(messages([event(event_id=f"e{i}") for i in range(20)]), tmp_path / "in")
    store = store_at(spark, tmp_path / "store")
    run(spark, tmp_path / "in", store, tmp_path / "offsets")
    run(spark, tmp_path / "in", store, tmp_path / "other_offsets")
    assert store.events().count() == 20


def test_insert_twice(spark, tmp_path, messages, event):
    store = store_at(spark, tmp_path / "store")
    rows = valid_events(classify(messages([event(event_id="x")])))
    again = valid_events(classify(messages([event(event_id="y")])))
    assert [store.insert(rows), store.insert(rows), store.insert(again)] == [1, 0, 1]


def test_gives_up_loudly_and_commits_nothing(spark, tmp_path, messages, event, monkeypatch):
    publish(messages([event()]), tmp_path / "in")
    store = store_at(spark, tmp_path / "store")
    tries = []

    def fail(_):
        tries.append(1)
        raise OSError("store is down")

    monkeypatch.setattr(store, "insert", fail)
    with pytest.raises(Exception, match="store is down"):
        run(spark, tmp_path / "in", store, tmp_path / "offsets")
    assert len(tries) == 2
    monkeypatch.undo()
    run(spark, tmp_path / "in", store, tmp_path / "offsets")
    assert store.events().count() == 1


def test_retry_helper():
    calls = []

    def sometimes():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("not yet")
        return "done"

    assert with_retry(sometimes, 5, 0.0) == "done" and len(calls) == 3


def test_dead_letter_round_trip(spark, tmp_path, messages, event):
    """Two rejects are replayed and fail again; the corrected payload lands exactly once."""
    publish(messages([event(event_id="late", quantity="x"), '{"not-valid-json-']),
            tmp_path / "in")
    store = store_at(spark, tmp_path / "store")
    run(spark, tmp_path / "in", store, tmp_path / "offsets")
    letters = store.dead_letters()
    assert sorted(r.retry_count for r in letters.collect()) == [0, 0]

    replay = deadletter.dlq_messages(deadletter.select_replay(letters, skip_exhausted=True))
    corrected = letters.where("reason = 'VALIDATION_FAILED'").withColumn(
        "raw_payload", F.lit(json.dumps(event(event_id="late", quantity=3))))
    replay = replay.unionByName(deadletter.dlq_messages(corrected)).unionByName(
        spark.createDataFrame([(None, b"not json")], "key binary, value binary"))
    retry = replay.select(
        "key", "value", F.lit("retry").alias("topic"), F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"))
    publish(retry, tmp_path / "retry")
    run(spark, tmp_path / "in", store, tmp_path / "offsets2", retry=tmp_path / "retry")
    stored = store.events().collect()
    assert [(r.event_id, r.quantity, r.kafka_offset) for r in stored] == [("late", 3, 0)]
    again = store.dead_letters().where("retry_count = 1").collect()
    assert sorted(r.reason for r in again) == ["UNPARSEABLE", "VALIDATION_FAILED"]
    assert {r.original_topic for r in again} == {"shop"}


def test_retry_path_of_a_running_job(spark, tmp_path, messages, event):
    """Records, corrections and non-records: letters stay apart, go out, and junk is counted."""
    publish(messages([event(event_id="x", quantity="x")]), tmp_path / "in")
    store = store_at(spark, tmp_path / "store")
    run(spark, tmp_path / "in", store, tmp_path / "offsets")
    letter = store.dead_letters().withColumn("retry_count", F.lit(2))
    replay = [deadletter.dlq_messages(letter.withColumn("raw_payload", F.lit(p)))
              for p in ("{broken", "{also broken", json.dumps(event(event_id="x")))]
    nowhere = spark.createDataFrame([(None, json.dumps({"raw_payload": f"{{{i}"}).encode())
                                     for i in range(5)], "key binary, value binary")
    junk = spark.createDataFrame([(None, b"junk"), (None, b"[1]")], "key binary, value binary")
    rows = replay[0].unionByName(replay[1]).unionByName(replay[2]).unionByName(nowhere).unionByName(
        junk).select("key", "value", F.lit("retry").alias("topic"), F.lit(0).alias("partition"),
                     F.monotonically_increasing_id().alias("offset"),
                     F.lit(None).cast("timestamp").alias("timestamp"))
    publish(rows, tmp_path / "retry")
    counts, sent = [], []
    stream = ingest.with_retries(file_stream(spark, str(tmp_path / "in")),
                                 file_stream(spark, str(tmp_path / "retry")))
    ingest.drain(stream, store, str(tmp_path / "offsets2"), FAST,
                 on_batch=lambda _, c: counts.append(c), publish=lambda m: sent.append(m.count()))
    assert sum(c["skipped"] for c in counts) == 2
    assert [r.event_id for r in store.events().collect()] == ["x"]
    again = store.dead_letters().where("retry_count > 0").collect()
    assert sorted((r.retry_count, r.severity) for r in again) == (
        [(1, "WARNING")] * 5 + [(3, "CRITICAL")] * 2)
    assert sum(sent) == 8  # with the first failure, which was read again


def test_stop_lets_the_batch_end(spark, tmp_path, messages, event):
    publish(messages([event()]), tmp_path / "in")
    store = store_at(spark, tmp_path / "store")
    ended = []
    query = ingest.start(file_stream(spark, str(tmp_path / "in")), store, str(tmp_path / "o"), FAST,
                         on_batch=lambda *_: ended.append(1))
    while not query.status["isTriggerActive"] and not ended:
        pass
    assert ingest.stop_after_batch(query)
    assert not query.isActive and query.exception() is None
    assert store.events().count() == len(ended) <= 1


def test_a_batch_that_begins_while_stopping_writes_nothing(spark, tmp_path, messages, event):
    publish(messages([event()]), tmp_path / "in")
    store, ended = store_at(spark, tmp_path / "store"), []
    stream = file_stream(spark, str(tmp_path / "in"))
    query = ingest.start(stream, store, str(tmp_path / "o"), FAST,
                         on_batch=lambda *_: ended.append(1))
    ingest._gates[query].closed = True
    query.stop()
    assert store.events().count() == 0 and not ended
    run(spark, tmp_path / "in", store, tmp_path / "o")
    assert store.events().count() == 1


def test_state_stays_loaded(spark, tmp_path, messages, event):
    """The twentieth batch loads no snapshot and replays no changelog, nor does any but the first."""
    rows = messages([event(event_id=f"e{i}") for i in range(300)])
    with store_at(spark, tmp_path / "store") as store:
        assert store.insert(valid_events(classify(rows))) == 300
        query, run_id = store._query, store._query.runId
        for batch in range(19):
            more = messages([event(event_id=f"b{batch}-{i}") for i in range(20)]
                            + [event(event_id="e1")])
            assert store.insert(valid_events(classify(more))) == 20
        assert store._query is query and query.runId == run_id
        for progress in [p for p in query.recentProgress if p["numInputRows"]][1:]:
            figures = progress["stateOperators"][0]["customMetrics"]
            assert figures["rocksdbReplayChangelogFileCount" if "rocksdbReplayChangelogFileCount"
                           in figures else "rocksdbNumReplayChangelogFiles"] == 0, figures
    assert not query.isActive


def test_two_stores_on_a_folder_take_turns(spark, tmp_path, messages, event):
    rows = [valid_events(classify(messages([event(event_id=i) for i in ids]))) for ids in ("ab", "bc")]
    one, two = (store_at(spark, tmp_path / "store") for _ in range(2))
    assert [one.insert(rows[0]), two.insert(rows[1]), one.insert(rows[1])] == [2, 1, 0]
    assert one.events().count() == 3


def test_read_dlq_defaults_and_skips(spark):
    rows = spark.createDataFrame(
        [(b"k", b'{"dlq_id": "1"}'), (None, b"[1]"), (None, b"{"), (None, b'{"dlq_id":"2"} x')],
        "key binary, value binary")
    found = deadletter.read_dlq(rows).collect()
    assert len(found) == 1
    row = found[0]
    assert (row.retry_count, row.raw_payload, row.original_topic, row.original_partition,
            row.original_offset, row.key) == (0, "", "unknown", -1, -1, "k")
    assert deadletter.skipped(rows).count() == 3


def test_replay_selection_and_severity(spark, messages):
    records = deadletter.build_dlq(classify(messages(["{", "x", "[]"])))
    records = records.withColumn("retry_count", F.col("original_offset").cast("int") + 1).cache()
    chosen = deadletter.select_replay(records, skip_exhausted=True, max_retry_count=3)
    assert sorted(r.retry_count for r in chosen.collect()) == [1, 2]
    one = records.first().dlq_id
    assert deadletter.select_replay(records, dlq_id=one).count() == 1
    requeued = deadletter.requeue(deadletter.reprocess(records)).collect()
    assert {(r.retry_count, r.severity) for r in requeued} == {
        (2, "WARNING"), (3, "CRITICAL"), (4, "CRITICAL")}
    assert not {r.dlq_id for r in requeued} & {r.dlq_id for r in records.collect()}


def test_recent_ids_in_a_stream(spark, tmp_path, messages, event):
    publish(messages([event(event_id="a"), event(event_id="a"), event(event_id="b")]),
            tmp_path / "in")
    stream = valid_events(classify(file_stream(spark, str(tmp_path / "in"))))
    dedup.drop_recent_stream(stream).select("event_id").writeStream.format("parquet").option(
        "path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "o")).trigger(
        availableNow=True).start().awaitTermination()
    found = spark.read.schema("event_id string").parquet(str(tmp_path / "out")).collect()
    assert sorted(r.event_id for r in found) == ["a", "b"]


def test_streams_never_lose_late_rows(spark, tmp_path, messages, event):
    """Days out of order, one file per micro-batch: a sale 40 days late counts all the same."""
    days = ["2024-03-01", "2024-01-20", "2024-02-28", "2024-01-20"]
    store = store_at(spark, tmp_path / "store")
    for i, day in enumerate(days):
        part = messages([event(event_id=f"e{min(i, 2)}", timestamp=f"{day}T10:00:00Z")],
                        first_offset=i)
        publish(part, tmp_path / "in")
        valid_events(classify(part)).withColumn("event_date", F.col("event_timestamp").cast("date")
                                                ).write.mode("append").parquet(str(tmp_path / "ev"))
    once = dedup.drop_recent_stream(valid_events(classify(file_stream(
        spark, str(tmp_path / "in"), 1))))
    once.select("event_id").writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "o")).trigger(availableNow=True).start(
    ).awaitTermination()
    found = spark.read.schema("event_id string").parquet(str(tmp_path / "out")).collect()
    assert sorted(r.event_id for r in found) == ["e0", "e1", "e2"]
    stream = spark.readStream.schema(store.events().schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "ev"))
    sales_stream.start(stream, str(tmp_path / "sales"), str(tmp_path / "o2"),
                       until_drained=True).awaitTermination()
    rows = sales_stream.current(spark, str(tmp_path / "sales")).orderBy("interval_start").collect()
    assert [(r.interval_start.month, r.orders) for r in rows] == [(1, 2), (2, 1), (3, 1)]


def test_sales_stream_over_batches_and_replay(spark, tmp_path, messages, event):
    store = store_at(spark, tmp_path / "store")
    schema = store.events().schema
    offsets, changes = str(tmp_path / "o"), str(tmp_path / "sales")

    def drain(where):
        stream = spark.readStream.schema(schema).parquet(store.events_path)
        sales_stream.start(stream, changes, where, until_drained=True).awaitTermination()
        rows = sales_stream.current(spark, changes).collect()
        return [(r.orders, r.units_sold, float(r.revenue)) for r in rows]

    store.insert(valid_events(classify(messages([event(event_id="a")]))))
    assert drain(offsets) == [(1, 2, 19.99 * 2)]
    store.insert(valid_events(classify(messages([event(event_id="b", quantity=1)]))))
    assert drain(offsets) == [(2, 3, pytest.approx(19.99 * 3))]


def test_file_batch_reads_everything(spark, tmp_path, messages, event):
    publish(messages([event(), event()]), tmp_path / "in")
    assert file_batch(spark, str(tmp_path / "in")).count() == 2
