"""The ingest stream: messages in, stored events and dead letters out, each exactly once.

Offsets advance in the checkpoint after a micro-batch is stored. A batch that was cut off comes
again unchanged; stored ids make the second run add nothing.
"""

from __future__ import annotations

import logging
import threading
import time
import weakref
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators import deadletter
from tillstream.operators.classify import classify, valid_events
from tillstream.schemas import VALID
from tillstream.session import prepare
from tillstream.settings import Settings
from tillstream.sinks.event_store import EventStore

logger = logging.getLogger(__name__)
KEEP_EMPTY = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
Publish = Callable[[DataFrame], object]


def with_retries(messages: DataFrame, retry_messages: DataFrame) -> DataFrame:
    """New messages and replayed dead letters as one stream, so that one writer sees both."""
    return messages.unionByName(
        deadletter.unwrapped(retry_messages).drop("retried_id"), allowMissingColumns=True)


def store_batch(store: EventStore, batch: DataFrame, settings: Settings,
                publish: Publish | None = None) -> dict[str, int]:
    """Classifies a batch once and writes both outcomes; returns its counters.

    Dead letters are stored with the severity of their notice and, where `publish` is given, sent
    on as messages. Retry messages that are no records are counted and go no further. The counters
    are observed while the batch is written: `batch_duplicates` are copies within the batch,
    `table_duplicates` had their id stored before, `duplicates` are both.
    """
    prepare(batch.sparkSession)
    # A batch without valid rows must not drop the plan that counts.
    batch.sparkSession.conf.set("spark.sql.adaptive.optimizer.excludedRules", KEEP_EMPTY)
    now = F.lit(datetime.now(timezone.utc))
    skipped = F.coalesce("skipped", F.lit(False)) if "skipped" in batch.columns else F.lit(False)
    seen = Observation()
    classified = classify(batch).observe(
        seen, F.count(F.lit(1)).alias("consumed"), F.count_if(skipped).alias("skipped"),
        F.count_if(~skipped & (F.col("outcome") != VALID)).alias("invalid"),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        read = classified.where(~skipped)
        inserted = store.insert_with_retry(
            valid_events(read, now), settings.write_attempts, settings.write_backoff_seconds)
        counts = dict(seen.get)
        if counts["invalid"]:
            letters = deadletter.build_dlq(read, now).withColumn(
                "severity", deadletter.severity(settings.retry_max_attempts))
            store.add_dead_letters(letters)
            if publish:
                publish(deadletter.dlq_messages(letters))
    finally:
        classified.unpersist()
    if counts["skipped"]:
        logger.warning("%d retry messages are no dead-letter records", counts["skipped"])
    valid = counts["consumed"] - counts["skipped"] - counts["invalid"]
    counts["inserted"] = inserted
    counts["duplicates"] = valid - inserted
    counts["batch_duplicates"] = valid - store.candidates
    counts["table_duplicates"] = counts["duplicates"] - counts["batch_duplicates"]
    return counts


class _Gate:
    """Held while a batch is handled; a closed one lets none pass."""

    def __init__(self):
        self.lock, self.closed = threading.Lock(), False


_gates: weakref.WeakKeyDictionary[StreamingQuery, _Gate] = weakref.WeakKeyDictionary()


def start(
    messages: DataFrame, store: EventStore, checkpoint: str, settings: Settings | None = None,
    until_drained: bool = False, on_batch: Callable[[int, dict[str, int]], None] | None = None,
    publish: Publish | None = None,
) -> StreamingQuery:
    """Starts the stream; `until_drained` stops it once everything there now is stored. Close the
    store when the stream has ended, or use `drain`.

    `publish` takes dead letters as `key, value`; `sinks.messages.publisher` makes one for a topic.
    """
    settings = settings or Settings()
    gate = _Gate()

    def handle(batch: DataFrame, batch_id: int) -> None:
        with gate.lock:
            if gate.closed:
                raise RuntimeError("the stream was stopped; this batch comes again")
            counts = store_batch(store, batch, settings, publish)
            if on_batch:
                on_batch(batch_id, counts)

    writer = messages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if until_drained:
        query = writer.trigger(availableNow=True).start()
    else:
        query = writer.trigger(processingTime=f"{settings.batch_interval_seconds} seconds").start()
    _gates[query] = gate
    return query


def drain(
    messages: DataFrame, store: EventStore, checkpoint: str, settings: Settings | None = None,
    on_batch: Callable[[int, dict[str, int]], None] | None = None, publish: Publish | None = None,
) -> None:
    """Stores what is there now, and ends the store's own stream as well."""
    with store:
        start(messages, store, checkpoint, settings, True, on_batch, publish).awaitTermination()


def stop_after_batch(query: StreamingQuery, patience_seconds: float = 600.0) -> bool:
    """Stops a stream of `start` between two micro-batches; tells whether that worked out in time.

    The batch in progress is handled and committed. Should one begin between the last look and the
    stop, it finds the gate closed, writes nothing and comes again.
    """
    gate, deadline = _gates[query], time.monotonic() + patience_seconds
    while query.isActive and time.monotonic() < deadline:
        with gate.lock:
            if not query.status["isTriggerActive"]:
                gate.closed = True
                break
        time.sleep(0.05)
    query.stop()
    return gate.closed
