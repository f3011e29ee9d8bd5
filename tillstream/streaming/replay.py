"""Sends selected dead letters to the retry topic, from where the ingest stream reads them again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.operators import deadletter
from tillstream.settings import Settings
from tillstream.sinks.event_store import EventStore
from tillstream.sinks.messages import publisher
from tillstream.sources import messages as source


def retry_publisher(settings: Settings) -> Callable[[DataFrame], int]:
    return publisher(settings, settings.retry_topic)


def send(letters: DataFrame, publish: Callable[[DataFrame], int], dlq_id: str | None = None,
         skip_exhausted: bool = True, max_retry_count: int = 3, where: Column | None = None,
         corrected: Column | None = None) -> int:
    """Publishes the chosen letters and returns how many were sent; a failed write raises.

    `where` narrows the choice further. `corrected` is the payload to send in place of the rejected
    one; where it is null the old one goes. The letters stay: an id that was stored meanwhile is a
    duplicate when it comes again.
    """
    chosen = deadletter.select_replay(letters, dlq_id, skip_exhausted, max_retry_count)
    if where is not None:
        chosen = chosen.where(where)
    if corrected is not None:
        chosen = chosen.withColumn("raw_payload", F.coalesce(corrected, "raw_payload"))
    return publish(deadletter.dlq_messages(chosen))


def send_stored(store: EventStore, settings: Settings, **choice) -> int:
    """From the store's dead letters, each once, to the retry topic."""
    return send(store.dead_letters(), retry_publisher(settings), **choice)


def send_topic(spark, settings: Settings, **choice) -> int:
    """From all that the dead-letter topic holds now to the retry topic."""
    letters = deadletter.read_dlq(source.kafka_batch(spark, settings, settings.dlq_topic))
    return send(letters, retry_publisher(settings), **choice)
