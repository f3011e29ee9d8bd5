"""The raw table and the dead letters, as parquet below one folder.

Parquet has no unique constraint, so there must be one writer at a time. What a batch wants to add
is written as candidates, each id once; a stream reads these, drops the ids its state has seen and
appends the rest to the events. The stream starts with the first batch and keeps running, so its
state (every id ever stored, in RocksDB) is loaded once and stays loaded: a batch saves its changes,
and snapshots go up in the background. `close` ends the stream; the next batch starts it again. A
second store on the same folder takes the stream over from the first. Candidates are deleted once
they are stored. Should the state be lost, it is filled again from the ids of the stored events.
"""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.dedup import first_wins, new_rows, stored_hits
from tillstream.schemas import DLQ_SCHEMA, RAW_TABLE_SCHEMA
from tillstream.session import prepare

logger = logging.getLogger(__name__)

DEAD_LETTER_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), *DLQ_SCHEMA.fields,
    T.StructField("severity", T.StringType())])
# `stored` marks ids that only have to become known.
CANDIDATE_SCHEMA = T.StructType([
    *(T.StructField(f.name, f.dataType) for f in RAW_TABLE_SCHEMA),
    T.StructField("stored", T.BooleanType())])
# How often a waiting stream looks for candidates.
POLLING = ("spark.sql.streaming.pollingDelay", "50ms")


class EventStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        for path, schema, split in [
            (self.events_path, RAW_TABLE_SCHEMA, "event_date"),
            (self.candidates_path, CANDIDATE_SCHEMA, None),
            (self.dead_letters_path, DEAD_LETTER_SCHEMA, None),
        ]:
            writer = spark.createDataFrame([], schema).write.mode("ignore")
            (writer.partitionBy(split) if split else writer).parquet(path)
        # Whether candidates of a run that was cut off may be waiting, or be half stored.
        self._unsettled = True
        self._settling = self._rebuilding = False
        self._query: StreamingQuery | None = None
        self._added: list[int] = []
        self._lock = threading.RLock()
        # How many rows the last batch had after its own copies were folded.
        self.candidates = 0

    def __enter__(self) -> EventStore:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Ends the stream between two batches; whatever was inserted is stored."""
        with self._lock:
            if self._query is not None:
                self._query.stop()
                self._query = None

    @property
    def events_path(self) -> str:
        return f"{self.root}/raw/events"

    @property
    def candidates_path(self) -> str:
        return f"{self.root}/raw/candidates"

    @property
    def state_path(self) -> str:
        return f"{self.root}/raw/state"

    @property
    def dead_letters_path(self) -> str:
        return f"{self.root}/dead_letters"

    def events(self) -> DataFrame:
        return self.spark.read.schema(RAW_TABLE_SCHEMA).parquet(self.events_path)

    def dead_letters(self) -> DataFrame:
        """Dead letters, once each: a repeated batch writes the same ids again."""
        rows = self.spark.read.schema(DEAD_LETTER_SCHEMA).parquet(self.dead_letters_path)
        return first_wins(rows, ("dlq_id",), ("failed_at",))

    def insert(self, events: DataFrame) -> int:
        """Stores events whose id is new and returns how many; of several copies the first wins.

        What an earlier, failed call left behind is stored first and counted as well.
        """
        with self._lock:
            inserted = self._settle()
            self._unsettled = True
            seen = Observation()
            self._add_candidates(first_wins(events).withColumns({
                "event_date": F.col("event_timestamp").cast("date"), "stored": F.lit(False),
            }).observe(seen, F.count(F.lit(1)).alias("rows")))
            self.candidates = seen.get["rows"]
            inserted += self._drain()
            self._unsettled = False
            return inserted

    def _settle(self) -> int:
        if not self._unsettled:
            return 0
        if not self._has_state():
            if not self.events().isEmpty():
                self._rebuilding = True
                self._add_candidates(self.events().withColumn("stored", F.lit(True)))
            elif self.spark.read.schema(CANDIDATE_SCHEMA).parquet(self.candidates_path).isEmpty():
                self._unsettled = False
                return 0
        self._settling = True
        inserted = self._drain()
        self._unsettled = self._settling = self._rebuilding = False
        return inserted

    def _has_state(self) -> bool:
        try:
            return not self.spark.read.text(f"{self.state_path}/metadata").isEmpty()
        except AnalysisException:
            return False

    def _add_candidates(self, rows: DataFrame) -> None:
        rows.select(*CANDIDATE_SCHEMA.fieldNames()).write.mode("append").parquet(
            self.candidates_path)

    def _drain(self) -> int:
        """Waits until the stream that knows all ids has passed the waiting candidates."""
        self._added.clear()
        query = self._running()
        query.processAllAvailable()
        if not query.isActive:
            raise RuntimeError("the stream of stored ids was stopped by another store or session")
        return sum(self._added)

    def _running(self) -> StreamingQuery:
        if self._query is None or not self._query.isActive:
            waiting = self.spark.readStream.schema(CANDIDATE_SCHEMA).option(
                "cleanSource", "delete").parquet(self.candidates_path)
            before = self.spark.conf.get(POLLING[0], None)
            self.spark.conf.set(*POLLING)
            try:
                self._query = waiting.dropDuplicates(["event_id"]).writeStream.foreachBatch(
                    lambda batch, _: self._added.append(
                        self._append(batch.where("NOT stored").drop("stored")))).option(
                    "checkpointLocation", self.state_path).start()
            finally:
                if before is None:
                    self.spark.conf.unset(POLLING[0])
                else:
                    self.spark.conf.set(POLLING[0], before)
        return self._query

    def _append(self, fresh: DataFrame) -> int:
        """Adds rows with new ids; a batch that was cut off while it was added comes again."""
        again = self._rebuilding or self._settling
        rest = fresh.persist(StorageLevel.MEMORY_AND_DISK) if again else fresh
        seen = Observation()
        try:
            if self._rebuilding:
                rest = new_rows(fresh, self.events())
            elif self._settling and not fresh.isEmpty():
                rest = self._not_in_events(fresh)
            # Counted above the exchange: below it the count would go where nothing is left to add.
            self._add_events(rest.hint("rebalance", "event_date").observe(
                seen, F.count(F.lit(1)).alias("rows")))
            return seen.get["rows"]
        finally:
            if again:
                fresh.unpersist()

    def _add_events(self, rows: DataFrame) -> None:
        rows.write.mode("append").partitionBy("event_date").parquet(self.events_path)

    def _not_in_events(self, fresh: DataFrame) -> DataFrame:
        first, last = fresh.agg(F.min("event_date"), F.max("event_date")).first()
        written = self.events().where(F.col("event_date").between(first, last))
        return new_rows(fresh, stored_hits(written, fresh))

    def add_dead_letters(self, records: DataFrame) -> None:
        if "severity" not in records.columns:
            records = records.withColumn("severity", F.lit(None).cast("string"))
        records.select(*DEAD_LETTER_SCHEMA.fieldNames()).write.mode("append").parquet(
            self.dead_letters_path)

    def insert_with_retry(self, events: DataFrame, attempts: int = 5, backoff: float = 2.0) -> int:
        """Tries again after a failed write, as after a cut-off run; the last failure is raised."""
        return with_retry(lambda: self.insert(events), attempts, backoff)


def with_retry(action: Callable, attempts: int, backoff: float):
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception as error:
            logger.warning("write attempt %d/%d failed: %s", attempt, attempts, error)
            if attempt == attempts:
                raise
            time.sleep(backoff)
