"""Sales per interval, kept up to date from the stream of stored events.

The state is one row per interval that ever saw a purchase, whatever the number of events, and is
never given up: an event counts however late it comes. Every micro-batch rebuilds the small table
from it, as a scheduled rebuild would; a repeated batch writes the same rows again. The new table is
written aside and published in one step, so there is always a whole one to read. The rows are dealt
anew into few files; every partition of the state is a task of its own before that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillstream.plans.publish import Published
from tillstream.plans.sales import sales_totals

# Files of a version. The table has one row per interval, some 35,000 a year at 15 minutes.
FILES = 4
SALES_SCHEMA = "interval_start timestamp, orders bigint, units_sold bigint, revenue decimal(31,2)"


def start(
    events: DataFrame, path: str, checkpoint: str, interval: str = "15 minutes",
    until_drained: bool = False, checks: list | None = None,
) -> StreamingQuery:
    """`checks` are data tests; a table that fails one is not published, and the stream ends."""
    table = Published(events.sparkSession, path, SALES_SCHEMA)

    def rebuild(batch: DataFrame, _: int) -> None:
        # No coalesce: it would put all partitions of the state into as few tasks.
        table.replace(batch.repartition(FILES, "interval_start"), checks)

    writer = sales_totals(events, interval).writeStream.outputMode("complete").foreachBatch(
        rebuild).option("checkpointLocation", checkpoint)
    if until_drained:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def current(spark: SparkSession, path: str) -> DataFrame:
    return Published(spark, path, SALES_SCHEMA).current()
