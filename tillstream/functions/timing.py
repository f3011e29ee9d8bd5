"""Time expressions: intervals, ranges, ISO text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval_start(ts: Column, width: str = "15 minutes") -> Column:
    return F.window(ts, width).start


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def time_range(
    events: DataFrame, start: datetime | str, end: datetime | str,
    column: str = "event_timestamp", date_column: str = "event_date",
) -> DataFrame:
    """Rows with `column` between both ends (inclusive).

    Where the table is partitioned by day the same range is put on the partition column too;
    Spark does not derive the one from the other, and without it every day would be listed.
    """
    low, high = F.lit(str(start)).cast("timestamp"), F.lit(str(end)).cast("timestamp")
    rows = events.where(F.col(column).between(low, high))
    if date_column in events.columns:
        rows = rows.where(F.col(date_column).between(low.cast("date"), high.cast("date")))
    return rows
