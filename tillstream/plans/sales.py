"""Sales models over staged events; every purchase event is one order line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def purchases(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "PURCHASE")


def amount() -> Column:
    return F.col("quantity") * F.col("unit_price")


def _totals() -> list[Column]:
    return [
        F.count("*").alias("orders"),
        F.sum("quantity").alias("units_sold"),
        F.sum(amount()).cast("decimal(31,2)").alias("revenue"),
    ]


def sales_totals(events: DataFrame, interval: str = "15 minutes") -> DataFrame:
    bucket = F.window("event_timestamp", interval)
    return purchases(events).groupBy(bucket.alias("bucket")).agg(*_totals()).select(
        F.col("bucket.start").alias("interval_start"), "orders", "units_sold", "revenue")


def sales_by_interval(events: DataFrame) -> DataFrame:
    """One row per 15 minutes that saw a purchase, in time order."""
    return sales_totals(events).orderBy("interval_start")


def daily_sales(events: DataFrame) -> DataFrame:
    day = F.col("event_timestamp").cast("date").alias("sale_date")
    return purchases(events).groupBy(day).agg(*_totals())


def sales_read(sales: DataFrame, start, end) -> DataFrame:
    """The revenue series of a dashboard."""
    low, high = F.lit(str(start)).cast("timestamp"), F.lit(str(end)).cast("timestamp")
    return sales.where(F.col("interval_start").between(low, high)).select(
        F.col("interval_start").alias("time"), "revenue").orderBy("time")


