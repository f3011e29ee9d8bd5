"""Business figures over raw or staged events. Time ranges go through `timing.time_range`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.plans.sales import amount, purchases

LATENCY_BIN = 4096


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole to two digits, 0 when there is no whole."""
    ratio = F.round(F.lit(100.0).cast("decimal(4,1)") * part / whole, 2).cast("double")
    return F.when(whole == 0, F.lit(0.0)).otherwise(ratio)


def _of_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def _count_of(event_type: str) -> Column:
    return F.count_if(_of_type(event_type))


def _revenue() -> Column:
    return F.coalesce(
        F.sum(F.when(_of_type("PURCHASE"), amount())), F.lit(0)).cast("decimal(31,2)")


def orders(events: DataFrame) -> DataFrame:
    return purchases(events).agg(F.count("*").alias("orders"))


def revenue(events: DataFrame) -> DataFrame:
    """Null when there was no purchase."""
    return purchases(events).agg(F.sum(amount()).cast("decimal(31,2)").alias("revenue"))


def units_sold(events: DataFrame) -> DataFrame:
    return purchases(events).agg(F.sum("quantity").alias("units_sold"))


def active_users(events: DataFrame) -> DataFrame:
    return events.agg(F.count_distinct("user_id").alias("active_users"))


def conversion_rate(events: DataFrame) -> DataFrame:
    counts = events.agg(
        _count_of("PURCHASE").alias("bought"), _count_of("PRODUCT_VIEW").alias("viewed"))
    return counts.select(percent(F.col("bought"), F.col("viewed")).alias("conversion_rate"))


def event_breakdown(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("count")).orderBy(
        F.desc("count"), "event_type")


def type_mix(events: DataFrame, column: str = "event_type") -> DataFrame:
    """Events per type with their percentage of all; the total is summed from the counts."""
    counts = events.groupBy(column).agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("share", F.round(F.lit(100) * F.col("count") / total, 1))


def row_count(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("rows"))


def product_performance(events: DataFrame) -> DataFrame:
    return events.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        _count_of("PRODUCT_VIEW").alias("views"),
        _count_of("ADD_TO_CART").alias("cart_additions"),
        _count_of("PURCHASE").alias("purchases"),
        _revenue().alias("revenue"),
    ).withColumn("conversion_rate", percent(F.col("purchases"), F.col("views")))


def customer_metrics(events: DataFrame) -> DataFrame:
    return events.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        _count_of("PRODUCT_VIEW").alias("total_views"),
        _count_of("ADD_TO_CART").alias("total_cart_additions"),
        _count_of("PURCHASE").alias("total_purchases"),
        _revenue().alias("total_revenue"),
    )


def conversion_metrics(events: DataFrame) -> DataFrame:
    """Per day, how many events reach each step and what share goes on to the next."""
    return events.groupBy(F.col("event_timestamp").cast("date").alias("day")).agg(
        _count_of("PRODUCT_VIEW").alias("views"),
        _count_of("ADD_TO_CART").alias("cart_additions"),
        _count_of("CHECKOUT_STARTED").alias("checkouts"),
        _count_of("PURCHASE").alias("purchases"),
    ).withColumns({
        "cart_rate": percent(F.col("cart_additions"), F.col("views")),
        "checkout_rate": percent(F.col("checkouts"), F.col("cart_additions")),
        "purchase_rate": percent(F.col("purchases"), F.col("checkouts")),
    })


def top_products(events: DataFrame, count: int = 10) -> DataFrame:
    """Best sellers by revenue."""
    sold = purchases(events).groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum(amount()).cast("decimal(31,2)").alias("revenue"))
    return sold.orderBy(F.desc("revenue"), "product_id").limit(count)


def top_products_per_day(events: DataFrame, count: int = 3) -> DataFrame:
    """Best sellers of each day. What is ranked are day totals, one row per product."""
    day = F.col("event_timestamp").cast("date").alias("day")
    sold = purchases(events).groupBy(day, "product_id").agg(
        F.sum(amount()).cast("decimal(31,2)").alias("revenue"))
    rank = F.row_number().over(
        Window.partitionBy("day").orderBy(F.desc("revenue"), "product_id"))
    return sold.withColumn("rank", rank).where(F.col("rank") <= count)


def events_per_minute(events: DataFrame) -> DataFrame:
    bucket = F.window("event_timestamp", "1 minute")
    return events.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("events")).select(
        F.col("bucket.start").alias("minute"), "events",
        F.round(F.col("events") / 60, 4).alias("events_per_second"))


def processing_latency(events: DataFrame, percentiles: tuple[float, ...] = (0.5, 0.95, 0.99)
                       ) -> DataFrame:
    """Whole seconds from event to storage: percentiles over all events, between ranks in line.

    Equal latencies are counted first. Ranks come from two levels of cumulated counts, bins of
    `LATENCY_BIN` seconds and the seconds inside a bin, so no task orders all latencies.
    """
    latency = F.floor(
        (F.unix_micros("ingested_at") - F.unix_micros("event_timestamp")) / F.lit(1_000_000))
    histogram = events.where(latency.isNotNull()).groupBy(
        latency.cast("long").alias("seconds")).agg(F.count("*").alias("n")).withColumn(
        "bin", F.floor(F.col("seconds") / LATENCY_BIN))
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("bin").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    bins = histogram.groupBy("bin").agg(F.sum("n").alias("n")).select(
        "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("below"),
        F.sum("n").over(everything).alias("events"))
    in_bin = Window.partitionBy("bin").orderBy("seconds").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = histogram.withColumn("inside", F.sum("n").over(in_bin)).join(bins, "bin").select(
        "seconds", "n", "events", (F.col("below") + F.col("inside")).alias("upto"))

    def at_rank(rank: Column) -> Column:
        here = (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
        return F.max(F.when(here, F.col("seconds")))

    figures = [F.coalesce(F.max("events"), F.lit(0)).alias("events"),
               F.max("seconds").alias("max_seconds")]
    for p in percentiles:
        rank = F.lit(p) * (F.col("events") - 1)
        low, high = at_rank(F.floor(rank)), at_rank(F.ceil(rank))
        part = F.max(rank - F.floor(rank))
        figures.append((low + (high - low) * part).alias(f"p{round(p * 100)}_seconds"))
    return ranked.agg(*figures)


def user_events(events: DataFrame, user_id: str) -> DataFrame:
    return events.where(F.col("user_id") == user_id)


def by_id(events: DataFrame, *ids: str) -> DataFrame:
    """The events with exactly these ids; the list reaches the scan as a filter."""
    return events.where(F.col("event_id").isin(*ids))


def with_id_prefix(events: DataFrame, prefix: str) -> DataFrame:
    return events.where(F.col("event_id").startswith(prefix))


def without_id_prefix(events: DataFrame, prefix: str) -> DataFrame:
    """What is left after deleting by id prefix; to be written over the old rows."""
    return events.where(~F.col("event_id").startswith(prefix))


def recent_events(events: DataFrame, count: int = 20) -> DataFrame:
    """The rows stored last."""
    return events.orderBy(
        F.desc("ingested_at"), F.desc("kafka_offset"), F.desc("kafka_partition")).limit(count)
