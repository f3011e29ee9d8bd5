"""One registered query per operator, over the given tables. Doubles stand in for decimals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import fixtures as fx
from tillstream.functions.timing import time_range
from tillstream.operators import alerts, classify, deadletter, dedup, lag, quality, series, topics
from tillstream.plans import accounting, business, rollups, sales, snapshot, staging, warehouse
from tillstream.schemas import EVENT_TYPES
from tillstream.session import scratch_folder
from tillstream.sinks import messages as message_sink
from tillstream.sinks.event_store import EventStore
from tillstream.sources import messages as message_source
from tillstream.streaming import alerts as live_alerts
from tillstream.streaming import ingest
from tillstream.streaming import sales as sales_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RANGE = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")
EVENT_FIELDS = ["event_id", "event_type", "event_timestamp", "user_id", "product_id", "quantity"]


def query(function):
    QUERIES[function.__name__] = function
    return function


def _plain(rows: DataFrame) -> DataFrame:
    """Decimals as doubles and error lists as text, so that results compare by value."""
    changes = {}
    for field in rows.schema:
        kind = field.dataType.typeName()
        if kind.startswith("decimal"):
            changes[field.name] = F.col(field.name).cast("double")
        elif kind == "array":
            changes[field.name] = F.to_json(field.name)
    return rows.withColumns(changes) if changes else rows


def _in_range(spark, sf_dir):
    return time_range(fx.raw_events(spark, sf_dir), *RANGE)


# --- sources ---------------------------------------------------------------------------------

@query
def topic_scan(spark, sf_dir):
    return topics.message_rows(fx.messages(spark, sf_dir))


@query
def topic_partition_scan(spark, sf_dir):
    return topics.message_rows(topics.one_partition(fx.messages(spark, sf_dir), 1))


@query
def topic_summary(spark, sf_dir):
    return topics.summary(fx.messages(spark, sf_dir))


@query
def topic_peek(spark, sf_dir):
    return topics.peek(fx.messages(spark, sf_dir), 20)


# --- parsing, validation, routing ------------------------------------------------------------

@query
def parse_events(spark, sf_dir):
    rows = classify.parse_messages(fx.messages(spark, sf_dir))
    return rows.select("partition", "offset", "parsed", F.when(
        F.col("parsed"), F.col("wire.event_id")).alias("event_id"))


@query
def normalize_events(spark, sf_dir):
    rows = classify.normalize_messages(classify.parse_messages(fx.messages(spark, sf_dir)))
    return _plain(rows.where("parsed").select(
        "partition", "offset", "event_type", "event_timestamp", "quantity", "unit_price"))


@query
def validate_events(spark, sf_dir):
    rows = fx.classified(spark, sf_dir)
    return rows.select("partition", "offset", "outcome", F.to_json("errors").alias("errors"))


@query
def valid_events(spark, sf_dir):
    return _plain(classify.valid_events(fx.classified(spark, sf_dir)).drop("ingested_at"))


@query
def route_counts(spark, sf_dir):
    return classify.route_counts(fx.classified(spark, sf_dir))


@query
def shape_check(spark, sf_dir):
    rows = classify.check_shape(fx.messages(spark, sf_dir))
    return rows.groupBy("well_shaped").agg(F.count("*").alias("messages"))


@query
def dlq_error_text(spark, sf_dir):
    rows = classify.rejected(fx.classified(spark, sf_dir))
    return rows.select("partition", "offset", deadletter.error_text().alias("text"))


# --- sinks -----------------------------------------------------------------------------------

@query
def to_messages(spark, sf_dir):
    rows = message_sink.to_messages(fx.raw_events(spark, sf_dir))
    return rows.select(F.col("key").cast("string").alias("key"),
                       F.col("value").cast("string").alias("value"))


@query
def idempotent_insert(spark, sf_dir):
    """Rows a table that already holds some events gains from all messages."""
    with EventStore(spark, scratch_folder(spark, "store")) as store:
        store.insert(fx.stored_events(spark, sf_dir).drop("event_date"))
        store.insert(classify.valid_events(fx.classified(spark, sf_dir)))
    return _plain(store.events().drop("ingested_at", "event_date"))


@query
def snapshot_diff(spark, sf_dir):
    """A snapshot of the stored events against what the messages would give."""
    columns = ["event_id", "event_type", "user_id", "product_id", "quantity", "unit_price"]
    root = scratch_folder(spark, "snapshots")
    snapshot.write_snapshot(fx.raw_events(spark, sf_dir), root, "first")
    kept = snapshot.read_snapshot(spark, root, "first").select(*columns)
    again = classify.valid_events(fx.classified(spark, sf_dir)).select(*columns)
    return _plain(snapshot.difference(kept, again))


@query
def snapshot_partitions(spark, sf_dir):
    """The same, by digests per type: partitions that hold the same rows are not compared."""
    columns = ["event_id", "event_type", "user_id", "product_id", "quantity", "unit_price"]
    kept = fx.raw_events(spark, sf_dir).select(*columns)
    again = classify.valid_events(fx.classified(spark, sf_dir)).select(*columns)
    return _plain(snapshot.difference_by_partition(kept, again, "event_type"))


@query
def delete_prefix(spark, sf_dir):
    return _plain(business.without_id_prefix(
        fx.raw_events(spark, sf_dir), "evt_1").select(*EVENT_FIELDS))


# --- duplicates ------------------------------------------------------------------------------

@query
def dedup_first(spark, sf_dir):
    rows = classify.valid_events(fx.classified(spark, sf_dir))
    return _plain(dedup.first_wins(rows).drop("ingested_at"))


@query
def dedup_ttl(spark, sf_dir):
    rows = fx.classified(spark, sf_dir).where("outcome = 'VALID'")
    return dedup.drop_recent(rows.select("event_id", "timestamp", "partition", "offset"))


@query
def dedup_ttl_by_user(spark, sf_dir):
    return _ttl_by(spark, sf_dir, "user_id", 6 * 3600)


@query
def dedup_ttl_hot_key(spark, sf_dir):
    """Few keys with long histories, which are followed by joins."""
    return _ttl_by(spark, sf_dir, "event_type", 3600)


def _ttl_by(spark, sf_dir, key, ttl):
    sightings = fx.table(spark, sf_dir, "events").select(
        F.col(key).alias("id"), F.col("ts").cast("timestamp").alias("timestamp"))
    anchors = dedup.ttl_anchors(sightings, ttl, "id")
    return anchors.select("id", F.timestamp_micros("at").alias("kept_at"))


@query
def duplicate_summary(spark, sf_dir):
    return dedup.surplus_copies(fx.classified(spark, sf_dir))


@query
def ingest_stats(spark, sf_dir):
    return accounting.ingest_stats(
        fx.classified(spark, sf_dir), fx.stored_events(spark, sf_dir))


@query
def uniqueness_check(spark, sf_dir):
    return quality.uniqueness(classify.valid_events(fx.classified(spark, sf_dir)))


@query
def missing_ids(spark, sf_dir):
    return quality.missing_ids(
        fx.raw_events(spark, sf_dir), classify.valid_events(fx.classified(spark, sf_dir)))


# --- dead letters and retry ------------------------------------------------------------------

@query
def dlq_records(spark, sf_dir):
    return _plain(fx.dlq_records(spark, sf_dir))


@query
def failed_by_reason(spark, sf_dir):
    return deadletter.failed_by_reason(fx.dlq_records(spark, sf_dir))


@query
def dlq_replay(spark, sf_dir):
    """What goes to the retry topic when exhausted records are left out."""
    records = deadletter.read_dlq(fx.retry_messages(spark, sf_dir))
    chosen = deadletter.dlq_messages(deadletter.select_replay(records, skip_exhausted=True))
    return chosen.select(F.col("key").cast("string").alias("key"),
                         F.col("value").cast("string").alias("value"))


@query
def dlq_listing(spark, sf_dir):
    return deadletter.listing(deadletter.read_dlq(fx.retry_messages(spark, sf_dir)))


@query
def retry_outcomes(spark, sf_dir):
    return fx.retried(spark, sf_dir).select(
        "retried_id", "outcome", F.to_json("errors").alias("errors"))


@query
def retry_requeued(spark, sf_dir):
    """What failed again, among it two corrections of one letter and records without origin."""
    return _plain(deadletter.requeue(fx.retried(spark, sf_dir)).drop("failed_at"))


@query
def retry_recovered(spark, sf_dir):
    """Rows the table gains from the replay, on top of what the first run stored."""
    first_run = classify.valid_events(fx.classified(spark, sf_dir))
    recovered = dedup.first_wins(classify.valid_events(fx.retried(spark, sf_dir)))
    return _plain(dedup.new_rows(recovered, first_run).drop("ingested_at"))


@query
def retry_stats(spark, sf_dir):
    return deadletter.retry_stats(fx.retried(spark, sf_dir))


# --- raw events: projection, filter, sort, limit ---------------------------------------------

@query
def stg_events(spark, sf_dir):
    return _plain(staging.stg_events(fx.raw_events(spark, sf_dir)))


@query
def user_events(spark, sf_dir):
    return _plain(business.user_events(fx.raw_events(spark, sf_dir), "user_7").drop("event_date"))


@query
def event_lookup(spark, sf_dir):
    return _plain(business.by_id(
        fx.raw_events(spark, sf_dir), "evt_12", "evt_77", "evt_").select(*EVENT_FIELDS))


@query
def prefix_lookup(spark, sf_dir):
    return _plain(business.with_id_prefix(
        fx.raw_events(spark, sf_dir), "evt_12").select(*EVENT_FIELDS))


@query
def recent_events(spark, sf_dir):
    return _plain(business.recent_events(fx.raw_events(spark, sf_dir), 20).drop("event_date"))


@query
def event_breakdown(spark, sf_dir):
    return business.event_breakdown(_in_range(spark, sf_dir))


# --- business figures ------------------------------------------------------------------------

@query
def sales_by_interval(spark, sf_dir):
    return _plain(sales.sales_by_interval(staging.stg_events(fx.raw_events(spark, sf_dir))))


@query
def sales_read(spark, sf_dir):
    model = sales.sales_by_interval(staging.stg_events(fx.raw_events(spark, sf_dir)))
    return _plain(sales.sales_read(model, *RANGE))


@query
def daily_sales(spark, sf_dir):
    rows = sales.daily_sales(fx.raw_events(spark, sf_dir))
    return _plain(rows.withColumn("sale_date", F.col("sale_date").cast("string")))


@query
def orders_in_range(spark, sf_dir):
    return business.orders(_in_range(spark, sf_dir))


@query
def revenue_in_range(spark, sf_dir):
    return _plain(business.revenue(_in_range(spark, sf_dir)))


@query
def units_in_range(spark, sf_dir):
    return business.units_sold(_in_range(spark, sf_dir))


@query
def active_users(spark, sf_dir):
    return business.active_users(_in_range(spark, sf_dir))


@query
def conversion_rate(spark, sf_dir):
    return business.conversion_rate(_in_range(spark, sf_dir))


@query
def row_count(spark, sf_dir):
    return business.row_count(fx.raw_events(spark, sf_dir))


@query
def type_mix(spark, sf_dir):
    return business.type_mix(fx.raw_events(spark, sf_dir))


@query
def product_performance(spark, sf_dir):
    return _plain(business.product_performance(fx.raw_events(spark, sf_dir)))


@query
def customer_metrics(spark, sf_dir):
    return _plain(business.customer_metrics(fx.raw_events(spark, sf_dir)))


@query
def conversion_metrics(spark, sf_dir):
    rows = business.conversion_metrics(fx.raw_events(spark, sf_dir))
    return rows.withColumn("day", F.col("day").cast("string"))


@query
def top_products(spark, sf_dir):
    return _plain(business.top_products(fx.raw_events(spark, sf_dir), 10))


@query
def top_products_per_day(spark, sf_dir):
    rows = business.top_products_per_day(fx.raw_events(spark, sf_dir), 3)
    return _plain(rows.withColumn("day", F.col("day").cast("string")))


@query
def events_per_minute(spark, sf_dir):
    return business.events_per_minute(fx.raw_events(spark, sf_dir))


@query
def sketched_users(spark, sf_dir):
    """Distinct users per month from one row a day; whether that is as near as stated."""
    events = fx.raw_events(spark, sf_dir)
    month = F.date_trunc("month", "day").cast("date").alias("month")
    about = rollups.active_users(rollups.daily_sketches(events), month)
    exact = events.groupBy(F.date_trunc("month", "event_timestamp").cast("date").alias(
        "month")).agg(F.count_distinct("user_id").alias("exact"))
    within = F.abs(F.col("active_users") - F.col("exact")) <= rollups.USERS_ERROR * F.col("exact")
    return about.join(exact, "month").select("month", "days", "exact", within.alias("within"))


@query
def sketched_latency(spark, sf_dir):
    """Percentiles of latency from one row a day; whether their ranks are as near as stated."""
    events = fx.raw_events(spark, sf_dir)
    about = rollups.processing_latency(rollups.daily_sketches(events))
    seconds = rollups.latency_seconds()
    picked = about.select("events", "max_seconds", F.explode(F.map_from_arrays(
        F.array(*[F.lit(p) for p in (0.5, 0.95, 0.99)]),
        F.array("p50_seconds", "p95_seconds", "p99_seconds"))).alias("p", "value"))
    ranks = events.select(seconds.alias("seconds")).join(F.broadcast(picked)).groupBy(
        "events", "max_seconds", "p").agg(
        F.avg((F.col("seconds") < F.col("value")).cast("int")).alias("below"),
        F.avg((F.col("seconds") <= F.col("value")).cast("int")).alias("upto"))
    within = (F.col("below") - rollups.RANK_ERROR <= F.col("p")) & (
        F.col("p") <= F.col("upto") + rollups.RANK_ERROR)
    return ranks.select("p", "events", "max_seconds", within.alias("within"))


@query
def processing_latency(spark, sf_dir):
    return business.processing_latency(fx.raw_events(spark, sf_dir))


# --- metric samples --------------------------------------------------------------------------

# Evaluation steps, the range of rates and the lookback, in seconds; samples come hourly.
STEP, RATE_RANGE, LOOKBACK = 1800, 7200, 5400
LAG_LIMIT, LAG_HOURS = 85, 3
DLQ_LIMIT, DLQ_RANGE_HOURS, DLQ_HOURS = 0.0008, 6, 2
DOWN_HOURS = 2


def _stepped(samples: DataFrame) -> DataFrame:
    return series.at_steps(samples, STEP, LOOKBACK)


def _labelled(rows: DataFrame, *names: str) -> DataFrame:
    labels = [F.col("labels")[name].alias(name) for name in names]
    return rows.select(*labels, *[c for c in rows.columns if c not in ("labels", "series")])


@query
def metric_select(spark, sf_dir):
    rows = series.select(
        fx.metrics(spark, sf_dir), "kafka_consumergroup_lag_sum",
        matching={"consumergroup": "ingestion-service|retry-service"})
    return _labelled(rows, "consumergroup", "topic")


@query
def metric_latest(spark, sf_dir):
    rows = series.latest(fx.metrics(spark, sf_dir), "2024-01-20 12:30:00", 7200)
    return rows.select("metric", "series", "ts", "value")


@query
def counter_rate(spark, sf_dir):
    cpu = series.select(fx.metrics(spark, sf_dir), "node_cpu_seconds_total", {"mode": "idle"})
    rows = _labelled(series.rate(cpu, 6 * 3600), "cpu")
    return rows.withColumn("value", F.round("value", 9))


@query
def events_per_sec(spark, sf_dir):
    offsets = series.select(
        fx.metrics(spark, sf_dir), "kafka_topic_partition_current_offset", {"topic": fx.TOPIC})
    rates = series.rate_at_steps(offsets, RATE_RANGE, STEP)
    return series.total(rates).withColumn("value", F.round("value", 9))


@query
def cpu_usage(spark, sf_dir):
    cpu = series.select(fx.metrics(spark, sf_dir), "node_cpu_seconds_total", {"mode": "idle"})
    return series.busy_percent(series.rate_at_steps(cpu, RATE_RANGE, STEP)).withColumn(
        "value", F.round("value", 7))


@query
def cpu_cores(spark, sf_dir):
    return series.count(_stepped(series.select(
        fx.metrics(spark, sf_dir), "node_cpu_seconds_total", {"mode": "idle"})))


@query
def memory_used(spark, sf_dir):
    samples = fx.metrics(spark, sf_dir)
    used = series.minus(_stepped(series.select(samples, "node_memory_MemTotal_bytes")),
                        _stepped(series.select(samples, "node_memory_MemAvailable_bytes")))
    return _labelled(used, "instance")


@query
def disk_used(spark, sf_dir):
    samples = fx.metrics(spark, sf_dir)
    used = series.minus(
        _stepped(series.select(samples, "node_filesystem_size_bytes", {"mountpoint": "/"})),
        _stepped(series.select(samples, "node_filesystem_avail_bytes", {"mountpoint": "/"})))
    return _labelled(used, "instance")


@query
def dlq_total(spark, sf_dir):
    rows = series.latest(fx.metrics(spark, sf_dir), "2024-01-20 12:30:00", 7200)
    offsets = series.select(
        rows, "kafka_topic_partition_current_offset", {"topic": f"{fx.TOPIC}-dlq"})
    return offsets.agg(F.sum("value").alias("value"))


@query
def consumer_lag(spark, sf_dir):
    """Everything against what was there before 20 January; partition 2 never committed."""
    rows = fx.messages(spark, sf_dir)
    high = rows.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("high"))
    committed = rows.where(F.col("timestamp") < "2024-01-20").groupBy("topic", "partition").agg(
        F.when(F.col("partition") == 2, F.lit(-1001)).otherwise(F.max("offset") + 1)
        .alias("committed"))
    return lag.consumer_lag(high, committed)


@query
def total_consumer_lag(spark, sf_dir):
    return lag.total_lag(lag.consumer_lag(
        *(_marks(spark, sf_dir)), keys=("topic", "partition", "ts")), ("topic", "ts"))


@query
def lag_trend(spark, sf_dir):
    lags = lag.consumer_lag(*_marks(spark, sf_dir), keys=("topic", "partition", "ts"))
    return lag.with_trend(lags, ["topic", "partition"])


def _marks(spark, sf_dir):
    marks = fx.watermarks(spark, sf_dir)
    return marks.drop("committed"), marks.drop("high")


@query
def alert_lag(spark, sf_dir):
    rows = alerts.lag_alert(fx.metrics(spark, sf_dir), threshold=LAG_LIMIT, max_gap_seconds=3600,
                            hold_seconds=LAG_HOURS * 3600)
    return _labelled(rows, "consumergroup", "topic")


@query
def alert_dlq_rate(spark, sf_dir):
    rows = alerts.dlq_alert(
        fx.metrics(spark, sf_dir), f"{fx.TOPIC}-dlq", threshold=DLQ_LIMIT,
        range_seconds=DLQ_RANGE_HOURS * 3600, max_gap_seconds=3600,
        hold_seconds=DLQ_HOURS * 3600, step_seconds=STEP)
    return rows.drop("labels").withColumn("value", F.round("value", 9))


@query
def alert_down(spark, sf_dir):
    rows = alerts.down_alert(fx.metrics(spark, sf_dir), max_gap_seconds=3600,
                             hold_seconds=DOWN_HOURS * 3600)
    return _labelled(rows, "job")


# --- data tests ------------------------------------------------------------------------------

def _messy(spark, sf_dir):
    """Every message as the staging table would see it without validation."""
    return fx.classified(spark, sf_dir).select(
        "event_id", "event_type", "event_timestamp", "user_id")


@query
def dq_not_null(spark, sf_dir):
    return quality.null_counts(
        _messy(spark, sf_dir), ["event_id", "event_type", "event_timestamp", "user_id"])


@query
def dq_unique(spark, sf_dir):
    return quality.duplicate_values(_messy(spark, sf_dir), "event_id")


@query
def dq_accepted(spark, sf_dir):
    return quality.unaccepted_values(_messy(spark, sf_dir), "event_type", EVENT_TYPES)


@query
def dq_non_negative(spark, sf_dir):
    """Sales of events of which every third has a negative quantity."""
    events = fx.raw_events(spark, sf_dir).withColumn("quantity", F.expr(
        "if(kafka_offset % 3 = 0, -quantity, quantity)"))
    return _plain(sales.sales_by_interval(events).where(
        "orders < 0 OR units_sold < 0 OR revenue < 0"))


@query
def dq_report(spark, sf_dir):
    staged = quality.report(_messy(spark, sf_dir), warehouse.STAGING_CHECKS)
    model = sales.sales_by_interval(fx.raw_events(spark, sf_dir))
    return staged.unionByName(quality.report(model, warehouse.SALES_CHECKS))


# --- streams ---------------------------------------------------------------------------------

def _files(rows: DataFrame, name: str, by: str) -> str:
    """Rows in several files that each span the whole time, as a replay or backfill brings them."""
    folder = scratch_folder(rows.sparkSession, name)
    rows.repartition(max(4, rows.count() // 1_000_000), by).write.parquet(folder)
    return folder


def _message_files(spark, sf_dir, by: str = "key") -> str:
    """By key as a topic is, where copies of a message stay in order, or all mixed up."""
    return _files(fx.messages(spark, sf_dir), "messages", by)


def _ingested(spark, sf_dir, on_batch=None) -> EventStore:
    stream = message_source.file_stream(spark, _message_files(spark, sf_dir), max_files=2)
    store = EventStore(spark, scratch_folder(spark, "store"))
    ingest.drain(stream, store, scratch_folder(spark, "offsets"), on_batch=on_batch)
    return store


@query
def stream_ingest(spark, sf_dir):
    return _plain(_ingested(spark, sf_dir).events().drop("ingested_at", "event_date"))


@query
def stream_stats(spark, sf_dir):
    """The counters that the running job observed, over all of its micro-batches."""
    counts = []
    _ingested(spark, sf_dir, lambda _, c: counts.append(c))
    names = ("consumed", "inserted", "invalid", "duplicates")
    return spark.range(1).select(*[
        F.lit(sum(c[name] for c in counts)).cast("long").alias(name) for name in names])


@query
def stream_alerts(spark, sf_dir):
    """The lag alert on a stream of samples that come in the order of time, in four pieces."""
    samples = scratch_folder(spark, "samples")
    fx.metrics(spark, sf_dir).write.parquet(samples)
    samples = spark.read.parquet(samples)
    at = F.unix_micros("ts")
    first, last = samples.agg(F.min(at), F.max(at)).first()
    pieces = 4
    width = ((last or 0) - (first or 0)) // pieces + 1
    # Samples without a time come with the first piece.
    piece_of = F.coalesce(F.floor((at - (first or 0)) / F.lit(width)), F.lit(0))
    folder = scratch_folder(spark, "sample-stream")
    for piece in range(pieces):
        samples.where(piece_of == piece).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    rows = live_alerts.lag_alert(stream, threshold=LAG_LIMIT, max_gap_seconds=3600,
                                 hold_seconds=LAG_HOURS * 3600)
    out = scratch_folder(spark, "alerts")
    rows.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", scratch_folder(spark, "offsets")).trigger(
        availableNow=True).start().awaitTermination()
    return _labelled(spark.read.schema(rows.schema).parquet(out), "consumergroup", "topic")


@query
def stream_dead_letters(spark, sf_dir):
    return _plain(_ingested(spark, sf_dir).dead_letters().drop("failed_at"))


@query
def stream_retry(spark, sf_dir):
    """Letters of retries that failed again, and how many retry messages were no records."""
    retry = fx.retry_messages(spark, sf_dir).withColumn("timestamp", F.lit(None).cast("timestamp"))
    junk = fx.table(spark, sf_dir, "events").where("event_id % 50 = 1").selectExpr(
        "cast(NULL AS binary) AS key", "cast(concat('no record ', event_id) AS binary) AS value",
        "'retry' AS topic", "0 AS partition", "-event_id AS offset",
        "cast(NULL AS timestamp) AS timestamp")
    columns = message_source.COLUMNS
    rows = retry.select(*columns).unionByName(junk.select(*columns))
    stream = ingest.with_retries(
        message_source.file_stream(spark, _message_files(spark, sf_dir)),
        message_source.file_stream(spark, _files(rows, "retry", "offset"), max_files=1))
    store = EventStore(spark, scratch_folder(spark, "store"))
    skipped = []
    ingest.drain(stream, store, scratch_folder(spark, "offsets"),
                 on_batch=lambda _, counts: skipped.append(counts["skipped"]))
    letters = store.dead_letters().where("retry_count > 0").drop("failed_at")
    return _plain(letters).withColumn("skipped", F.lit(sum(skipped)).cast("long"))


@query
def stream_sales(spark, sf_dir):
    events = fx.raw_events(spark, sf_dir)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(
        _files(events, "events", "event_id"))
    changes = scratch_folder(spark, "sales")
    sales_stream.start(stream, changes, scratch_folder(spark, "offsets"),
                       until_drained=True).awaitTermination()
    return _plain(sales_stream.current(spark, changes))


@query
def dedup_stream(spark, sf_dir):
    stream = message_source.file_stream(spark, _message_files(spark, sf_dir, "offset"), max_files=1)
    events = classify.valid_events(classify.classify(stream))
    once = dedup.drop_recent_stream(events).select("event_id")
    out = scratch_folder(spark, "ids")
    once.writeStream.format("parquet").option(
        "checkpointLocation", scratch_folder(spark, "offsets")).option("path", out).trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.schema("event_id string").parquet(out)
