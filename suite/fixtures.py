"""The engine's inputs, derived from the given tables. Everything covers the whole table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstream.operators.classify import classify
from tillstream.operators.deadletter import build_dlq, dlq_messages, read_dlq, reprocess
from tillstream.session import prepare
from tillstream.sources.messages import spread

TOPIC = "shop"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# The events table in shop terms.
MAPPED = [
    "event_id AS n",
    "concat('evt_', event_id) AS event_id",
    "CASE event_type WHEN 'signup' THEN 'USER_SIGNUP' WHEN 'view' THEN 'PRODUCT_VIEW' "
    "WHEN 'click' THEN 'ADD_TO_CART' WHEN 'purchase' THEN 'PURCHASE' "
    "WHEN 'error' THEN 'CHECKOUT_STARTED' END AS event_type",
    "cast(ts AS timestamp) AS event_timestamp",
    "concat('user_', user_id) AS user_id",
    "CASE WHEN event_type IN ('view', 'click', 'purchase') "
    "THEN concat('prod_', regexp_extract(props, '([0-9]+)', 1)) END AS product_id",
    "CASE WHEN event_type IN ('click', 'purchase') THEN cast(event_id % 5 + 1 AS int) END "
    "AS quantity",
    "CASE WHEN event_type = 'purchase' THEN cast(value AS decimal(10,2)) END AS unit_price",
    "cast(user_id % 3 AS int) AS kafka_partition",
]


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*MAPPED)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted events as the raw table holds them; stored n % 90 seconds after they happened."""
    return _mapped(spark, sf_dir).selectExpr(
        "event_id", "event_type", "event_timestamp", "user_id", "product_id", "quantity",
        "unit_price", "event_timestamp + make_dt_interval(0, 0, 0, n % 90) AS ingested_at",
        "kafka_partition", "cast(n AS bigint) AS kafka_offset",
        "cast(event_timestamp AS date) AS event_date")


def _payload(event_type: str, time: str, user: str, quantity: str, price: str) -> str:
    return f"""concat('{{"event_id": "', event_id, '", "event_type": "', {event_type},
        '", "timestamp": "', {time}, '"', {user},
        coalesce(concat(', "product_id": "', product_id, '"'), ''),
        coalesce(concat(', "quantity": ', {quantity}), ''),
        coalesce(concat(', "unit_price": ', {price}), ''), '}}')"""


ISO = "date_format(event_timestamp, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
USER = """concat(', "user_id": "', user_id, '"')"""
CLEAN_PAYLOAD = _payload("event_type", ISO, USER, "quantity", "unit_price")
# Faults by c = n % 100: cut off, no user, bad quantity, price or time, unknown type; 6 is messy
# but good; 8 has a line separator that is no JSON space behind it, 9 a line end in its time.
FAULTY_PAYLOAD = f"""CASE WHEN c = 0 THEN concat('{{"event_id": "', event_id, '", "event_type"')
    ELSE {_payload(
        "CASE c WHEN 5 THEN 'UNKNOWN_EVENT' WHEN 6 THEN lower(event_type) ELSE event_type END",
        f"CASE c WHEN 4 THEN 'not-a-timestamp' WHEN 9 THEN concat({ISO}, '\\\\n') ELSE {ISO} END",
        f"CASE c WHEN 1 THEN '' ELSE {USER} END",
        """CASE WHEN c = 2 AND quantity IS NOT NULL THEN '"INVALID"'
            WHEN c = 6 THEN concat('"', quantity, '"') ELSE cast(quantity AS string) END""",
        """CASE WHEN c = 3 AND unit_price IS NOT NULL THEN '"N/A"'
            WHEN c = 6 THEN concat('"', unit_price, '"') ELSE cast(unit_price AS string) END""",
    )} END || CASE WHEN c <> 8 THEN '' WHEN n % 200 = 8 THEN '\\u2028' ELSE '\\u0085' END"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic rows with faults by n % 100; n % 100 % 33 = 7 is sent twice, n % 10 minutes apart."""
    rows = spread(table(spark, sf_dir, "events")).selectExpr(*MAPPED).selectExpr(
        "*", "n % 100 AS c")
    sent = rows.selectExpr(
        "*", "explode(if(c % 33 = 7, array(0, 1), array(0))) AS copy")
    return sent.selectExpr(
        "cast(user_id AS binary) AS key",
        f"cast({FAULTY_PAYLOAD} AS binary) AS value",
        f"'{TOPIC}' AS topic",
        "kafka_partition AS partition",
        "cast(2 * n + copy AS bigint) AS offset",
        "event_timestamp + make_dt_interval(0, 0, cast(copy * (n % 10) AS int), 0) AS timestamp")


def clean_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`event number -> faultless payload`, the correction an operator would replay."""
    return _mapped(spark, sf_dir).selectExpr("n", f"{CLEAN_PAYLOAD} AS clean_payload")


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(messages(spark, sf_dir))


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier run already stored: events before 15 January 2024."""
    return raw_events(spark, sf_dir).where(F.col("event_timestamp") < "2024-01-15")


def dlq_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of the faulty messages; they failed when they were sent."""
    return build_dlq(classified(spark, sf_dir), F.col("timestamp"))


def retry_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replayed dead letters: n % 5 attempts so far, corrected payload where n is even.

    Where n ends in 3 a letter comes twice, with different payloads that are both still wrong;
    where it ends in 7 the record does not say where the message came from.
    """
    records = dlq_records(spark, sf_dir).withColumn(
        "n", F.floor(F.col("original_offset") / 2).cast("long"))
    rows = records.join(clean_payloads(spark, sf_dir), "n").withColumn("copy", F.explode(
        F.when(F.col("n") % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    rows = rows.withColumns({
        "retry_count": (F.col("n") % 5).cast("int"),
        "raw_payload": F.when(F.col("n") % 2 == 0, F.col("clean_payload")).otherwise(
            F.concat("raw_payload", F.when(F.col("copy") == 1, " ").otherwise(""))),
        **{name: F.when(F.col("n") % 10 != 7, F.col(name)) for name in (
            "original_topic", "original_partition", "original_offset")},
    })
    # Retry messages stand at offsets of their own.
    return dlq_messages(rows, F.lit("retry").alias("topic"), F.lit(0).alias("partition"),
                        (2 * F.col("n") + F.col("copy")).alias("offset"))


def retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reprocess(read_dlq(retry_messages(spark, sf_dir)))


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour, user group and type, the base of all metric samples."""
    return table(spark, sf_dir, "events").groupBy(
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("ts"),
        (F.col("user_id") % 3).cast("string").alias("part"), "event_type",
    ).agg(F.count("*").alias("n"), F.max("value").alias("most"), F.min("value").alias("least"))


def _samples(rows: DataFrame, metric: str, labels: dict, value: Column) -> DataFrame:
    pairs = [part for name, text in labels.items() for part in (F.lit(name), text)]
    # Series are sampled at different seconds, by their first two labels.
    first, second = [*labels.values(), F.lit("")][:2]
    late = (len(metric) * 11 + F.ascii(first) * 3 + F.ascii(second) * 7) % 1800
    return rows.select(
        F.lit(metric).alias("metric"), F.create_map(*pairs).alias("labels"),
        (F.col("ts") + F.make_dt_interval(secs=late)).alias("ts"),
        value.cast("double").alias("value"))


def watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High watermark and committed offset (six samples earlier) per partition and hour."""
    hours = _hourly(spark, sf_dir).groupBy("part", "ts").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("part").orderBy("ts")
    high = hours.withColumn("high", F.sum("n").over(order))
    return high.select(
        F.lit(TOPIC).alias("topic"), F.col("part").cast("int").alias("partition"), "ts", "high",
        F.lag("high", 6).over(order).alias("committed"))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric samples `metric, labels, ts, value`, one per series and hour, seconds apart."""
    base = _hourly(spark, sf_dir)
    marks = watermarks(spark, sf_dir)
    lag = F.greatest(F.col("high") - F.coalesce("committed", F.lit(0)), F.lit(0))
    by_type = Window.partitionBy("event_type").orderBy("ts")
    types = base.groupBy("event_type", "ts").agg(
        F.sum("n").alias("n"), F.max("most").alias("most"), F.min("least").alias("least"))
    counts = types.withColumn("running", F.sum("n").over(by_type))
    instance = {"instance": F.col("event_type")}
    root = {"instance": F.col("event_type"), "mountpoint": F.lit("/")}
    parts = [
        _samples(marks, "kafka_topic_partition_current_offset",
                 {"topic": F.lit(TOPIC), "partition": F.col("partition").cast("string")},
                 F.col("high")),
        _samples(counts.where(F.col("event_type") == "error"),
                 "kafka_topic_partition_current_offset",
                 {"topic": F.lit(f"{TOPIC}-dlq"), "partition": F.lit("0")}, F.col("running")),
        _samples(marks.groupBy("ts").agg(F.sum(lag).alias("lag")), "kafka_consumergroup_lag_sum",
                 {"consumergroup": F.lit("ingestion-service"), "topic": F.lit(TOPIC)},
                 F.col("lag")),
        _samples(types.where(F.col("event_type") == "click"), "kafka_consumergroup_lag_sum",
                 {"consumergroup": F.lit("retry-service"), "topic": F.lit(f"{TOPIC}-retry")},
                 F.col("n")),
        _samples(marks.groupBy("ts").agg(F.count("*").alias("members")),
                 "kafka_consumergroup_members", {"consumergroup": F.lit("ingestion-service")},
                 F.col("members")),
        _samples(types, "up", {"job": F.col("event_type"), "instance": F.lit("a")},
                 (F.col("n") >= 2).cast("int")),
        _samples(counts, "node_cpu_seconds_total",
                 {"cpu": F.col("event_type"), "mode": F.lit("idle")}, F.col("running") % 200),
        _samples(types, "node_memory_MemTotal_bytes", instance, F.col("most")),
        _samples(types, "node_memory_MemAvailable_bytes", instance, F.col("least")),
        _samples(types, "node_filesystem_size_bytes", root, F.col("most")),
        _samples(types, "node_filesystem_avail_bytes", root, F.col("least")),
        _samples(types, "node_load1", instance, F.col("most")),
    ]
    return reduce(DataFrame.unionByName, parts)
