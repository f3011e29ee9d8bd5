"""Schemas and fixed values of the event model."""

from __future__ import annotations

from pyspark.sql import types as T

# Event types and the keys each of them must carry.
REQUIRED_FIELDS = {
    "USER_SIGNUP": ["event_id", "event_type", "timestamp", "user_id"],
    "PRODUCT_VIEW": ["event_id", "event_type", "timestamp", "user_id", "product_id"],
    "ADD_TO_CART": ["event_id", "event_type", "timestamp", "user_id", "product_id", "quantity"],
    "CHECKOUT_STARTED": ["event_id", "event_type", "timestamp", "user_id"],
    "PURCHASE": [
        "event_id", "event_type", "timestamp", "user_id", "product_id", "quantity", "unit_price",
    ],
}
EVENT_TYPES = list(REQUIRED_FIELDS)

# Routing outcomes. The last two are also the reasons on dead letters.
VALID = "VALID"
UNPARSEABLE = "UNPARSEABLE"
VALIDATION_FAILED = "VALIDATION_FAILED"

WIRE_FIELDS = [
    "event_id", "event_type", "timestamp", "user_id", "product_id", "quantity", "unit_price",
]

MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

RAW_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("event_timestamp", T.TimestampType(), False),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DecimalType(10, 2)),
    T.StructField("ingested_at", T.TimestampType(), False),
    T.StructField("kafka_partition", T.IntegerType(), False),
    T.StructField("kafka_offset", T.LongType(), False),
])
# Physical partition column of the stored table.
RAW_TABLE_SCHEMA = T.StructType(RAW_SCHEMA.fields + [T.StructField("event_date", T.DateType())])

STAGING_COLUMNS = [
    "event_id", "event_type", "event_timestamp", "user_id", "product_id", "quantity", "unit_price",
]

DLQ_SCHEMA = T.StructType([
    T.StructField("dlq_id", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("errors", T.ArrayType(T.StringType())),
    T.StructField("original_topic", T.StringType()),
    T.StructField("original_partition", T.IntegerType()),
    T.StructField("original_offset", T.LongType()),
    T.StructField("raw_payload", T.StringType()),
    T.StructField("failed_at", T.StringType()),
    T.StructField("retry_count", T.IntegerType()),
])
DLQ_COLUMNS = DLQ_SCHEMA.fieldNames()

METRIC_SCHEMA = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
])
