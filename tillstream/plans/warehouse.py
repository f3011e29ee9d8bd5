"""The three layers as catalog databases, and how models are written into them.

A schema name is used exactly as given: raw, staging, analytics.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators import quality
from tillstream.plans.publish import Published
from tillstream.plans.sales import sales_by_interval, sales_totals
from tillstream.plans.staging import stg_events
from tillstream.schemas import EVENT_TYPES, RAW_TABLE_SCHEMA
from tillstream.session import prepare

LAYERS = ("raw", "staging", "analytics")

STAGING_CHECKS = [
    quality.Unique("event_id"), quality.NotNull("event_id"), quality.NotNull("event_type"),
    quality.AcceptedValues("event_type", tuple(EVENT_TYPES)), quality.NotNull("event_timestamp"),
]
SALES_CHECKS = [
    quality.Unique("interval_start"), quality.NotNull("interval_start"), quality.NotNull("orders"),
    quality.NotNull("units_sold"), quality.NotNull("revenue"),
    quality.NoRowWhere(
        "sales_by_interval_non_negative", "orders < 0 OR units_sold < 0 OR revenue < 0"),
]


def create_layers(spark: SparkSession, root: str) -> None:
    prepare(spark)
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root}/{layer}'")


def register_events(spark: SparkSession, path: str) -> None:
    """Makes a stored events folder known as `raw.events`, with the partitions it has now."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_TABLE_SCHEMA)
    spark.sql(f"CREATE TABLE IF NOT EXISTS raw.events ({columns}) USING parquet "
              f"PARTITIONED BY (event_date) LOCATION '{path}'")
    spark.catalog.recoverPartitions("raw.events")


def staging_events(spark: SparkSession) -> DataFrame:
    return stg_events(spark.table("raw.events"))


def create_staging_view(spark: SparkSession) -> None:
    """`staging.stg_events` as a view; Spark inlines it into whatever reads it."""
    names = ", ".join(staging_events(spark).columns)
    spark.sql(f"CREATE OR REPLACE VIEW staging.stg_events AS SELECT {names} FROM raw.events")


def materialize(model: DataFrame, table: str, partition_by: str | None = None,
                checks: list | None = None) -> DataFrame | None:
    """Rebuilds a table from scratch; returns the report of its data tests.

    The new rows are written aside and tested there. Only then the catalog's location is set to them,
    in one step: until then, and for good if a test fails, the table stays as it was.
    """
    spark = model.sparkSession
    layer, name = table.split(".")
    root = spark.catalog.getDatabase(layer).locationUri
    versions = Published(spark, f"{root}/_{name}", model.schema)
    version, report = versions.stage(model, partition_by), None
    if checks:
        report = quality.report(versions.rows(version), checks)
        quality.enforce(report)
    folder = versions.folder(version)
    known = spark.catalog.tableExists(table) and not partition_by
    if known and spark.table(table).schema == model.schema:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        # Of partitions the catalog knows the folders one by one, so such a table is described anew.
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in model.schema)
        split = f"PARTITIONED BY ({partition_by})" if partition_by else ""
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {split} LOCATION '{folder}'")
        if partition_by:
            spark.catalog.recoverPartitions(table)
    versions.publish(version)
    versions.vacuum()
    return report


def build_sales(spark: SparkSession) -> DataFrame:
    """Runs and tests the models in order and returns the test report. A failed test raises, and the
    sales table of the build before stays."""
    create_staging_view(spark)
    staged = spark.table("staging.stg_events")
    report = quality.report(staged, STAGING_CHECKS)
    quality.enforce(report)
    return report.unionByName(materialize(
        sales_by_interval(staged), "analytics.sales_by_interval", checks=SALES_CHECKS))


def refresh_sales(events: DataFrame, path: str, first: date, last: date) -> None:
    """Recomputes the days `first` to `last` of a sales folder split by day; others stay."""
    days = events.where(F.col("event_date").between(F.lit(first), F.lit(last)))
    rows = sales_totals(days).withColumn("sale_date", F.col("interval_start").cast("date"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "sale_date").parquet(path)
