from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstream.functions.timing import time_range
from tillstream.operators import quality, topics
from tillstream.operators.classify import classify, valid_events
from tillstream.plans import accounting, business, sales, snapshot, warehouse
from tillstream.settings import Settings
from tillstream.sinks import messages as message_sink
from tillstream.sinks.event_store import EventStore
from tillstream.sources import messages as message_source
from tillstream.sources import relational


@pytest.fixture
def golden(spark, messages, event):
    """Three order lines at noon: 3 orders, 8 units, 105.48."""
    lines = [(2, 19.99), (1, 49.50), (5, 3.20)]
    return valid_events(classify(messages([
        event(event_id=f"g{i}", timestamp="2020-06-15T12:00:00Z", quantity=q, unit_price=p)
        for i, (q, p) in enumerate(lines)])))


def test_golden_totals(golden):
    row = sales.sales_by_interval(golden).first()
    assert row.asDict() == {
        "interval_start": datetime(2020, 6, 15, 12), "orders": 3, "units_sold": 8,
        "revenue": Decimal("105.48")}
    assert sales.daily_sales(golden).first().sale_date == date(2020, 6, 15)


def test_interval_borders(messages, event):
    rows = valid_events(classify(messages([
        event(event_id=str(i), timestamp=f"2020-06-15T12:{m}Z")
        for i, m in enumerate(["14:59", "15:00", "29:59"])])))
    assert [(r.interval_start.minute, r.orders) for r in sales.sales_by_interval(rows).collect()
            ] == [(0, 1), (15, 2)]


def test_partial_aggregation_and_pruning(spark, tmp_path, golden):
    golden.write.parquet(str(tmp_path / "raw"))
    plan = sales.sales_totals(spark.read.parquet(str(tmp_path / "raw")))._jdf.queryExecution(
        ).executedPlan().toString()
    assert "partial_sum" in plan and "EqualTo(event_type,PURCHASE)" in plan
    assert "product_id" not in plan


def test_time_range_reaches_the_partitions(spark, tmp_path, golden):
    store = EventStore(spark, str(tmp_path))
    store.insert(golden)
    rows = time_range(store.events(), "2020-06-15 11:00:00", "2020-06-15 12:00:00")
    assert rows.count() == 3
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_layers_build_and_tests(spark, tmp_path, golden):
    store = EventStore(spark, str(tmp_path / "store"))
    store.insert(golden)
    warehouse.create_layers(spark, str(tmp_path / "wh"))
    warehouse.register_events(spark, store.events_path)
    try:
        report = warehouse.build_sales(spark)
        assert report.where("passed").count() == report.count() == 11
        assert spark.table("analytics.sales_by_interval").first().revenue == Decimal("105.48")
        assert spark.table("staging.stg_events").columns == warehouse.staging_events(spark).columns
        store.insert(golden.withColumn("event_id", F.lit("more")).limit(1))
        spark.catalog.recoverPartitions("raw.events")
        spark.catalog.refreshTable("raw.events")
        warehouse.build_sales(spark)
        assert spark.table("analytics.sales_by_interval").first().orders == 4
    finally:
        for layer in warehouse.LAYERS:
            spark.sql(f"DROP DATABASE {layer} CASCADE")


def test_refresh_replaces_only_the_days_asked_for(spark, tmp_path, messages, event):
    rows = valid_events(classify(messages([
        event(event_id=str(d), timestamp=f"2020-06-{d}T12:00:00Z") for d in (15, 16)])))
    rows = rows.withColumn("event_date", F.col("event_timestamp").cast("date"))
    path = str(tmp_path / "sales")
    warehouse.refresh_sales(rows, path, date(2020, 6, 15), date(2020, 6, 16))
    doubled = rows.unionByName(rows)
    warehouse.refresh_sales(doubled, path, date(2020, 6, 16), date(2020, 6, 16))
    found = spark.read.parquet(path).orderBy("interval_start").collect()
    assert [r.orders for r in found] == [1, 2]


def test_failing_data_tests(spark):
    rows = spark.createDataFrame([("a", "X", -1), ("a", "Y", 1), (None, "Z", 1)],
                                 "id string, kind string, n int")
    report = quality.report(rows, [
        quality.Unique("id"), quality.NotNull("id"), quality.AcceptedValues("kind", ("X",)),
        quality.NoRowWhere("n_not_negative", "n < 0"), quality.NotNull("kind")])
    assert {r["check"]: r.failures for r in report.collect()} == {
        "unique_id": 1, "not_null_id": 1, "accepted_values_kind": 2, "n_not_negative": 1,
        "not_null_kind": 0}
    with pytest.raises(quality.DataTestFailure, match="unique_id: 1"):
        quality.enforce(report)


def test_empty_range(golden):
    nothing = golden.where("false")
    assert business.revenue(nothing).first().revenue is None
    assert business.orders(nothing).first().orders == 0
    assert business.conversion_rate(nothing).first().conversion_rate == 0.0


def test_conversion_and_products(messages, event):
    rows = valid_events(classify(messages(
        [event(event_id=f"v{i}", event_type="PRODUCT_VIEW") for i in range(3)] + [event()])))
    assert business.conversion_rate(rows).first().conversion_rate == 33.33
    assert business.product_performance(rows).first().asDict() == {
        "product_id": "prod_1", "views": 3, "cart_additions": 0, "purchases": 1,
        "revenue": Decimal("39.98"), "conversion_rate": 33.33}
    assert {r.event_type: r.share for r in business.type_mix(rows).collect()} == {
        "PRODUCT_VIEW": 75.0, "PURCHASE": 25.0}


def test_recent_prefix_and_user(golden):
    assert [r.event_id for r in business.recent_events(golden, 2).collect()] == ["g2", "g1"]
    assert business.with_id_prefix(golden, "g1").count() == 1
    assert business.without_id_prefix(golden, "g1").count() == 2
    assert business.user_events(golden, "user_1").count() == 3


def test_accounting(messages, event, spark):
    rows = [event(event_id="old")] + [event(event_id="a")] * 3 + ["{"]
    frame = messages(rows).withColumn("timestamp", F.timestamp_seconds(F.col("offset") * 200))
    stored = spark.createDataFrame([("old",)], "event_id string")
    assert accounting.ingest_stats(classify(frame), stored).first().asDict() == {
        "consumed": 5, "inserted": 1, "cache_dup": 1, "db_dup": 2, "invalid": 1}


def test_snapshot_round_trip(spark, tmp_path, golden):
    snapshot.write_snapshot(golden, str(tmp_path), "20200615")
    restored = snapshot.read_snapshot(spark, str(tmp_path), "20200615").drop("snapshot")
    stamped = golden.drop("ingested_at")
    assert snapshot.difference(stamped, restored.drop("ingested_at")).isEmpty()
    twice = stamped.unionByName(stamped)
    changed = snapshot.difference(twice, restored.drop("ingested_at")).collect()
    assert [(r.only_in, r.copies) for r in changed] == [("left", 1)] * 3


def test_topic_views(messages):
    rows = messages(['{"b": 1, "a": 2}', "plain"], first_offset=5).unionByName(
        messages(["x"], partition=1))
    found = topics.summary(rows).orderBy("partition").collect()
    assert [(r.partition, r.low, r.high, r.messages) for r in found] == [
        (None, None, None, 3), (0, 5, 7, 2), (1, 0, 1, 1)]
    assert [r.value for r in topics.peek(rows, 2).collect()] == ['{"b":1,"a":2}', "plain"]
    assert topics.one_partition(rows, 1).count() == 1


def test_message_sink_counts_and_keys(spark, tmp_path, golden):
    sent = message_sink.to_messages(golden)
    assert message_sink.write_files(sent, str(tmp_path / "out")) == 3
    row = spark.read.parquet(str(tmp_path / "out")).orderBy("value").first()
    assert bytes(row.key) == b"user_1"
    assert bytes(row.value).decode() == (
        '{"event_id":"g0","event_type":"PURCHASE","timestamp":"2020-06-15T12:00:00Z",'
        '"user_id":"user_1","product_id":"prod_1","quantity":2,"unit_price":19.99}')
    assert message_sink.write_files(sent.where("false"), str(tmp_path / "none")) == 0
    nobody = golden.withColumn("user_id", F.lit(None).cast("string"))
    assert message_sink.to_messages(nobody).first().key is None


def test_source_options(monkeypatch):
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "broker:1")
    monkeypatch.setenv("KAFKA_TOPIC", "mine")
    monkeypatch.setenv("POSTGRES_PORT", "6000")
    settings = Settings()
    assert message_source.kafka_options(settings) == {
        "kafka.bootstrap.servers": "broker:1", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "subscribe": "mine", "groupIdPrefix": "ingestion-service"}
    assert message_source.kafka_options(settings, settings.retry_topic)["groupIdPrefix"] == (
        "retry-service")
    picked = message_source.kafka_options(settings, partitions=[2], starting="latest")
    assert picked["assign"] == '{"mine": [2]}' and picked["startingOffsets"] == "latest"
    assert relational.jdbc_options(settings, "raw.events")["url"] == (
        "jdbc:postgresql://localhost:6000/ecommerce")
