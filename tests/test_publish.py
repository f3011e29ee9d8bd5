"""Tables replaced in one step: readers see the old one until the new one is whole and tested."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillstream.operators import quality
from tillstream.operators.classify import classify, valid_events
from tillstream.plans import warehouse
from tillstream.plans.publish import Published
from tillstream.streaming import sales as sales_stream


def table(spark, path):
    return Published(spark, str(path), "n long")


def numbers(frame):
    return sorted(r.n for r in frame.collect())


def test_replace_and_vacuum(spark, tmp_path):
    own = table(spark, tmp_path / "t")
    assert own.version() is None and own.current().count() == 0
    for n in range(1, 5):
        own.replace(spark.range(n).select(F.col("id").alias("n")))
        assert numbers(own.current()) == list(range(n))
        assert len(list((tmp_path / "t" / "versions").iterdir())) == min(n, 2)
    assert numbers(table(spark, tmp_path / "t").current()) == [0, 1, 2, 3]


def test_a_reader_keeps_its_version(spark, tmp_path):
    own = table(spark, tmp_path / "t")
    own.replace(spark.range(1).select(F.col("id").alias("n")))
    reader = own.current()
    own.replace(spark.range(5).select(F.col("id").alias("n")))
    assert numbers(reader) == [0] and own.current().count() == 5


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_path):
    own = table(spark, tmp_path / "t")
    own.replace(spark.range(2).select(F.col("id").alias("n")))
    broken = spark.range(100).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("gone"))).otherwise(F.col("id")).alias("n"))
    with pytest.raises(Exception, match="gone"):
        own.replace(broken)
    assert numbers(table(spark, tmp_path / "t").current()) == [0, 1]
    # What it left goes once newer versions are there.
    for _ in range(2):
        own.replace(spark.range(3).select(F.col("id").alias("n")))
    assert len(list((tmp_path / "t" / "versions").iterdir())) == 2


def test_a_cut_between_write_and_pointer(spark, tmp_path, monkeypatch):
    own = table(spark, tmp_path / "t")
    own.replace(spark.range(2).select(F.col("id").alias("n")))
    monkeypatch.setattr(Published, "publish", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        own.replace(spark.range(9).select(F.col("id").alias("n")))
    assert numbers(own.current()) == [0, 1]


def test_failed_data_tests_publish_nothing(spark, tmp_path):
    own = table(spark, tmp_path / "t")
    checks = [quality.Unique("n"), quality.NotNull("n")]
    report = own.replace(spark.range(3).select(F.col("id").alias("n")), checks)
    assert report.where("passed").count() == 2
    with pytest.raises(quality.DataTestFailure, match="unique_n: 1"):
        own.replace(spark.range(3).select((F.col("id") % 2).alias("n")), checks)
    assert numbers(own.current()) == [0, 1, 2]


def test_sales_stream_keeps_the_table_that_passed(spark, tmp_path, messages, event):
    """The second batch would publish a price the test forbids."""
    stored = str(tmp_path / "ev")
    checks = [quality.NoRowWhere("small_revenue", "revenue > 100")]

    def add(event_id, **changes):
        rows = valid_events(classify(messages([event(event_id=event_id, **changes)])))
        rows.withColumn("event_date", F.col("event_timestamp").cast("date")).write.mode(
            "append").parquet(stored)

    def drain():
        schema = spark.read.parquet(stored).schema
        stream = spark.readStream.schema(schema).parquet(stored)
        sales_stream.start(stream, str(tmp_path / "sales"), str(tmp_path / "o"),
                           until_drained=True, checks=checks).awaitTermination()

    add("a")
    drain()
    add("b", unit_price=5000)
    with pytest.raises(Exception, match="small_revenue: 1"):
        drain()
    rows = sales_stream.current(spark, str(tmp_path / "sales")).collect()
    assert [(r.orders, float(r.revenue)) for r in rows] == [(1, 39.98)]


def test_sales_state_is_not_put_into_one_task(spark, tmp_path, messages, event):
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "7")
    rows = valid_events(classify(messages([
        event(event_id=f"e{hour}", timestamp=f"2024-01-15T{hour:02}:00:00Z") for hour in range(24)])))
    rows.write.parquet(str(tmp_path / "ev"))
    stream = session.readStream.schema(rows.schema).parquet(str(tmp_path / "ev"))
    query = sales_stream.start(stream, str(tmp_path / "sales"), str(tmp_path / "o"),
                               until_drained=True)
    query.awaitTermination()
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(str(query.runId))]
    tasks = [tracker.getStageInfo(stage).numTasks for job in jobs for stage in job.stageIds]
    # The state's stage has a task per partition; before, one task held all their hash maps.
    assert 7 in tasks
    assert sales_stream.current(session, str(tmp_path / "sales")).count() == 24


def test_failing_build_leaves_the_sales_table(spark, tmp_path, messages, event):
    rows = valid_events(classify(messages([event(event_id="a")])))
    folder = str(tmp_path / "events")

    def store(frame):
        frame.withColumn("event_date", F.col("event_timestamp").cast("date")).write.mode(
            "append").partitionBy("event_date").parquet(folder)
        spark.catalog.recoverPartitions("raw.events")
        spark.catalog.refreshTable("raw.events")

    warehouse.create_layers(spark, str(tmp_path / "wh"))
    try:
        rows.withColumn("event_date", F.col("event_timestamp").cast("date")).write.partitionBy(
            "event_date").parquet(folder)
        warehouse.register_events(spark, folder)
        warehouse.build_sales(spark)
        before = spark.table("analytics.sales_by_interval").collect()
        # Staging tests fail: an id twice.
        store(rows)
        with pytest.raises(quality.DataTestFailure, match="unique_event_id"):
            warehouse.build_sales(spark)
        assert spark.table("analytics.sales_by_interval").collect() == before
        # The model's own tests fail on the staged version.
        model = spark.table("analytics.sales_by_interval").withColumn("orders", -F.col("orders"))
        with pytest.raises(quality.DataTestFailure, match="non_negative"):
            warehouse.materialize(model, "analytics.sales_by_interval",
                                  checks=warehouse.SALES_CHECKS)
        assert spark.table("analytics.sales_by_interval").collect() == before
    finally:
        for layer in warehouse.LAYERS:
            spark.sql(f"DROP DATABASE {layer} CASCADE")
