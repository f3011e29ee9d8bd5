"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default all cores) choose the data and
the local cores; BENCH_QUERIES (comma separated) picks other queries. Each query runs warm, the
median of three runs counts. `messages_per_second` is the ingest stream over the message files.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from suite import fixtures  # noqa: E402
from suite.queries import QUERIES  # noqa: E402
from tillstream.session import build_session, scratch_folder  # noqa: E402
from tillstream.sinks.event_store import EventStore  # noqa: E402
from tillstream.sources.messages import file_stream  # noqa: E402
from tillstream.streaming import ingest  # noqa: E402

HEADLINE = [
    "sales_by_interval", "daily_sales", "revenue_in_range", "active_users", "conversion_rate",
    "event_breakdown", "product_performance", "customer_metrics", "top_products",
    "processing_latency", "validate_events", "route_counts", "dlq_records", "dedup_first",
    "dedup_ttl", "ingest_stats", "duplicate_summary", "retry_outcomes", "missing_ids",
    "counter_rate", "alert_lag", "lag_trend", "dq_report",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def ingest_rate(spark, sf_dir: str) -> tuple[float, float]:
    """Seconds and messages per second for the whole stream, from files to stored events."""
    folder = scratch_folder(spark, "messages")
    fixtures.messages(spark, sf_dir).write.parquet(folder)
    count = spark.read.parquet(folder).count()
    store = EventStore(spark, scratch_folder(spark, "store"))
    seconds = timed(lambda: ingest.drain(
        file_stream(spark, folder), store, scratch_folder(spark, "offsets")))
    return seconds, count / seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(cores), "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        def run(name=name):
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(3)), 3)
    stream, rate = ingest_rate(spark, sf_dir)
    seconds["stream_ingest"] = round(stream, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "messages_per_second": round(rate), "cpus": cores,
    }))


if __name__ == "__main__":
    main()
