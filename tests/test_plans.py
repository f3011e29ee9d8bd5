"""What the physical strategy of a query must not do."""

from __future__ import annotations

import pytest

from suite.queries import QUERIES
from tillstream.operators import dedup
from tillstream.plans import business

SF_DIR = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name, parsers", [
    ("parse_events", 1), ("normalize_events", 1), ("validate_events", 1),
    # Message and record, then the record's payload as well.
    ("dlq_replay", 2), ("retry_outcomes", 3), ("dq_report", 0),
])
def test_each_text_is_parsed_once(spark, name, parsers):
    assert plan(QUERIES[name](spark, SF_DIR)).count("from_json(") == parsers


def test_shares_need_one_scan(spark):
    rows = spark.range(100).selectExpr("cast(id % 3 AS string) AS event_type")
    text = business.type_mix(rows)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Range (") == 1


def test_no_window_over_a_whole_id(spark):
    """Sightings of an id are ordered per span, spans per slice; only slices over a whole id."""
    times = spark.range(10).selectExpr("'a' AS k", "id * 1000000 AS at")
    text = dedup._next_anchor(times, "k", 70)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert len(windows) == 3
    assert sum(", [k#" in line and "], [slice#" in line for line in windows) == 1
