"""The registered queries in DuckDB SQL, written from the fault classes of the fixtures.

Messages are never parsed here: what each one must become is known from how it was made.
"""

from __future__ import annotations

from suite.queries import (
    DLQ_HOURS, DLQ_LIMIT, DLQ_RANGE_HOURS, DOWN_HOURS, LAG_HOURS, LAG_LIMIT, LOOKBACK, RANGE, RATE_RANGE,
    STEP,
)

RAW = """raw AS (
  SELECT event_id AS n, 'evt_' || event_id AS event_id,
    CASE event_type WHEN 'signup' THEN 'USER_SIGNUP' WHEN 'view' THEN 'PRODUCT_VIEW'
      WHEN 'click' THEN 'ADD_TO_CART' WHEN 'purchase' THEN 'PURCHASE'
      WHEN 'error' THEN 'CHECKOUT_STARTED' END AS event_type,
    ts AS event_timestamp, 'user_' || user_id AS user_id,
    CASE WHEN event_type IN ('view', 'click', 'purchase')
      THEN 'prod_' || regexp_extract(props, '([0-9]+)', 1) END AS product_id,
    CASE WHEN event_type IN ('click', 'purchase') THEN CAST(event_id % 5 + 1 AS INTEGER) END
      AS quantity,
    CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(10,2)) END AS unit_price,
    ts + to_seconds(event_id % 90) AS ingested_at,
    CAST(user_id % 3 AS INTEGER) AS kafka_partition, event_id AS kafka_offset
  FROM events)"""

MSG = RAW + """, faults AS (
  SELECT *, n % 100 AS c, date_trunc('second', event_timestamp) AS event_second,
    strftime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS iso,
    CAST(unit_price AS VARCHAR) AS price_text
  FROM raw), sent AS (
  SELECT *, unnest(CASE WHEN c % 33 = 7 THEN [0, 1] ELSE [0] END) AS copy,
    CASE WHEN c = 1 THEN 'missing required fields: [''user_id'']'
      WHEN c = 2 AND quantity IS NOT NULL THEN 'invalid quantity: ''INVALID'''
      WHEN c = 3 AND unit_price IS NOT NULL THEN 'invalid unit_price: ''N/A'''
      WHEN c = 4 THEN 'invalid timestamp: ''not-a-timestamp'''
      WHEN c = 9 THEN 'invalid timestamp: ''' || iso || '\\n'''
      WHEN c = 5 THEN 'unknown event_type: ''UNKNOWN_EVENT''' END AS fault,
    -- Prices must be above zero; some purchases in the table are not.
    CASE WHEN unit_price <= 0 AND c NOT IN (0, 3, 5, 8)
      THEN 'invalid unit_price: ' || CAST(CAST(unit_price AS DOUBLE) AS VARCHAR) END AS free,
    '{"event_id": "' || event_id || '", "event_type"' AS cut,
    '{"event_id": "' || event_id || '", "event_type": "'
      || CASE c WHEN 6 THEN lower(event_type) WHEN 5 THEN 'UNKNOWN_EVENT' ELSE event_type END
      || '", "timestamp": "' || CASE c WHEN 4 THEN 'not-a-timestamp' WHEN 9 THEN iso || '\\n' ELSE iso END || '"'
      || CASE c WHEN 1 THEN '' ELSE ', "user_id": "' || user_id || '"' END
      || coalesce(', "product_id": "' || product_id || '"', '')
      || CASE WHEN quantity IS NULL THEN '' WHEN c = 2 THEN ', "quantity": "INVALID"'
          WHEN c = 6 THEN ', "quantity": "' || quantity || '"'
          ELSE ', "quantity": ' || quantity END
      || CASE WHEN unit_price IS NULL THEN '' WHEN c = 3 THEN ', "unit_price": "N/A"'
          WHEN c = 6 THEN ', "unit_price": "' || price_text || '"'
          ELSE ', "unit_price": ' || price_text END || '}'
      || CASE WHEN c <> 8 THEN '' WHEN n % 200 = 8 THEN chr(8232) ELSE chr(133) END AS whole,
    '{"event_id": "' || event_id || '", "event_type": "' || event_type
      || '", "timestamp": "' || iso || '", "user_id": "' || user_id || '"'
      || coalesce(', "product_id": "' || product_id || '"', '')
      || coalesce(', "quantity": ' || quantity, '')
      || coalesce(', "unit_price": ' || price_text, '') || '}' AS clean_payload
  FROM faults), msg AS (
  SELECT *, CASE WHEN c IN (0, 8) THEN 'UNPARSEABLE' WHEN fault IS NOT NULL OR free IS NOT NULL
      THEN 'VALIDATION_FAILED' ELSE 'VALID' END AS outcome,
    CASE WHEN c IN (0, 8) THEN 'malformed JSON payload' WHEN fault IS NOT NULL OR free IS NOT NULL
      THEN concat_ws('; ', fault, free) END AS error,
    2 * n + copy AS "offset", event_timestamp + to_minutes(copy * (n % 10)) AS "timestamp",
    CASE WHEN c = 0 THEN cut ELSE whole END AS payload,
    CASE WHEN c IN (0, 8) THEN '["malformed JSON payload"]'
      ELSE '[' || concat_ws(',', '"' || replace(fault, '\\', '\\\\') || '"', '"' || free || '"') || ']' END AS errors
  FROM sent)"""

DLQ = MSG + """, dlq AS (
  SELECT *, user_id AS key, 'shop' AS original_topic, kafka_partition AS original_partition,
    "offset" AS original_offset, payload AS raw_payload,
    strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ') AS failed_at, 0 AS retry_count,
    md5('shop:' || kafka_partition || ':' || "offset" || ':0') AS dlq_id
  FROM msg WHERE outcome <> 'VALID'), sent_again AS (
  SELECT * REPLACE (unnest(CASE WHEN n % 10 = 3 THEN [0, 1] ELSE [0] END) AS copy) FROM dlq),
retry AS (
  SELECT * REPLACE (CAST(n % 5 AS INTEGER) AS retry_count,
      CASE WHEN n % 2 = 0 THEN clean_payload ELSE raw_payload || repeat(' ', copy) END
        AS raw_payload,
      CASE WHEN n % 10 = 7 THEN 'unknown' ELSE original_topic END AS original_topic,
      CASE WHEN n % 10 = 7 THEN -1 ELSE original_partition END AS original_partition,
      CASE WHEN n % 10 = 7 THEN -1 ELSE original_offset END AS original_offset),
    outcome AS reason, errors AS first_errors,
    CASE WHEN n % 2 = 1 THEN outcome WHEN unit_price <= 0 THEN 'VALIDATION_FAILED'
      ELSE 'VALID' END AS new_outcome,
    CASE WHEN n % 2 = 1 THEN errors WHEN unit_price <= 0 THEN '["invalid unit_price: '
      || CAST(CAST(unit_price AS DOUBLE) AS VARCHAR) || '"]' ELSE '[]' END AS new_errors
  FROM sent_again), again AS (
  SELECT key, md5(original_topic || ':' || original_partition || ':' || original_offset || ':'
      || (retry_count + 1) || ':' || md5(raw_payload) || ':retry:0:' || (2 * n + copy)) AS dlq_id,
    new_outcome AS reason, new_errors AS errors, original_topic, original_partition,
    original_offset, raw_payload, retry_count + 1 AS retry_count,
    CASE WHEN retry_count + 1 >= 3 THEN 'CRITICAL' ELSE 'WARNING' END AS severity
  FROM retry WHERE new_outcome <> 'VALID')"""

EVENT = "event_id, event_type, event_second AS event_timestamp, user_id, product_id, quantity"
PRICE = "CAST(unit_price AS DOUBLE) AS unit_price"
IN_RANGE = f"event_timestamp BETWEEN TIMESTAMP '{RANGE[0]}' AND TIMESTAMP '{RANGE[1]}'"
BUCKET = "time_bucket(INTERVAL '{}', event_timestamp, TIMESTAMP '1970-01-01')"
SALES = f"""sales AS (
  SELECT {BUCKET.format('15 minutes')} AS interval_start, count(*) AS orders,
    CAST(sum(quantity) AS BIGINT) AS units_sold,
    CAST(sum(quantity * unit_price) AS DOUBLE) AS revenue
  FROM raw WHERE event_type = 'PURCHASE' GROUP BY 1)"""
NEGATIVE_SALES = SALES.replace("FROM raw", """FROM (SELECT * REPLACE (
    CASE WHEN n % 3 = 0 THEN -quantity ELSE quantity END AS quantity) FROM raw)""")
FIRST = f"""SELECT {EVENT}, {PRICE}, kafka_partition, 2 * n AS kafka_offset
  FROM msg WHERE outcome = 'VALID' AND copy = 0"""


def _percent(part: str, whole: str) -> str:
    """Half-up to two digits in whole numbers."""
    return (f"CASE WHEN {whole} = 0 THEN 0.0 ELSE CAST((20000 * {part} + {whole}) "
            f"// (2 * {whole}) AS DOUBLE) / 100.0 END")


def _of(event_type: str) -> str:
    return f"count(*) FILTER (WHERE event_type = '{event_type}')"


REVENUE = "CAST(coalesce(sum(quantity * unit_price) FILTER (WHERE event_type = 'PURCHASE'), 0) AS DOUBLE)"

BASE = """base AS (
  SELECT date_trunc('hour', ts) AS ts, CAST(user_id % 3 AS VARCHAR) AS part, event_type,
    count(*) AS n, max(value) AS most, min(value) AS least
  FROM events GROUP BY ALL), hours AS (
  SELECT part, ts, sum(n) AS n FROM base GROUP BY ALL), high AS (
  SELECT part, ts, CAST(sum(n) OVER (PARTITION BY part ORDER BY ts) AS BIGINT) AS high FROM hours),
marks AS (
  SELECT *, lag(high, 6) OVER (PARTITION BY part ORDER BY ts) AS committed FROM high),
lags AS (SELECT 'shop' AS topic, CAST(part AS INTEGER) AS "partition", ts, high,
  coalesce(committed, 0) AS committed, greatest(high - coalesce(committed, 0), 0) AS lag
  FROM marks),
types AS (SELECT event_type, ts, sum(n) AS n, max(most) AS most, min(least) AS least
  FROM base GROUP BY ALL),
counts AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY ts) AS running FROM types),
hourly AS (
  SELECT 'kafka_topic_partition_current_offset' AS metric,
    '[{"key":"partition","value":"' || part || '"},{"key":"topic","value":"shop"}]' AS series,
    'shop' AS a, part AS b, ts, CAST(high AS DOUBLE) AS value FROM marks
  UNION ALL SELECT 'kafka_topic_partition_current_offset',
    '[{"key":"partition","value":"0"},{"key":"topic","value":"shop-dlq"}]', 'shop-dlq', '0', ts,
    CAST(running AS DOUBLE) FROM counts WHERE event_type = 'error'
  UNION ALL SELECT 'kafka_consumergroup_lag_sum',
    '[{"key":"consumergroup","value":"ingestion-service"},{"key":"topic","value":"shop"}]',
    'ingestion-service', 'shop', ts, CAST(sum(lag) AS DOUBLE) FROM lags GROUP BY ts
  UNION ALL SELECT 'kafka_consumergroup_lag_sum',
    '[{"key":"consumergroup","value":"retry-service"},{"key":"topic","value":"shop-retry"}]',
    'retry-service', 'shop-retry', ts, CAST(n AS DOUBLE) FROM types WHERE event_type = 'click'
  UNION ALL SELECT 'kafka_consumergroup_members',
    '[{"key":"consumergroup","value":"ingestion-service"}]', 'ingestion-service', NULL, ts,
    CAST(count(*) AS DOUBLE) FROM marks GROUP BY ts
  UNION ALL SELECT 'up',
    '[{"key":"instance","value":"a"},{"key":"job","value":"' || event_type || '"}]', event_type,
    'a', ts, CASE WHEN n >= 2 THEN 1.0 ELSE 0.0 END FROM types
  UNION ALL SELECT 'node_cpu_seconds_total',
    '[{"key":"cpu","value":"' || event_type || '"},{"key":"mode","value":"idle"}]', event_type,
    'idle', ts, CAST(running % 200 AS DOUBLE) FROM counts
  UNION ALL SELECT 'node_memory_MemTotal_bytes',
    '[{"key":"instance","value":"' || event_type || '"}]', event_type, NULL, ts, most FROM types
  UNION ALL SELECT 'node_memory_MemAvailable_bytes',
    '[{"key":"instance","value":"' || event_type || '"}]', event_type, NULL, ts, least FROM types
  UNION ALL SELECT 'node_filesystem_size_bytes',
    '[{"key":"instance","value":"' || event_type || '"},{"key":"mountpoint","value":"/"}]',
    event_type, '/', ts, most FROM types
  UNION ALL SELECT 'node_filesystem_avail_bytes',
    '[{"key":"instance","value":"' || event_type || '"},{"key":"mountpoint","value":"/"}]',
    event_type, '/', ts, least FROM types
  UNION ALL SELECT 'node_load1',
    '[{"key":"instance","value":"' || event_type || '"}]', event_type, NULL, ts, most FROM types),
metrics AS (
  SELECT * REPLACE (ts + to_seconds(
    (length(metric) * 11 + ascii(a) * 3 + coalesce(ascii(b), 0) * 7) % 1800) AS ts) FROM hourly)"""

STEPPED = f"""{BASE}, served AS (
  SELECT *, unnest(range({-(-LOOKBACK // STEP) + 1})) * {STEP}
    + CAST(ceil(epoch(ts) / {STEP}) AS BIGINT) * {STEP} AS step FROM metrics),
stepped AS (
  SELECT metric, series, a, b, make_timestamp(step * 1000000) AS ts, arg_max(value, served.ts) AS value
  FROM served WHERE step - epoch(served.ts) < {LOOKBACK} GROUP BY metric, series, a, b, step)"""


def _rate(condition: str, hours: int) -> str:
    return f"""{BASE}, step AS (
  SELECT *, value - lag(value) OVER s AS d FROM metrics WHERE {condition}
  WINDOW s AS (PARTITION BY series ORDER BY ts)), summed AS (
  SELECT *, sum(CASE WHEN d IS NULL THEN 0 WHEN d < 0 THEN value ELSE d END)
    OVER (PARTITION BY series ORDER BY ts) AS total FROM step), spans AS (
  SELECT *, first_value(total) OVER r AS first_total, first_value(ts) OVER r AS first_ts
  FROM summed WINDOW r AS (PARTITION BY series ORDER BY ts
    RANGE BETWEEN INTERVAL {hours} HOUR PRECEDING AND CURRENT ROW)), rates AS (
  SELECT metric, a, b, series, ts, (total - first_total) / (epoch(ts) - epoch(first_ts)) AS value
  FROM spans WHERE ts > first_ts)"""


def _rate_at_steps(condition: str, seconds: int) -> str:
    return f"""{BASE}, step AS (
  SELECT *, value - lag(value) OVER (PARTITION BY series ORDER BY ts) AS d
  FROM metrics WHERE {condition}), rises AS (
  SELECT *, CASE WHEN d IS NULL THEN 0 WHEN d < 0 THEN value ELSE d END AS rise,
    CAST(ceil(epoch(ts) / {STEP}) AS BIGINT) * {STEP} AS own FROM step), grid AS (
  SELECT DISTINCT series, own + k * {STEP} AS t FROM rises, range({seconds // STEP}) steps(k)),
rates AS (
  SELECT r.metric, r.a, r.b, r.series, make_timestamp(t * 1000000) AS ts,
    (sum(rise) - arg_min(rise, r.ts)) / (epoch(max(r.ts)) - epoch(min(r.ts))) AS value
  FROM grid g JOIN rises r ON r.series = g.series AND epoch(r.ts) <= t AND epoch(r.ts) > t - {seconds}
  GROUP BY r.metric, r.a, r.b, r.series, t HAVING max(r.ts) > min(r.ts))"""


def _islands(source: str, breach: str, hold_hours: int) -> str:
    return f"""marked AS (
  SELECT *, {breach} AS breach, lag({breach}) OVER s AS breach_before, lag(ts) OVER s AS ts_before
  FROM {source} WINDOW s AS (PARTITION BY series ORDER BY ts)), numbered AS (
  SELECT *, sum(CASE WHEN breach AND (ts_before IS NULL OR NOT breach_before
      OR ts - ts_before > INTERVAL 1 HOUR) THEN 1 ELSE 0 END)
    OVER (PARTITION BY series ORDER BY ts) AS island FROM marked), runs AS (
  SELECT *, min(ts) OVER (PARTITION BY series, island) AS active_since
  FROM numbered WHERE breach), alerts AS (
  SELECT *, CASE WHEN ts - active_since >= INTERVAL {hold_hours} HOUR THEN 'firing'
    ELSE 'pending' END AS state FROM runs)"""


def _ttl(key: str, hours: int) -> str:
    return f"""WITH RECURSIVE seen AS (
  SELECT DISTINCT CAST({key} AS {{kind}}) AS id, ts FROM events), kept AS (
  SELECT id, min(ts) AS ts FROM seen GROUP BY id
  UNION ALL
  SELECT k.id, min(s.ts) FROM kept k JOIN seen s
    ON s.id = k.id AND s.ts > k.ts + INTERVAL {hours} HOUR GROUP BY k.id)
SELECT id, ts AS kept_at FROM kept"""


ORACLES = {
    "topic_scan": f"""WITH {MSG} SELECT 'shop' AS topic, kafka_partition AS "partition", "offset",
        user_id AS key, payload AS value FROM msg""",
    "topic_partition_scan": f"""WITH {MSG} SELECT 'shop' AS topic, kafka_partition AS "partition",
        "offset", user_id AS key, payload AS value FROM msg WHERE kafka_partition = 1""",
    "topic_summary": f"""WITH {MSG}, per AS (SELECT 'shop' AS topic, kafka_partition AS p,
        min("offset") AS low, max("offset") + 1 AS high FROM msg GROUP BY ALL)
        SELECT topic, p AS "partition", low, high, high - low AS messages FROM per
        UNION ALL SELECT topic, NULL, NULL, NULL, CAST(sum(high - low) AS BIGINT) FROM per
        GROUP BY topic""",
    "topic_peek": f"""WITH {MSG} SELECT 'shop' AS topic, kafka_partition AS "partition", "offset",
        user_id AS key, CASE WHEN c IN (0, 8) THEN payload
          ELSE regexp_replace(replace(replace(payload, '": ', '":'), ', "', ',"'),
            '("unit_price":[0-9]+\\.[0-9])0}}$', '\\1}}') END AS value
        FROM msg ORDER BY kafka_partition, "offset" LIMIT 20""",
    "parse_events": f"""WITH {MSG} SELECT kafka_partition AS "partition", "offset",
        c NOT IN (0, 8) AS parsed, CASE WHEN c NOT IN (0, 8) THEN event_id END AS event_id
        FROM msg""",
    "normalize_events": f"""WITH {MSG} SELECT kafka_partition AS "partition", "offset",
        CASE c WHEN 5 THEN 'UNKNOWN_EVENT' ELSE event_type END AS event_type,
        CASE WHEN c NOT IN (4, 9) THEN event_second END AS event_timestamp,
        CASE WHEN c <> 2 THEN quantity END AS quantity,
        CASE WHEN c <> 3 THEN CAST(unit_price AS DOUBLE) END AS unit_price
        FROM msg WHERE c NOT IN (0, 8)""",
    "validate_events": f"""WITH {MSG} SELECT kafka_partition AS "partition", "offset", outcome,
        errors FROM msg""",
    "valid_events": f"""WITH {MSG} SELECT {EVENT}, {PRICE}, kafka_partition,
        "offset" AS kafka_offset FROM msg WHERE outcome = 'VALID'""",
    "route_counts": f"WITH {MSG} SELECT outcome, count(*) AS messages FROM msg GROUP BY outcome",
    "shape_check": f"""WITH {MSG} SELECT fault IS NULL AND c NOT IN (0, 6, 8) AS well_shaped,
        count(*) AS messages FROM msg GROUP BY 1""",
    "dlq_error_text": f"""WITH {MSG} SELECT kafka_partition AS "partition", "offset",
        error AS text FROM msg WHERE error IS NOT NULL""",
    "to_messages": f"""WITH {RAW} SELECT user_id AS key, '{{"event_id":"' || event_id
        || '","event_type":"' || event_type || '","timestamp":"'
        || strftime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') || '","user_id":"' || user_id || '"'
        || coalesce(',"product_id":"' || product_id || '"', '')
        || coalesce(',"quantity":' || quantity, '')
        || coalesce(',"unit_price":' || unit_price, '') || '}}' AS value FROM raw""",
    "idempotent_insert": f"""WITH {MSG} SELECT event_id, event_type, event_timestamp, user_id,
        product_id, quantity, {PRICE}, kafka_partition, kafka_offset FROM raw
        WHERE event_timestamp < TIMESTAMP '2024-01-15'
        UNION ALL {FIRST} AND event_timestamp >= TIMESTAMP '2024-01-15'""",
    "snapshot_diff": f"""WITH {MSG} SELECT event_id, event_type, user_id, product_id, quantity,
        {PRICE}, CASE WHEN outcome = 'VALID' THEN 'right' ELSE 'left' END AS only_in,
        CAST(1 AS BIGINT) AS copies FROM msg
        WHERE (outcome <> 'VALID' AND copy = 0) OR (outcome = 'VALID' AND copy = 1)""",
    "snapshot_partitions": f"""WITH {MSG} SELECT event_id, event_type, user_id, product_id, quantity,
        {PRICE}, CASE WHEN outcome = 'VALID' THEN 'right' ELSE 'left' END AS only_in,
        CAST(1 AS BIGINT) AS copies FROM msg
        WHERE (outcome <> 'VALID' AND copy = 0) OR (outcome = 'VALID' AND copy = 1)""",
    "delete_prefix": f"""WITH {RAW} SELECT event_id, event_type, event_timestamp, user_id,
        product_id, quantity FROM raw WHERE event_id NOT LIKE 'evt\\_1%' ESCAPE '\\'""",
    "dedup_first": f"WITH {MSG} {FIRST}",
    "dedup_ttl": f"""WITH {MSG}, gaps AS (SELECT *, lag("timestamp") OVER (
          PARTITION BY event_id ORDER BY "timestamp", "offset") AS before
        FROM msg WHERE outcome = 'VALID')
        SELECT event_id, "timestamp", kafka_partition AS "partition", "offset" FROM gaps
        WHERE before IS NULL OR "timestamp" - before > INTERVAL 300 SECOND""",
    "dedup_ttl_by_user": _ttl("user_id", 6).format(kind="BIGINT"),
    "dedup_ttl_hot_key": _ttl("event_type", 1).format(kind="VARCHAR"),
    "duplicate_summary": f"""WITH {MSG}, copies AS (
          SELECT event_id, count(*) AS n FROM msg WHERE c NOT IN (0, 8) GROUP BY 1)
        SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_ids,
        count(*) FILTER (WHERE n > 1) AS repeated_ids,
        CAST(sum(n - 1) AS BIGINT) AS surplus_copies FROM copies""",
    "ingest_stats": f"""WITH {MSG}, v AS (SELECT *, copy = 1 AND n % 10 <= 5 AS recent
          FROM msg WHERE outcome = 'VALID')
        SELECT (SELECT count(*) FROM msg) AS consumed,
        count(*) FILTER (WHERE copy = 0 AND event_timestamp >= TIMESTAMP '2024-01-15') AS inserted,
        count(*) FILTER (WHERE recent) AS cache_dup,
        count(*) FILTER (WHERE NOT recent AND NOT (copy = 0
          AND event_timestamp >= TIMESTAMP '2024-01-15')) AS db_dup,
        (SELECT count(*) FROM msg WHERE outcome <> 'VALID') AS invalid FROM v""",
    "uniqueness_check": f"""WITH {MSG} SELECT count(*) AS total,
        count(DISTINCT event_id) AS distinct_ids, count(*) <> count(DISTINCT event_id) AS mismatch
        FROM msg WHERE outcome = 'VALID'""",
    "missing_ids": f"""WITH {MSG} SELECT event_id FROM raw EXCEPT
        SELECT event_id FROM msg WHERE outcome = 'VALID'""",
    "dlq_records": f"""WITH {DLQ} SELECT key, dlq_id, outcome AS reason, errors, original_topic,
        original_partition, original_offset, raw_payload, failed_at, retry_count FROM dlq""",
    "failed_by_reason": f"""WITH {DLQ} SELECT outcome AS reason, count(*) AS failed FROM dlq
        GROUP BY 1""",
    "dlq_replay": f"""WITH {DLQ} SELECT key, '{{"dlq_id":"' || dlq_id || '","reason":"' || reason
        || '","errors":' || errors || CASE WHEN n % 10 = 7 THEN
          ',"original_topic":null,"original_partition":null,"original_offset":null'
          ELSE ',"original_topic":"shop","original_partition":' || original_partition
            || ',"original_offset":' || original_offset END || ',"raw_payload":"'
        || replace(replace(raw_payload, '\\', '\\\\'), '"', '\\"') || '","failed_at":"' || failed_at
        || '","retry_count":' || retry_count || '}}' AS value FROM retry WHERE retry_count < 3""",
    "dlq_listing": f"""WITH {DLQ} SELECT dlq_id, reason, retry_count, '[' || original_topic || ' p'
        || original_partition || ' o' || original_offset || ']' AS original FROM retry""",
    "retry_outcomes": f"""WITH {DLQ} SELECT dlq_id AS retried_id, new_outcome AS outcome,
        new_errors AS errors FROM retry""",
    "retry_requeued": f"WITH {DLQ} SELECT * FROM again",
    "retry_recovered": f"""WITH {DLQ} SELECT {EVENT}, {PRICE}, kafka_partition,
        original_offset AS kafka_offset FROM retry WHERE new_outcome = 'VALID'""",
    "retry_stats": f"""WITH {DLQ} SELECT count(*) AS consumed,
        count(*) FILTER (WHERE new_outcome = 'VALID') AS recovered,
        count(*) FILTER (WHERE new_outcome <> 'VALID') AS sent_back FROM retry""",
    "stg_events": f"""WITH {RAW} SELECT event_id, event_type, event_timestamp, user_id,
        product_id, quantity, {PRICE} FROM raw""",
    "user_events": f"""WITH {RAW} SELECT event_id, event_type, event_timestamp, user_id,
        product_id, quantity, {PRICE}, ingested_at, kafka_partition, kafka_offset FROM raw
        WHERE user_id = 'user_7'""",
    "event_lookup": f"""WITH {RAW} SELECT event_id, event_type, event_timestamp, user_id,
        product_id, quantity FROM raw WHERE event_id IN ('evt_12', 'evt_77', 'evt_')""",
    "prefix_lookup": f"""WITH {RAW} SELECT event_id, event_type, event_timestamp, user_id,
        product_id, quantity FROM raw WHERE event_id LIKE 'evt\\_12%' ESCAPE '\\'""",
    "recent_events": f"""WITH {RAW} SELECT event_id, event_type, event_timestamp, user_id,
        product_id, quantity, {PRICE}, ingested_at, kafka_partition, kafka_offset FROM raw
        ORDER BY ingested_at DESC, kafka_offset DESC, kafka_partition DESC LIMIT 20""",
    "event_breakdown": f"""WITH {RAW} SELECT event_type, count(*) AS count FROM raw
        WHERE {IN_RANGE} GROUP BY event_type ORDER BY count DESC, event_type""",
    "sales_by_interval": f"WITH {RAW}, {SALES} SELECT * FROM sales ORDER BY interval_start",
    "sales_read": f"""WITH {RAW}, {SALES} SELECT interval_start AS time, revenue FROM sales
        WHERE {IN_RANGE.replace('event_timestamp', 'interval_start')} ORDER BY 1""",
    "daily_sales": f"""WITH {RAW} SELECT CAST(CAST(event_timestamp AS DATE) AS VARCHAR)
        AS sale_date, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS units_sold,
        CAST(sum(quantity * unit_price) AS DOUBLE) AS revenue
        FROM raw WHERE event_type = 'PURCHASE' GROUP BY 1""",
    "orders_in_range": f"""WITH {RAW} SELECT count(*) AS orders FROM raw
        WHERE event_type = 'PURCHASE' AND {IN_RANGE}""",
    "revenue_in_range": f"""WITH {RAW} SELECT CAST(sum(quantity * unit_price) AS DOUBLE)
        AS revenue FROM raw WHERE event_type = 'PURCHASE' AND {IN_RANGE}""",
    "units_in_range": f"""WITH {RAW} SELECT CAST(sum(quantity) AS BIGINT) AS units_sold FROM raw
        WHERE event_type = 'PURCHASE' AND {IN_RANGE}""",
    "active_users": f"""WITH {RAW} SELECT count(DISTINCT user_id) AS active_users FROM raw
        WHERE {IN_RANGE}""",
    "conversion_rate": f"""WITH {RAW}, k AS (SELECT {_of('PURCHASE')} AS p,
        {_of('PRODUCT_VIEW')} AS v FROM raw WHERE {IN_RANGE})
        SELECT {_percent('p', 'v')} AS conversion_rate FROM k""",
    "row_count": "SELECT count(*) AS rows FROM events",
    "type_mix": f"""WITH {RAW} SELECT event_type, count(*) AS count,
        round(100 * count(*) / (SELECT count(*) FROM raw), 1) AS share FROM raw
        GROUP BY event_type""",
    "product_performance": f"""WITH {RAW}, k AS (SELECT product_id, {_of('PRODUCT_VIEW')} AS views,
        {_of('ADD_TO_CART')} AS cart_additions, {_of('PURCHASE')} AS purchases,
        {REVENUE} AS revenue FROM raw WHERE product_id IS NOT NULL GROUP BY 1)
        SELECT *, {_percent('purchases', 'views')} AS conversion_rate FROM k""",
    "customer_metrics": f"""WITH {RAW} SELECT user_id, {_of('PRODUCT_VIEW')} AS total_views,
        {_of('ADD_TO_CART')} AS total_cart_additions, {_of('PURCHASE')} AS total_purchases,
        {REVENUE} AS total_revenue FROM raw GROUP BY 1""",
    "conversion_metrics": f"""WITH {RAW}, k AS (
        SELECT CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS day,
        {_of('PRODUCT_VIEW')} AS views, {_of('ADD_TO_CART')} AS cart_additions,
        {_of('CHECKOUT_STARTED')} AS checkouts, {_of('PURCHASE')} AS purchases FROM raw GROUP BY 1)
        SELECT *, {_percent('cart_additions', 'views')} AS cart_rate,
        {_percent('checkouts', 'cart_additions')} AS checkout_rate,
        {_percent('purchases', 'checkouts')} AS purchase_rate FROM k""",
    "top_products": f"""WITH {RAW} SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units_sold,
        CAST(sum(quantity * unit_price) AS DOUBLE) AS revenue FROM raw
        WHERE event_type = 'PURCHASE' GROUP BY 1 ORDER BY sum(quantity * unit_price) DESC,
        product_id LIMIT 10""",
    "top_products_per_day": f"""WITH {RAW}, d AS (
        SELECT CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS day, product_id,
        sum(quantity * unit_price) AS amount FROM raw WHERE event_type = 'PURCHASE' GROUP BY 1, 2),
        r AS (SELECT day, product_id, CAST(amount AS DOUBLE) AS revenue, CAST(row_number() OVER (
          PARTITION BY day ORDER BY amount DESC, product_id) AS INTEGER) AS rank FROM d)
        SELECT * FROM r WHERE rank <= 3""",
    "events_per_minute": f"""WITH {RAW} SELECT {BUCKET.format('1 minute')} AS minute,
        count(*) AS events, round(count(*) / 60, 4) AS events_per_second FROM raw GROUP BY 1""",
    "sketched_users": f"""WITH {RAW} SELECT CAST(date_trunc('month', event_timestamp) AS DATE)
        AS month, count(DISTINCT CAST(event_timestamp AS DATE)) AS days,
        count(DISTINCT user_id) AS exact, TRUE AS within FROM raw GROUP BY 1""",
    "sketched_latency": """WITH l AS (SELECT event_id % 90 AS seconds FROM events)
        SELECT CAST(p AS DOUBLE) AS p, count(*) AS events, max(seconds) AS max_seconds,
        TRUE AS within FROM l, (VALUES (0.5), (0.95), (0.99)) v(p) GROUP BY p""",
    "processing_latency": """WITH l AS (SELECT event_id % 90 AS seconds FROM events)
        SELECT count(*) AS events, max(seconds) AS max_seconds,
        quantile_cont(seconds, 0.5) AS p50_seconds, quantile_cont(seconds, 0.95) AS p95_seconds,
        quantile_cont(seconds, 0.99) AS p99_seconds FROM l""",
    "metric_select": f"""WITH {BASE} SELECT a AS consumergroup, b AS topic, metric, ts, value
        FROM metrics WHERE metric = 'kafka_consumergroup_lag_sum'""",
    "metric_latest": f"""WITH {BASE} SELECT metric, series, max(ts) AS ts,
        arg_max(value, ts) AS value FROM metrics WHERE ts <= TIMESTAMP '2024-01-20 12:30:00'
        AND ts > TIMESTAMP '2024-01-20 10:30:00' GROUP BY 1, 2""",
    "counter_rate": f"""WITH {_rate("metric = 'node_cpu_seconds_total'", 6)}
        SELECT a AS cpu, metric, ts, round(value, 9) AS value FROM rates""",
    "events_per_sec": f"""WITH {_rate_at_steps(
        "metric = 'kafka_topic_partition_current_offset' AND a = 'shop'", RATE_RANGE)}
        SELECT ts, round(sum(value), 9) AS value FROM rates GROUP BY ts""",
    "cpu_usage": f"""WITH {_rate_at_steps("metric = 'node_cpu_seconds_total'", RATE_RANGE)}
        SELECT ts, round(100 - avg(value) * 100, 7) AS value FROM rates GROUP BY ts""",
    "cpu_cores": f"""WITH {STEPPED} SELECT ts, count(*) AS value FROM stepped
        WHERE metric = 'node_cpu_seconds_total' GROUP BY ts""",
    "memory_used": f"""WITH {STEPPED} SELECT l.a AS instance, l.ts, l.value - r.value AS value
        FROM stepped l JOIN stepped r ON l.series = r.series AND l.ts = r.ts
        WHERE l.metric = 'node_memory_MemTotal_bytes'
        AND r.metric = 'node_memory_MemAvailable_bytes'""",
    "disk_used": f"""WITH {STEPPED} SELECT l.a AS instance, l.ts, l.value - r.value AS value
        FROM stepped l JOIN stepped r ON l.series = r.series AND l.ts = r.ts
        WHERE l.metric = 'node_filesystem_size_bytes'
        AND r.metric = 'node_filesystem_avail_bytes'""",
    "dlq_total": f"""WITH {BASE} SELECT arg_max(value, ts) AS value FROM metrics
        WHERE metric = 'kafka_topic_partition_current_offset' AND a = 'shop-dlq'
        AND ts <= TIMESTAMP '2024-01-20 12:30:00' AND ts > TIMESTAMP '2024-01-20 10:30:00'""",
    "consumer_lag": f"""WITH {MSG}, k AS (SELECT 'shop' AS topic, kafka_partition AS "partition",
        max("offset") + 1 AS high, CASE WHEN kafka_partition = 2 THEN 0 ELSE coalesce(
          max("offset") FILTER (WHERE "timestamp" < TIMESTAMP '2024-01-20') + 1, 0) END AS committed
        FROM msg GROUP BY kafka_partition)
        SELECT *, greatest(high - committed, 0) AS lag FROM k""",
    "total_consumer_lag": f"""WITH {BASE} SELECT topic, ts, CAST(sum(lag) AS BIGINT) AS lag
        FROM lags GROUP BY ALL""",
    "lag_trend": f"""WITH {BASE}, p AS (SELECT *, lag(lag) OVER (
          PARTITION BY "partition" ORDER BY ts) AS before FROM lags)
        SELECT topic, "partition", ts, high, committed, lag, CASE WHEN before IS NULL THEN ' '
          WHEN lag > before THEN '^' WHEN lag < before THEN 'v' ELSE '=' END AS trend FROM p""",
    "alert_lag": f"""WITH {BASE}, source AS (SELECT * FROM metrics
        WHERE metric = 'kafka_consumergroup_lag_sum'),
        {_islands('source', f'value > {LAG_LIMIT}', LAG_HOURS)}
        SELECT a AS consumergroup, b AS topic, 'ConsumerLagGrowingUnbounded' AS alert,
        'critical' AS severity, ts, value, active_since, state,
        a || ' lag stuck above {LAG_LIMIT} on ' || b AS summary,
        'Consumer group ' || a || chr(39) || 's lag on ' || b || ' has been above {LAG_LIMIT} '
        || 'messages for at least {LAG_HOURS * 60} minutes (' || CAST(value AS BIGINT)
        || ' now): it is not keeping up or has stopped.' AS description FROM alerts""",
    "alert_dlq_rate": f"""WITH {_rate_at_steps(
        "metric = 'kafka_topic_partition_current_offset' AND a = 'shop-dlq'",
        DLQ_RANGE_HOURS * 3600)},
        source AS (SELECT '' AS series, ts, sum(value) AS value FROM rates GROUP BY ts),
        {_islands('source', f'value > {DLQ_LIMIT}', DLQ_HOURS)}
        SELECT 'DLQVolumeSpiking' AS alert, 'warning' AS severity, ts, round(value, 9) AS value,
        active_since, state, 'DLQ receiving messages faster than expected' AS summary,
        'Dead letters have been growing at ' || printf('%.2f', value) || ' msg/sec for at least '
        || '{DLQ_HOURS * 60} minutes: something upstream keeps producing events that are rejected.'
        AS description FROM alerts""",
    "alert_down": f"""WITH {BASE}, source AS (SELECT * FROM metrics WHERE metric = 'up'),
        {_islands('source', 'value = 0', DOWN_HOURS)}
        SELECT a AS job, 'ServiceHealthCheckFailing' AS alert, 'critical' AS severity, ts, value,
        active_since, state, a || ' target down' AS summary, 'job=' || a || ' (instance=' || b
        || ') could not be scraped for at least {DOWN_HOURS * 60} minutes.' AS description
        FROM alerts""",
    "dq_not_null": f"""WITH {MSG} SELECT 'event_id' AS column_name,
        count(*) FILTER (WHERE c IN (0, 8)) AS failures FROM msg
        UNION ALL SELECT 'event_type', count(*) FILTER (WHERE c IN (0, 8)) FROM msg
        UNION ALL SELECT 'event_timestamp', count(*) FILTER (WHERE c IN (0, 4, 8, 9)) FROM msg
        UNION ALL SELECT 'user_id', count(*) FILTER (WHERE c IN (0, 1, 8)) FROM msg""",
    "dq_unique": f"""WITH {MSG} SELECT event_id AS value, count(*) AS n_records FROM msg
        WHERE c NOT IN (0, 8) GROUP BY 1 HAVING count(*) > 1""",
    "dq_accepted": f"""WITH {MSG} SELECT 'UNKNOWN_EVENT' AS value, count(*) AS n_records FROM msg
        WHERE c = 5""",
    "dq_non_negative": f"""WITH {RAW}, {NEGATIVE_SALES} SELECT * FROM sales
        WHERE orders < 0 OR units_sold < 0 OR revenue < 0""",
    "dq_report": f"""WITH {MSG}, {SALES}, k AS (
        SELECT 'unique_event_id' AS "check", (SELECT count(*) FROM (SELECT event_id FROM msg
          WHERE c NOT IN (0, 8) GROUP BY 1 HAVING count(*) > 1)) AS failures
        UNION ALL SELECT 'not_null_event_id', count(*) FILTER (WHERE c IN (0, 8)) FROM msg
        UNION ALL SELECT 'not_null_event_type', count(*) FILTER (WHERE c IN (0, 8)) FROM msg
        UNION ALL SELECT 'accepted_values_event_type',
          CAST(max(CASE WHEN c = 5 THEN 1 ELSE 0 END) AS BIGINT) FROM msg
        UNION ALL SELECT 'not_null_event_timestamp', count(*) FILTER (WHERE c IN (0, 4, 8, 9)) FROM msg
        UNION ALL SELECT 'unique_interval_start', count(*) - count(DISTINCT interval_start) FROM sales
        UNION ALL SELECT 'not_null_interval_start', count(*) - count(interval_start) FROM sales
        UNION ALL SELECT 'not_null_orders', count(*) - count(orders) FROM sales
        UNION ALL SELECT 'not_null_units_sold', count(*) - count(units_sold) FROM sales
        UNION ALL SELECT 'not_null_revenue', count(*) - count(revenue) FROM sales
        UNION ALL SELECT 'sales_by_interval_non_negative',
          count(*) FILTER (WHERE orders < 0 OR units_sold < 0 OR revenue < 0) FROM sales)
        SELECT *, failures = 0 AS passed FROM k""",
    "stream_ingest": f"WITH {MSG} {FIRST}",
    "stream_stats": f"""WITH {MSG} SELECT count(*) AS consumed,
        count(*) FILTER (WHERE outcome = 'VALID' AND copy = 0) AS inserted,
        count(*) FILTER (WHERE outcome <> 'VALID') AS invalid,
        count(*) FILTER (WHERE outcome = 'VALID' AND copy <> 0) AS duplicates FROM msg""",
    "stream_alerts": f"""WITH {BASE}, source AS (SELECT * FROM metrics
        WHERE metric = 'kafka_consumergroup_lag_sum'),
        {_islands('source', f'value > {LAG_LIMIT}', LAG_HOURS)}
        SELECT a AS consumergroup, b AS topic, 'ConsumerLagGrowingUnbounded' AS alert,
        'critical' AS severity, ts, value, active_since, state,
        a || ' lag stuck above {LAG_LIMIT} on ' || b AS summary,
        'Consumer group ' || a || chr(39) || 's lag on ' || b || ' has been above {LAG_LIMIT} '
        || 'messages for at least {LAG_HOURS * 60} minutes (' || CAST(value AS BIGINT)
        || ' now): it is not keeping up or has stopped.' AS description FROM alerts""",
    "stream_dead_letters": f"""WITH {DLQ} SELECT key, dlq_id, outcome AS reason, errors,
        original_topic, original_partition, original_offset, raw_payload, retry_count,
        CAST(NULL AS VARCHAR) AS severity FROM dlq""",
    "stream_retry": f"""WITH {DLQ} SELECT *, (SELECT count(*) FROM events WHERE event_id % 50 = 1)
        AS skipped FROM again""",
    "stream_sales": f"WITH {RAW}, {SALES} SELECT * FROM sales",
    "dedup_stream": f"WITH {MSG} SELECT event_id FROM msg WHERE outcome = 'VALID' AND copy = 0",
}
