"""DuckDB SQL for each registered query, written against the test tables without any JSON arrays."""

from __future__ import annotations

from tidemark.checks.queries import KEYWORD, NUDGE, SCALE, WEEK, WEEK_DAYS
from tidemark.checks.testbed import BROKEN_DAY, IDS_PER_ENVELOPE, OMITTED_IDS, UNPRICED, UNPRICED_IDS

def _cut(expression: str, name: str) -> str:
    """The same 6-digit cut as the Spark side."""
    return f"floor(({expression}) * {SCALE:.0f} + {NUDGE}) / {SCALE:.0f} AS {name}"


# One row per event, with its envelope and its position inside it. The first of equal rows stands in
# the envelope of its run of ids, the others in envelopes of copies.
_ENVELOPE = "PARTITION BY entity, run_date, envelope"
_SAME = "entity, run_date, ms, event_id, value, k"
POINTS = f"""
sent_events AS (
  SELECT event_type AS entity, CAST(ts AS DATE) AS run_date, epoch_us(ts) // 1000 AS ms,
    event_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events
),
copied AS (SELECT *, row_number() OVER (PARTITION BY {_SAME}) - 2 AS copy FROM sent_events),
placed AS (
  SELECT *, event_id % {OMITTED_IDS} = 0 AS omitted,
    CASE WHEN copy < 0 THEN concat('ids ', event_id // {IDS_PER_ENVELOPE})
      ELSE concat_ws(' ', 'copies', ms, event_id, value, k, copy // {IDS_PER_ENVELOPE}) END AS envelope
  FROM copied
),
points AS (
  SELECT
    entity,
    run_date,
    envelope,
    omitted,
    make_timestamp(ms * 1000) AS event_time,
    value AS price,
    CAST(event_id AS DOUBLE) AS market_cap,
    k AS total_volume,
    row_number() OVER ({_ENVELOPE} ORDER BY omitted, ms, event_id, value, k) - 1 AS position,
    count(*) OVER ({_ENVELOPE}) AS n,
    count(*) FILTER (NOT omitted) OVER ({_ENVELOPE}) AS n_short
  FROM placed
)"""

_COLUMNS = "entity, run_date, event_time, market_cap, total_volume, position"

# The three deliveries after flattening; the correction stops at its shortest array.
FLAT = f"""{POINTS},
stale AS (
  SELECT {_COLUMNS}, price * 10 AS price, TIMESTAMP '2024-01-31' AS ingestion_time FROM points
),
full_delivery AS (
  SELECT {_COLUMNS}, price, TIMESTAMP '2024-02-01' AS ingestion_time FROM points
),
correction AS (
  SELECT {_COLUMNS}, price * 2 AS price, TIMESTAMP '2024-02-02' AS ingestion_time FROM points
  WHERE run_date >= DATE '2024-01-16' AND NOT omitted
),
flat AS (
  SELECT * FROM stale
  UNION ALL BY NAME SELECT * FROM full_delivery
  UNION ALL BY NAME SELECT * FROM correction
)"""

# Latest ingestion per key among the envelopes that are recent enough.
LATEST = f"""{FLAT},
staging AS (
  SELECT * FROM flat
  WHERE CAST(ingestion_time AS DATE) >= DATE '2024-02-01'
  QUALIFY row_number() OVER (
    PARTITION BY entity, event_time
    ORDER BY ingestion_time DESC, position DESC, price DESC, market_cap DESC, total_volume DESC
  ) = 1
)"""


def _daily(source: str) -> str:
    return f"""
daily AS (
  SELECT entity, CAST(event_time AS DATE) AS date, avg(price) AS avg_price, max(price) AS max_price,
    min(price) AS min_price, sum(total_volume) AS total_volume, avg(market_cap) AS avg_market_cap
  FROM {source} GROUP BY ALL
),
lagged AS (
  SELECT *, lag(avg_price) OVER (PARTITION BY entity ORDER BY date) AS prev FROM daily
)"""


_ROUNDED = ", ".join(
    _cut(c, c) for c in ("avg_price", "max_price", "min_price", "total_volume")
)
_CHANGE = _cut("(avg_price - prev) / nullif(prev, 0) * 100", "daily_price_change_pct")

_CURATED = f"""
SELECT entity, date, {_ROUNDED}, {_cut("avg_market_cap", "avg_market_cap")}, {_CHANGE}
FROM lagged"""

_STAGING = f"""
SELECT entity, event_time, {_cut("price", "price")}, market_cap, total_volume, ingestion_time
FROM staging"""

# Same points, one delivery with undistorted prices.
_ONCE = """
once AS (
  SELECT entity, event_time, price, market_cap, total_volume FROM points
  QUALIFY row_number() OVER (
    PARTITION BY entity, event_time
    ORDER BY position DESC, price DESC, market_cap DESC, total_volume DESC
  ) = 1
)"""

_ENVELOPES = f"""{POINTS},
envelopes AS (
  SELECT entity, run_date, envelope, count(*) AS n, count(*) FILTER (NOT omitted) AS n_short
  FROM points GROUP BY ALL
)"""

# What the faulty delivery lacks, by day of the month.
_MISSING = """
CASE day(run_date)
  WHEN 5 THEN 'market_caps'
  WHEN 9 THEN 'total_volumes'
  WHEN 14 THEN 'prices'
  WHEN 18 THEN 'prices'
  WHEN 23 THEN 'prices,market_caps,total_volumes'
  WHEN 28 THEN 'prices,market_caps,total_volumes'
END"""

_STATUS = f"""{_ENVELOPES},
items AS (
  SELECT entity, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS run_date
  FROM (
    SELECT event_type AS entity, CAST(min(ts) AS DATE) AS a, CAST(max(ts) AS DATE) AS b
    FROM events GROUP BY ALL
  )
),
outcomes AS (SELECT DISTINCT entity, run_date, {_MISSING} AS missing FROM envelopes),
status AS (
  SELECT i.entity, i.run_date,
    o.entity IS NOT NULL AND o.missing IS NULL AS ok,
    CASE WHEN o.entity IS NULL THEN 'not landed'
      WHEN o.missing IS NOT NULL THEN 'missing or empty: ' || replace(o.missing, ',', ', ')
    END AS reason
  FROM items i LEFT JOIN outcomes o USING (entity, run_date)
)"""

_CUSTOMER_DATES = """
dates AS (
  SELECT CAST(o_custkey AS VARCHAR) AS pipeline_name, CAST(o_orderdate AS DATE) AS run_date,
    bool_and(o_orderstatus <> 'O') AS ok
  FROM orders GROUP BY ALL
)"""

_CUSTOMER_ITEMS = f"""
items AS (
  SELECT entity, CAST(unnest(generate_series(greatest(a, b - {WEEK_DAYS - 1}), b, INTERVAL 1 DAY)) AS DATE) AS run_date
  FROM (
    SELECT o_custkey AS entity, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b
    FROM orders GROUP BY ALL
  )
)"""
_HAS_ORDER = """
EXISTS (SELECT 1 FROM orders
  WHERE o_custkey = entity AND CAST(o_orderdate AS DATE) = run_date)"""

_KEY_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"


def _table_change(table: str, entity: str, ts: str, price: str, volume: str) -> str:
    return f"""
WITH daily AS (
  SELECT {entity} AS entity, CAST({ts} AS DATE) AS date, avg({price}) AS avg_price,
    max({price}) AS max_price, min({price}) AS min_price, sum({volume}) AS total_volume
  FROM {table} GROUP BY ALL
),
lagged AS (
  SELECT *, lag(avg_price) OVER (PARTITION BY entity ORDER BY date) AS prev FROM daily
)
SELECT entity, date, {_ROUNDED}, {_CHANGE} FROM lagged"""


def _sql() -> dict[str, str]:
    merged = f"WITH {LATEST} {_STAGING}"
    once = f"WITH {POINTS}, {_ONCE}, {_daily('once')} {_CURATED}"
    return {
        "recent_raw": f"""
WITH {_ENVELOPES}
SELECT entity, run_date, TIMESTAMP '2024-02-01' AS ingestion_time, 90::BIGINT AS days_requested
FROM envelopes
UNION ALL
SELECT entity, run_date, TIMESTAMP '2024-02-02', 2::BIGINT FROM envelopes
WHERE run_date >= DATE '2024-01-16'""",
        "valid_payloads": f"""
WITH {_ENVELOPES}
SELECT TIMESTAMP '2024-01-31' AS ingestion_time, entity, 90::BIGINT AS days_requested, run_date,
  CAST(n AS INTEGER) AS n_prices, CAST(n AS INTEGER) AS n_market_caps,
  CAST(n AS INTEGER) AS n_total_volumes
FROM envelopes WHERE {_MISSING} IS NULL""",
        "rejected_payloads": f"""
WITH {_ENVELOPES}
SELECT entity, run_date, {_MISSING} AS missing FROM envelopes WHERE {_MISSING} IS NOT NULL""",
        "documents_with_keyword": f"""
SELECT doc_id, lang, source FROM documents WHERE contains(text, '{KEYWORD}')""",
        "safe_ratio": f"""
SELECT event_id,
  {_cut("value / nullif(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0)", "ratio")}
FROM events""",
        "landing_keys": f"""
SELECT event_id,
  'raw/' || event_type || '/' || strftime(ts, '%Y-%m-%d') || '/' || {_KEY_TIME} || '.json'
    AS object_key,
  printf('%03d', user_id) AS padded,
  {_KEY_TIME} AS iso_time
FROM events""",
        "flatten_series": f"""
WITH {FLAT}
SELECT entity, ingestion_time, event_time, {_cut("price", "price")}, market_cap, total_volume
FROM flat""",
        "flatten_shortest": f"""
WITH {POINTS}
SELECT entity, run_date, CAST(n AS INTEGER) AS n_prices, CAST(n_short AS INTEGER) AS n_market_caps,
  CAST(n + 1 AS INTEGER) AS n_total_volumes, event_time, CAST(position AS INTEGER) AS position
FROM points WHERE NOT omitted""",
        "latest_per_key": merged,
        "latest_event_per_user": f"""
SELECT user_id, event_id, ts, event_type, {_cut("value", "value")} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "staging_upsert": merged,
        "staging_upsert_twice": merged,
        "staging_upsert_only_if_newer": merged,
        "staging_upsert_older_wins": f"""
WITH {FLAT},
staging AS (
  SELECT * FROM stale
  QUALIFY row_number() OVER (
    PARTITION BY entity, event_time ORDER BY position DESC, price DESC, market_cap DESC, total_volume DESC
  ) = 1
) {_STAGING}""",
        "merge_null_keys": f"""
WITH target AS (
  SELECT CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey END AS k, o_custkey, o_orderstatus, o_totalprice FROM orders
)
SELECT k, o_custkey, o_orderstatus, {_cut("o_totalprice", "o_totalprice")} FROM target
WHERE k IS NULL OR o_orderstatus <> 'F'
UNION ALL
SELECT k, o_custkey, o_orderstatus, {_cut("o_totalprice * 2", "o_totalprice")} FROM target WHERE o_orderstatus = 'F'""",
        "load_report": f"""
WITH {_ENVELOPES},
sent AS (SELECT {_MISSING} IS NULL AS good FROM envelopes)
SELECT count(*) FILTER (good) AS raw_rows, count(*) FILTER (NOT good) AS quarantined_rows,
  count(*) FILTER (good) AS rows_loaded, count(*) FILTER (NOT good) AS rows_rejected
FROM sent""",
        "quarantine": f"""
WITH {_ENVELOPES}
SELECT entity, run_date, TIMESTAMP '2024-01-31' AS ingestion_time, {_MISSING} AS missing
FROM envelopes WHERE {_MISSING} IS NOT NULL""",
        "backfill_state": """
SELECT DISTINCT 'backfill' AS pipeline_name, DATE '2024-02-01' AS last_processed_date,
  TIMESTAMP '2024-02-01 06:00:00' AS updated_at
FROM events""",
        "curated_upsert": f"WITH {LATEST}, {_daily('staging')} {_CURATED}",
        "merge_customer_orders": f"""
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, {_cut("o_totalprice", "o_totalprice")}
FROM orders
QUALIFY row_number() OVER (
  PARTITION BY o_custkey
  ORDER BY CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END, o_orderdate DESC, o_orderkey DESC
) = 1""",
        "daily_metrics": f"""
WITH {LATEST}, {_daily('staging')}
SELECT entity, date, {_ROUNDED}, {_cut("avg_market_cap", "avg_market_cap")} FROM daily""",
        "daily_change": f"WITH {LATEST}, {_daily('staging')} {_CURATED}",
        "orders_daily_change": _table_change(
            "orders", "o_custkey", "o_orderdate", "o_totalprice", "o_totalprice"
        ),
        "lineitem_daily_change": _table_change(
            "lineitem", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"
        ),
        "work_items": """
WITH spans AS (
  SELECT event_type AS entity, CAST(min(ts) AS DATE) AS a, CAST(max(ts) AS DATE) AS b
  FROM events GROUP BY ALL
)
SELECT entity, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS run_date
FROM spans""",
        "loaded_counts": """
SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS run_date, count(*) AS row_count
FROM orders GROUP BY ALL""",
        "pending_items": f"WITH {_CUSTOMER_ITEMS} SELECT * FROM items WHERE NOT {_HAS_ORDER}",
        "landed_semi": f"WITH {_CUSTOMER_ITEMS} SELECT * FROM items WHERE {_HAS_ORDER}",
        "run_status": f"WITH {_STATUS} SELECT * FROM status",
        "run_summary": f"""
WITH {_STATUS}
SELECT entity, count(*) AS items, count(*) FILTER (NOT ok) AS failures, bool_and(ok) AS all_ok
FROM status GROUP BY ALL""",
        "failed_dates": f"""
WITH {_CUSTOMER_DATES} SELECT pipeline_name, run_date FROM dates WHERE NOT ok""",
        "resume_max_success": f"""
WITH {_CUSTOMER_DATES}
SELECT pipeline_name, max(run_date) FILTER (ok) AS resume_date FROM dates GROUP BY ALL""",
        "resume_contiguous": f"""
WITH {_CUSTOMER_DATES},
failed AS (
  SELECT pipeline_name, min(run_date) AS first_failed FROM dates WHERE NOT ok GROUP BY ALL
)
SELECT pipeline_name,
  max(run_date) FILTER (first_failed IS NULL OR run_date < first_failed) AS resume_date
FROM dates LEFT JOIN failed USING (pipeline_name) GROUP BY ALL""",
        "state_latest": """
SELECT CAST(o_custkey AS VARCHAR) AS pipeline_name,
  CAST(max(o_orderdate) AS DATE) AS last_processed_date, max(o_orderdate) AS updated_at
FROM orders GROUP BY ALL""",
        "state_upsert": """
WITH earlier AS (
  SELECT o_custkey, max(o_orderdate) AS ts FROM orders
  WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY ALL
),
later AS (
  SELECT o_custkey, max(o_orderdate) AS ts FROM orders
  WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY ALL
)
SELECT CAST(o_custkey AS VARCHAR) AS pipeline_name,
  CAST(coalesce(earlier.ts, later.ts) AS DATE) AS last_processed_date,
  coalesce(earlier.ts, later.ts) AS updated_at
FROM earlier FULL JOIN later USING (o_custkey)""",
        "run_window": """
WITH pointers AS (
  SELECT o_custkey AS c_custkey, CAST(max(o_orderdate) AS DATE) AS last FROM orders GROUP BY ALL
),
windows AS (
  SELECT CAST(c_custkey AS VARCHAR) AS pipeline_name,
    CAST(coalesce(last + 1, DATE '2001-07-29') AS DATE) AS start_date,
    DATE '2001-07-30' AS end_date
  FROM customer LEFT JOIN pointers USING (c_custkey)
)
SELECT *, start_date > end_date AS up_to_date FROM windows""",
        "land_and_load": f"""
WITH {_ENVELOPES},
sent AS (
  SELECT *, TIMESTAMP '2024-01-31' AS ingestion_time, 90 AS days, n AS caps, n AS volumes
  FROM envelopes
  UNION ALL
  SELECT *, TIMESTAMP '2024-02-01', 90, n, n FROM envelopes
  UNION ALL
  SELECT *, TIMESTAMP '2024-02-02', 2, n_short, n + 1 FROM envelopes
  WHERE run_date >= DATE '2024-01-16'
)
SELECT ingestion_time, entity, CAST(days AS BIGINT) AS days_requested,
  CAST(ingestion_time AS DATE) AS ingestion_date, CAST(n AS INTEGER) AS n_prices,
  CAST(caps AS INTEGER) AS n_market_caps, CAST(volumes AS INTEGER) AS n_total_volumes
FROM sent WHERE caps > 0 AND run_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-25'""",
        "backfill_curated": f"WITH {LATEST}, {_daily('staging')} {_CURATED}",
        "incremental_curated": once,
        "stream_staging": merged,
        "state_after_runs": """
SELECT 'backfill' AS pipeline_name, CAST(max(ingested) AS DATE) AS last_processed_date, max(ingested) AS updated_at
FROM (
  SELECT TIMESTAMP '2024-02-01' AS ingested FROM events
  UNION ALL SELECT TIMESTAMP '2024-02-02' FROM events
) HAVING count(*) > 0""",
        "packed_loads": f"""
WITH {_ENVELOPES},
stored AS (
  SELECT CASE WHEN {_MISSING} IS NULL THEN 'loaded' ELSE 'rejected' END AS outcome, DATE '2024-01-31' AS ingestion_date, 'faulty' AS load_id
  FROM envelopes
  UNION ALL SELECT 'loaded', DATE '2024-01-31', 'stale' FROM envelopes
  UNION ALL SELECT 'loaded', DATE '2024-02-01', unnest(['full', 'again']) FROM envelopes
)
SELECT *, count(*) AS row_count, 1::BIGINT AS folders FROM stored GROUP BY ALL""",
        "load_broken_lines": f"""
WITH {_ENVELOPES}, sent AS (SELECT run_date, day(run_date) = {BROKEN_DAY} AS broken, {_MISSING} IS NULL AS good FROM envelopes)
SELECT run_date, count(*) FILTER (good AND NOT broken) AS rows_loaded,
  count(*) FILTER (NOT good AND NOT broken) AS rows_rejected, count(*) FILTER (broken) AS rows_corrupt
FROM sent GROUP BY ALL""",
        "landed_week": f"""
WITH {_ENVELOPES}
SELECT entity, run_date, count(*) * CASE WHEN run_date >= DATE '2024-01-16' THEN 2 ELSE 1 END AS envelopes
FROM envelopes WHERE run_date BETWEEN DATE '{WEEK}' AND DATE '{WEEK}' + {WEEK_DAYS - 1} GROUP BY entity, run_date""",
        "staging_good_points": f"""
WITH {POINTS},
staging AS (
  SELECT entity, event_time, price, market_cap, total_volume, TIMESTAMP '2024-02-01' AS ingestion_time FROM points
  WHERE CAST(market_cap AS BIGINT) % {UNPRICED_IDS} <> 0
  QUALIFY row_number() OVER (
    PARTITION BY entity, event_time ORDER BY position DESC, price DESC, market_cap DESC, total_volume DESC
  ) = 1
) {_STAGING}""",
        "points_quarantine": f"""
WITH {POINTS}
SELECT entity, TIMESTAMP '2024-02-01' AS ingestion_time, CAST(position AS INTEGER) AS position,
  '{UNPRICED}' AS price_text, CAST(CAST(market_cap AS BIGINT) AS VARCHAR) AS market_cap_text
FROM points WHERE CAST(market_cap AS BIGINT) % {UNPRICED_IDS} = 0""",
        "configured_items": f"""
SELECT entity, CAST(unnest(generate_series(DATE '{WEEK}', DATE '{WEEK}' + {WEEK_DAYS - 1}, INTERVAL 1 DAY)) AS DATE) AS run_date
FROM (SELECT DISTINCT trim(c_mktsegment) AS entity FROM customer WHERE c_acctbal > 0 AND trim(c_mktsegment) <> '')""",
    }


def oracle_sql() -> dict[str, str]:
    return _sql()
