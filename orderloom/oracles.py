"""The same results in ANSI SQL over the driver tables, for comparison with another engine."""

from __future__ import annotations

from orderloom.plans.feed import CHANNELS, DOCUMENTS, EXTERNAL, INTERNAL, LINES_PER_DOCUMENT
from orderloom.queries import FIRST_MERGE_TS, LOAD_TS, SECOND_INSERT_TS, SECOND_MERGE_TS

_CASES = " ".join(f"WHEN '{segment}' THEN '{channel}'" for segment, channel in CHANNELS.items())

# All order lines as feed rows, with the line's place in its order, for counting documents.
FEED = f"""feed AS (
  SELECT n_name AS customer, CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS delivery_date,
         p_type AS baked_good_type, CAST(l_quantity AS BIGINT) AS quantity,
         CASE c_mktsegment {_CASES} ELSE '{DOCUMENTS}' END AS channel, l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""

# What the three staging tables hold together.
STAGED = f"""{FEED}, staged AS (
  SELECT customer, order_date, delivery_date, baked_good_type, quantity, channel,
         'Orders_' || CAST(year(order_date) AS VARCHAR) || CASE channel WHEN '{DOCUMENTS}' THEN '.json' ELSE '.csv' END
           AS source_file_name
  FROM feed)"""

# The feed as documents: one for each window of an order's line numbers.
DOCUMENTS_OF = f"""documents_of AS (
  SELECT l_orderkey, customer, order_date, channel, count(*) AS lines,
         count(DISTINCT (l_linenumber - 1) // {LINES_PER_DOCUMENT}) AS documents
  FROM feed GROUP BY l_orderkey, customer, order_date, channel)"""

KEYS = "customer, delivery_date, baked_good_type"


def _last(name: str, channels: tuple[str, ...]) -> str:
    """One row per key, the last by order date, file and quantity."""
    wanted = ", ".join(f"'{c}'" for c in channels)
    return f"""{name} AS (
  SELECT {KEYS}, order_date, quantity, source_file_name FROM (
    SELECT *, row_number() OVER (PARTITION BY {KEYS}
      ORDER BY order_date DESC, source_file_name DESC, quantity DESC) AS place
    FROM staged WHERE channel IN ({wanted})) WHERE place = 1)"""


ALL = (INTERNAL, EXTERNAL, DOCUMENTS)
FROM_BOTH_CSV = f"WITH {STAGED}, {_last('t', (INTERNAL, EXTERNAL))}, {_last('s', (DOCUMENTS,))}"

# Dates and times as text, as in the queries.
_DATES = "CAST(order_date AS VARCHAR) AS order_date, CAST(delivery_date AS VARCHAR) AS delivery_date"
_ROW = f"customer, {_DATES}, baked_good_type, quantity, source_file_name"


def _row(suffix: str = ".csv") -> str:
    return (
        f"customer, {_DATES}, baked_good_type, quantity, "
        f"'Orders_' || CAST(year(order_date) AS VARCHAR) || '{suffix}' AS source_file_name"
    )


def _texts(where: str) -> str:
    return f"""WITH {FEED} SELECT customer AS c1, CAST(order_date AS VARCHAR) AS c2,
  CAST(delivery_date AS VARCHAR) AS c3, baked_good_type AS c4, CAST(quantity AS VARCHAR) AS c5,
  'Orders_' || CAST(year(order_date) AS VARCHAR) || '.csv' AS source_file_name FROM feed {where}"""


def _merged_rows(t: str, s: str, update_ts: str, insert_ts: str, keep_ts: str) -> str:
    """All rows of t after s was merged in; s has each key once."""
    return f"""SELECT COALESCE(t.customer, s.customer) AS customer, COALESCE(t.order_date, s.order_date) AS order_date,
  COALESCE(t.delivery_date, s.delivery_date) AS delivery_date,
  COALESCE(t.baked_good_type, s.baked_good_type) AS baked_good_type,
  CASE WHEN s.customer IS NULL THEN t.quantity ELSE s.quantity END AS quantity,
  CASE WHEN s.customer IS NULL THEN t.source_file_name ELSE s.source_file_name END AS source_file_name,
  CASE WHEN s.customer IS NULL THEN '{keep_ts}' WHEN t.customer IS NULL THEN '{insert_ts}' ELSE '{update_ts}' END
    AS load_ts
FROM {t} t FULL JOIN {s} s ON t.customer = s.customer AND t.delivery_date = s.delivery_date
  AND t.baked_good_type = s.baked_good_type"""


def _merged(update_ts: str, insert_ts: str, keep_ts: str, t: str = "t", s: str = "s") -> str:
    return f"SELECT {_ROW}, load_ts FROM ({_merged_rows(t, s, update_ts, insert_ts, keep_ts)}) AS merged_rows"


def _summary(rows: str) -> str:
    return f"""SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, baked_good_type,
  CAST(sum(quantity) AS BIGINT) AS total_quantity FROM {rows} GROUP BY delivery_date, baked_good_type"""


_MATCHED = "t.customer = s.customer AND t.delivery_date = s.delivery_date AND t.baked_good_type = s.baked_good_type"
_EXTERNAL_ROWS = f"WITH {FEED} SELECT {_row()} FROM feed"
# Bytes of a delivery's rows: the printed columns, the commas between them and a line end each.
_BYTES = f"""WITH {FEED} SELECT 'Orders_' || CAST(year(order_date) AS VARCHAR) || '.csv' AS {{}},
  CAST(sum(strlen(customer) + 20 + strlen(baked_good_type) + strlen(CAST(quantity AS VARCHAR)) + 5) AS BIGINT) AS row_bytes
FROM feed GROUP BY year(order_date)"""
_FLAT = f"WITH {FEED} SELECT {_row('.json')} FROM feed"
_COMBINED = f"WITH {STAGED} SELECT {_ROW}, '{LOAD_TS}' AS load_ts FROM staged"

ORACLES: dict[str, str] = {
    "csv_scan": _texts(""),
    "prefix_scan": _texts(f"WHERE channel = '{EXTERNAL}' AND year(order_date) BETWEEN 1990 AND 1999"),
    "json_scan": f"""WITH {FEED}, {DOCUMENTS_OF} SELECT 'Orders_' || CAST(year(order_date) AS VARCHAR) || '.json' AS source_file_name,
  CAST(sum(documents) AS BIGINT) AS documents, CAST(sum(lines) AS BIGINT) AS items FROM documents_of GROUP BY year(order_date)""",
    "file_lineage": f"""WITH {FEED} SELECT 'Orders_' || CAST(year(order_date) AS VARCHAR) || '.csv' AS source_file_name,
  count(*) AS file_rows FROM feed GROUP BY year(order_date)""",
    "typed_casts": f"WITH {FEED} SELECT customer, {_DATES}, baked_good_type, quantity FROM feed",
    "bulk_load": f"WITH {FEED} SELECT {_row()}, '{LOAD_TS}' AS load_ts FROM feed",
    "load_abort": f"""WITH {FEED}, {DOCUMENTS_OF}, counts AS (
  SELECT (SELECT count(*) FROM feed) AS order_rows, (SELECT CAST(sum(documents) AS BIGINT) FROM documents_of) AS raw_rows)
SELECT 'row' AS bad, FALSE AS ok, 'row' AS kind, order_rows AS staged_rows, order_rows AS history_rows FROM counts
UNION ALL SELECT 'date', FALSE, 'date', order_rows, order_rows FROM counts
UNION ALL SELECT 'documents', FALSE, 'documents', raw_rows, raw_rows FROM counts""",
    "load_rejects": f"""WITH {FEED}, bad AS (
  SELECT 'Orders_' || CAST(year(order_date) AS VARCHAR) || '.csv' AS source_file_name, quantity FROM feed
  WHERE channel = '{INTERNAL}' AND quantity IN (7, 8)),
faults AS (
  SELECT source_file_name, 'quantity' AS column_name, 'not decimal(38,0)' AS reason FROM bad
  UNION ALL SELECT source_file_name, 'order_date', 'not date' FROM bad WHERE quantity = 7)
SELECT source_file_name, column_name, reason, 'bad' AS load_id, count(*) AS faults, count(*) AS bad_lines, FALSE AS ok,
  CAST(0 AS BIGINT) AS staged_rows FROM faults GROUP BY source_file_name, column_name, reason""",
    "load_again": f"""WITH {FEED} SELECT 'first' AS load_id, count(*) AS load_rows FROM feed WHERE channel = '{INTERNAL}'
UNION ALL SELECT 'second', count(*) FROM feed WHERE channel <> '{INTERNAL}'
UNION ALL SELECT 'third', count(*) FROM feed""",
    "stage_purge": f"""WITH {FEED} SELECT 'files_left' AS counted, CAST(0 AS BIGINT) AS n
UNION ALL SELECT 'order_rows', count(*) FROM (SELECT DISTINCT {KEYS} FROM feed)""",
    "stage_listing": _BYTES.format("source_file_name"),
    "directory_table": _BYTES.format("relative_path"),
    "load_history_of_table": f"""WITH {STAGED} SELECT 'external_orders' AS schema_name, 'orders_external_stg' AS table_name,
  source_file_name, 'LOADED' AS status, '{LOAD_TS}' AS last_load_time, count(*) AS row_count
FROM staged WHERE channel = '{EXTERNAL}' GROUP BY source_file_name""",
    "external_table": _EXTERNAL_ROWS,
    "external_refresh": f"""WITH {FEED}, counts AS (
  SELECT count(*) FILTER (WHERE channel = '{INTERNAL}') AS internal_rows, count(*) AS all_rows FROM feed)
SELECT 'created' AS state, internal_rows AS file_rows FROM counts
UNION ALL SELECT 'added', internal_rows FROM counts
UNION ALL SELECT 'refreshed', all_rows FROM counts""",
    "external_by_name": f"""WITH {STAGED}, seen AS (
  SELECT 'created' AS state, * FROM staged WHERE channel = '{INTERNAL}'
  UNION ALL SELECT 'refreshed' AS state, * FROM staged)
SELECT state, via, CAST(year(delivery_date) AS INTEGER) AS delivery_year, source_file_name,
  CAST(sum(quantity) AS BIGINT) AS total_quantity, count(*) AS order_rows
FROM seen, (SELECT unnest(['external', 'stored']) AS via) GROUP BY ALL""",
    "materialized_projection": _EXTERNAL_ROWS,
    "projection_delta": f"""WITH {FEED} SELECT {_row()} FROM feed
WHERE channel = '{EXTERNAL}' OR (channel = '{INTERNAL}' AND year(order_date) > (
  SELECT min(year(order_date)) FROM feed WHERE channel = '{INTERNAL}'))""",
    "directory_changes": f"""WITH {FEED}, files AS (
  SELECT DISTINCT channel, 'Orders_' || CAST(year(order_date) AS VARCHAR) || '.csv' AS relative_path FROM feed)
SELECT 'first' AS refresh_id, 'added' AS change, relative_path FROM files WHERE channel = '{INTERNAL}'
UNION ALL SELECT 'second', 'removed', relative_path FROM files WHERE channel = '{INTERNAL}'
UNION ALL SELECT 'second', 'added', relative_path FROM files WHERE channel = '{EXTERNAL}'""",
    "json_top_level": f"""WITH {FEED}, {DOCUMENTS_OF} SELECT customer, CAST(order_date AS VARCHAR) AS order_date,
  CAST(sum(documents) AS BIGINT) AS documents FROM documents_of GROUP BY customer, documents_of.order_date""",
    "flatten_one_level": f"""WITH {FEED} SELECT customer, {_DATES}, count(*) AS items
FROM feed GROUP BY customer, feed.order_date, feed.delivery_date""",
    "flatten_orders": _FLAT,
    "flatten_typed": _FLAT,
    "raw_documents_staged": f"""WITH {STAGED} SELECT {_ROW}, '{LOAD_TS}' AS load_ts FROM staged
WHERE channel = '{DOCUMENTS}'""",
    "json_document_files": f"""WITH {FEED} SELECT r_name AS customer, {_DATES}, count(*) AS items,
  CAST(sum(quantity) AS BIGINT) AS total_quantity
FROM feed JOIN nation ON n_name = customer JOIN region ON n_regionkey = r_regionkey
WHERE channel = '{DOCUMENTS}' GROUP BY r_name, feed.order_date, feed.delivery_date""",
    "json_giant_documents": f"""WITH {FEED}, placed AS (
  SELECT r_name AS customer, feed.order_date, feed.delivery_date, quantity
  FROM feed JOIN nation ON n_name = customer JOIN region ON n_regionkey = r_regionkey)
SELECT customer, CAST(first_date AS VARCHAR) AS order_date, CAST(delivery_date AS VARCHAR) AS delivery_date,
  count(*) AS items, CAST(sum(quantity) AS BIGINT) AS total_quantity
FROM placed JOIN (SELECT customer, min(order_date) AS first_date FROM placed GROUP BY customer) USING (customer)
GROUP BY customer, first_date, delivery_date""",
    "combined_union": _COMBINED,
    "registered_views": f"""WITH {STAGED} SELECT source_file_name, CAST(delivery_date AS VARCHAR) AS delivery_date,
  count(*) AS order_rows, CAST(sum(quantity) AS BIGINT) AS total_quantity
FROM staged GROUP BY source_file_name, staged.delivery_date""",
    "merge_match": f"""{FROM_BOTH_CSV} SELECT s.customer AS customer, CAST(s.delivery_date AS VARCHAR) AS delivery_date,
  s.baked_good_type AS baked_good_type FROM t JOIN s ON {_MATCHED}""",
    "merge_update": f"""{FROM_BOTH_CSV} SELECT t.customer AS customer, CAST(t.order_date AS VARCHAR) AS order_date,
  CAST(t.delivery_date AS VARCHAR) AS delivery_date, t.baked_good_type AS baked_good_type, s.quantity AS quantity,
  s.source_file_name AS source_file_name, '{SECOND_MERGE_TS}' AS load_ts FROM t JOIN s ON {_MATCHED}""",
    "merge_insert": f"""{FROM_BOTH_CSV} SELECT {_ROW}, '{SECOND_MERGE_TS}' AS load_ts FROM s
WHERE NOT EXISTS (SELECT 1 FROM t WHERE {_MATCHED})""",
    "merge_single_feed": f"{FROM_BOTH_CSV} {_merged(SECOND_MERGE_TS, SECOND_INSERT_TS, FIRST_MERGE_TS)}",
    "merge_combined": f"""WITH {STAGED}, {_last('t', (INTERNAL,))}, {_last('s', ALL)}
{_merged(SECOND_MERGE_TS, SECOND_MERGE_TS, FIRST_MERGE_TS)}""",
    "merge_literal": f"WITH {STAGED} SELECT {_ROW}, '{FIRST_MERGE_TS}' AS load_ts FROM staged",
    "merge_refused": f"""WITH {STAGED}, repeated AS (SELECT {KEYS} FROM staged GROUP BY {KEYS} HAVING count(*) > 1)
SELECT FALSE AS ok, 'Load failed with error message: ' || CAST((SELECT count(*) FROM repeated) AS VARCHAR)
  || ' keys of the target are matched by more than one source row' AS message, count(*) AS order_rows FROM staged""",
    "truncate_table": f"""WITH {FEED} SELECT 'filled' AS state, count(*) AS staged_rows FROM feed
UNION ALL SELECT 'truncated', CAST(0 AS BIGINT)""",
    "summary_by_day_type": f"WITH {STAGED} {_summary('staged')}",
    "summary_group_by_all": f"""WITH {STAGED}, grouped AS (
  SELECT delivery_date, baked_good_type, CAST(sum(quantity) AS BIGINT) AS total_quantity FROM staged GROUP BY ALL)
SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, baked_good_type, total_quantity FROM grouped""",
    "summary_refresh": f"WITH {STAGED} {_summary('staged')}",
    "summary_incremental": f"{FROM_BOTH_CSV}, merged AS ({_merged_rows('t', 's', '', '', '')}) {_summary('merged')}",
    "summary_from_changes": f"{FROM_BOTH_CSV}, merged AS ({_merged_rows('t', 's', '', '', '')}) {_summary('merged')}",
    "orders_sorted": f"{_COMBINED} ORDER BY staged.delivery_date DESC",
    "event_log_scan": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value
FROM events ORDER BY events.ts DESC""",
    "job_log": f"""WITH {STAGED}, repeated AS (SELECT {KEYS} FROM staged GROUP BY {KEYS} HAVING count(*) > 1)
SELECT 'DEBUG' AS severity, 'LOAD_CUSTOMER_ORDERS' AS procedure_name, 'LOAD_CUSTOMER_ORDERS begin' AS message
UNION ALL SELECT 'DEBUG', 'LOAD_CUSTOMER_ORDERS', 'LOAD_CUSTOMER_ORDERS begin'
UNION ALL SELECT 'ERROR', 'LOAD_CUSTOMER_ORDERS', 'Load failed with error message: ' || CAST((SELECT count(*) FROM repeated) AS VARCHAR)
  || ' keys of the target are matched by more than one source row'
UNION ALL SELECT 'DEBUG', 'LOAD_CUSTOMER_SUMMARY_ORDERS', 'LOAD_CUSTOMER_SUMMARY_ORDERS begin'""",
    "insert_day": f"""WITH {FEED} SELECT TRUE AS on_the_day, count(*) AS order_rows FROM (SELECT DISTINCT {KEYS} FROM feed)""",
    "load_status": f"""WITH {STAGED}, s AS (SELECT DISTINCT {KEYS} FROM staged),
g AS (SELECT DISTINCT delivery_date, baked_good_type FROM staged)
SELECT 'merge' AS job, 'Load Completed. ' || CAST(count(*) AS VARCHAR) || ' rows affected.' AS message FROM s
UNION ALL SELECT 'summary', 'Load completed. ' || CAST(count(*) AS VARCHAR) || ' rows inserted.' FROM g""",
    "ingest_to_summary": f"""WITH {STAGED}, {_last('s', (EXTERNAL,))}, {_last('d', (DOCUMENTS,))},
t AS (SELECT * FROM staged WHERE channel = '{INTERNAL}'),
twice AS ({_merged_rows('t', 's', '', '', '')}),
merged AS ({_merged_rows('twice', 'd', '', '', '')})
{_summary('merged')}""",
    "resume_run": f"""WITH {STAGED}, {_last('i', (INTERNAL,))}, {_last('e', (EXTERNAL,))},
merged AS ({_merged_rows('i', 'e', '', '', '')}), summary AS ({_summary('merged')})
SELECT *, CAST(0 AS BIGINT) AS files_left, TRUE AS first_failed FROM summary""",
    "feeds_to_summary": f"WITH {STAGED}, {_last('s', ALL)} {_summary('s')}",
    "stream_ingest": f"""WITH {STAGED}, {_last('i', (INTERNAL,))}, {_last('e', (EXTERNAL,))}, {_last('d', (DOCUMENTS,))},
csv_feeds AS ({_merged_rows('i', 'e', '', '', '')})
{_merged(SECOND_MERGE_TS, SECOND_MERGE_TS, FIRST_MERGE_TS, 'csv_feeds', 'd')}""",
}
