"""The registered queries in DuckDB SQL, written apart from the Spark code.

``_PARTS`` are named subqueries over the given tables; each query lists the SQL that uses
them and gets the ones it names, in order, as a WITH clause.
"""

from __future__ import annotations

import re

# Report labels, check names, file states and messages, prices.

_PARTS = {
    "src_orders": """
        SELECT concat('ORD-', CAST(o_orderkey AS VARCHAR)) AS order_id,
               CASE WHEN o_orderkey % 200 = 7 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
               CASE WHEN o_orderkey % 5000 = 42 THEN -o_totalprice ELSE o_totalprice END AS amount,
               CASE o_orderkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP'
                                   WHEN 3 THEN 'INR' ELSE 'JPY' END AS currency,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
                                  ELSE 'refunded' END AS status,
               o_orderdate AS created_at,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS process_date,
               0 AS seq
        FROM orders
        UNION ALL
        SELECT concat('ORD-', CAST(o_orderkey AS VARCHAR)), CAST(o_custkey AS VARCHAR),
               o_totalprice + 1, 'USD', 'completed', o_orderdate,
               CAST(date_trunc('month', o_orderdate) AS DATE), 1
        FROM orders WHERE o_orderkey % 100 = 3""",
    "src_events": """
        SELECT concat('EVT-', CAST(event_id AS VARCHAR)) AS event_id,
               CAST(user_id AS VARCHAR) AS user_id, event_type, ts
        FROM events
        UNION ALL
        SELECT concat('EVT-', CAST(event_id AS VARCHAR)), CAST(user_id + 1 AS VARCHAR), event_type,
               ts + INTERVAL 1 MINUTE
        FROM events WHERE event_id % 100 = 5""",
    "src_segments": """
        SELECT CASE WHEN c_acctbal >= 8000 THEN CAST(c_custkey AS VARCHAR)
                    ELSE concat('store-', CAST(c_custkey AS VARCHAR)) END AS user_id,
               c_mktsegment AS segment, c_acctbal AS lifetime_value, n_name AS country
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "valid_orders": """
        SELECT * FROM src_orders WHERE amount > 0 AND user_id IS NOT NULL""",
    "unique_orders": """
        SELECT order_id, user_id, amount, currency, status, created_at, process_date, seq
        FROM valid_orders
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY created_at DESC, seq DESC) = 1""",
    "unique_events": """
        SELECT * FROM src_events
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, user_id DESC) = 1""",
    "user_events": """
        SELECT user_id, count(event_id) AS event_count,
               string_agg(event_type, ',' ORDER BY event_type) AS event_types,
               string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_type_set
        FROM unique_events GROUP BY user_id""",
    "enriched": """
        SELECT o.order_id, o.user_id, o.amount, o.currency, o.status, e.event_count, e.event_types,
               s.segment AS user_segment, s.lifetime_value, s.country, o.process_date,
               sha256(concat_ws('||', o.order_id, CAST(o.amount AS VARCHAR), o.currency)) AS row_hash,
               TIMESTAMP '2024-01-30 12:00:00' AS created_at,
               TIMESTAMP '2024-01-30 12:00:00' AS updated_at
        FROM unique_orders o
        LEFT JOIN src_segments s ON o.user_id = s.user_id
        LEFT JOIN user_events e ON o.user_id = e.user_id""",
    "prod": """
        SELECT e.* FROM enriched e, (VALUES (1), (2)) c(n)
        WHERE c.n <= CASE WHEN process_date = DATE '1995-01-01' THEN 0
                          WHEN process_date = DATE '1995-02-01' AND status = 'pending' THEN 0
                          WHEN process_date = DATE '1995-03-01' THEN 2 ELSE 1 END""",
    "stg_copies": """
        SELECT * FROM enriched
        UNION ALL SELECT * FROM enriched WHERE process_date = DATE '1995-04-01'""",
    "merge_source": """
        SELECT * FROM enriched WHERE status <> 'refunded'""",
    "merge_target": """
        SELECT * REPLACE (amount - 1 AS amount,
                 sha256(concat_ws('||', order_id, CAST(amount - 1 AS VARCHAR), currency)) AS row_hash,
                 TIMESTAMP '2024-01-01 00:00:00' AS created_at,
                 TIMESTAMP '2024-01-01 00:00:00' AS updated_at)
        FROM enriched WHERE status <> 'pending'""",
    "jobs": """
        SELECT CAST(event_id AS VARCHAR) AS job_id, concat('SELECT ', event_type) AS query,
               ts AS creation_time,
               CASE WHEN event_type = 'error' THEN 'LOAD' ELSE 'QUERY' END AS job_type,
               CASE WHEN user_id % 10 = 9 THEN 'RUNNING' ELSE 'DONE' END AS state,
               CAST(floor(value * 1e9) AS BIGINT) AS total_bytes_billed,
               CAST(floor(value * 1000) AS BIGINT) AS total_slot_ms,
               CASE user_id % 3 WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN [event_type]
                                ELSE [event_type, 'dim'] END AS refs
        FROM events""",
    "done": """
        SELECT * FROM jobs
        WHERE creation_time > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 720 HOUR
          AND job_type = 'QUERY' AND state = 'DONE'""",
    "done_tables": """
        SELECT unnest(refs) AS table_id, total_bytes_billed FROM done""",
    "files": """
        SELECT *, CASE WHEN length > 0 AND suffix = '.parquet' AND doc_id % 97 = 0
                       THEN 'Corrupt Parquet: no footer' END AS error
        FROM (SELECT doc_id, lands_as AS source, suffix,
                     concat('source=', lands_as, '/dt=2026-03-19/', CAST(doc_id AS VARCHAR), suffix)
                         AS file_name,
                     CASE WHEN doc_id % 50 = 0 THEN 0 ELSE n_chars END AS length,
                     CASE WHEN doc_id % 50 = 0 THEN NULL
                          ELSE CASE doc_id % 3
                               WHEN 0 THEN ['order_id', 'user_id', 'amount', 'currency', 'process_date']
                               WHEN 1 THEN ['user_id', 'segment', 'country', 'order_id']
                               ELSE ['event_id', 'user_id', 'event_type', 'timestamp', 'process_date']
                               END END AS columns,
                     CASE WHEN doc_id % 50 <> 0 THEN n_chars END AS n_rows
              FROM (SELECT doc_id, n_chars,
                           CASE doc_id % 4 WHEN 0 THEN 'orders' WHEN 1 THEN 'events'
                                           WHEN 2 THEN 'user_segments' ELSE 'other' END AS lands_as,
                           CASE WHEN doc_id % 7 = 0 THEN '.csv' WHEN doc_id % 11 = 0 THEN '.json'
                                ELSE '.parquet' END AS suffix
                    FROM documents) d) f""",
    "registered": """
        SELECT *, CASE source
               WHEN 'orders' THEN ['order_id', 'user_id', 'amount', 'currency', 'process_date']
               WHEN 'events' THEN ['event_id', 'user_id', 'event_type', 'timestamp', 'process_date']
               WHEN 'user_segments' THEN ['user_id', 'segment'] END AS required
        FROM files""",
    "checked": """
        SELECT *, list_sort(list_filter(required, lambda x: NOT list_contains(columns, x))) AS missing
        FROM registered""",
    "told": """
        SELECT *, CASE
            WHEN length = 0 THEN 'empty'
            WHEN error IS NOT NULL THEN error
            WHEN suffix = '.json' THEN 'Unknown format (passed)'
            WHEN required IS NULL AND suffix = '.parquet' THEN 'No schema registered (passed by default)'
            WHEN required IS NULL THEN 'No schema registered'
            WHEN len(missing) > 0
              THEN concat('Missing required columns: {''', list_aggregate(missing, 'string_agg', ''', '''), '''}')
            WHEN suffix = '.parquet'
              THEN concat('Schema OK (', n_rows, ' rows, ', len(columns), ' columns)')
            ELSE concat('Header OK (', n_rows, ' rows)') END AS message,
            NOT (length = 0 OR error IS NOT NULL
                 OR (suffix <> '.json' AND coalesce(len(missing), 0) > 0)) AS is_valid
        FROM checked""",
    "judged": """
        SELECT *, CASE WHEN is_valid THEN 'validated' ELSE concat('quarantined:', message) END AS status
        FROM told""",
    "ledger": """
        SELECT file_name, TIMESTAMP '2024-01-01 00:00:00' AS processed_at,
               CASE WHEN quality = 1 THEN 'validated' ELSE 'quarantined:empty' END AS status
        FROM files JOIN labels USING (doc_id)""",
    # Given amounts have two digits after the point.
    "staged_days": """
        SELECT process_date, count(*) AS staging_rows,
               count(DISTINCT order_id) AS unique_staging_orders,
               CAST(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS VARCHAR) AS DOUBLE) AS total_staging_revenue,
               CAST(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS VARCHAR) AS DOUBLE) / count(amount) AS avg_staging_amount,
               count(*) FILTER (order_id IS NULL) AS null_order_ids
        FROM stg_copies GROUP BY process_date""",
    "produced_days": """
        SELECT process_date, count(*) AS production_rows,
               CAST(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS VARCHAR) AS DOUBLE) AS total_production_revenue,
               max(updated_at) AS last_updated_at
        FROM prod GROUP BY process_date""",
    "days": """
        SELECT s.*, p.production_rows, p.total_production_revenue, p.last_updated_at
        FROM staged_days s LEFT JOIN produced_days p ON s.process_date = p.process_date""",
    "day_labels": """
        SELECT *, CASE WHEN staging_rows = production_rows THEN '✅ MATCH'
                       WHEN staging_rows > production_rows THEN '❌ DATA LOSS'
                       ELSE '⚠️ OVER-COUNT' END AS completeness_status,
               CASE WHEN staging_rows = unique_staging_orders THEN '✅ UNIQUE'
                    ELSE '❌ DUPLICATES FOUND' END AS uniqueness_status
        FROM days""",
    "merged": """
        SELECT t.order_id, coalesce(s.user_id, t.user_id) AS user_id,
               CASE WHEN s.order_id IS NULL THEN t.amount ELSE s.amount END AS amount,
               CASE WHEN s.order_id IS NULL THEN t.currency ELSE s.currency END AS currency,
               CASE WHEN s.order_id IS NULL THEN t.status ELSE s.status END AS status,
               CASE WHEN s.order_id IS NULL THEN t.event_count ELSE s.event_count END AS event_count,
               CASE WHEN s.order_id IS NULL THEN t.event_types ELSE s.event_types END AS event_types,
               CASE WHEN s.order_id IS NULL THEN t.user_segment ELSE s.user_segment END AS user_segment,
               CASE WHEN s.order_id IS NULL THEN t.lifetime_value ELSE s.lifetime_value END
                   AS lifetime_value,
               CASE WHEN s.order_id IS NULL THEN t.country ELSE s.country END AS country,
               t.process_date,
               CASE WHEN s.order_id IS NULL THEN t.row_hash ELSE s.row_hash END AS row_hash,
               t.created_at,
               CASE WHEN s.order_id IS NULL THEN t.updated_at
                    ELSE TIMESTAMP '2024-01-30 12:00:00' END AS updated_at
        FROM merge_target t
        LEFT JOIN merge_source s ON t.order_id = s.order_id AND t.process_date = s.process_date
        UNION ALL
        SELECT s.* FROM merge_source s
        WHERE NOT EXISTS (SELECT 1 FROM merge_target t
                          WHERE t.order_id = s.order_id AND t.process_date = s.process_date)""",
    "checks": """
        SELECT process_date, count(*) AS v1,
               count(*) FILTER (order_id IS NULL) AS v2,
               count(*) FILTER (amount < 0) AS v3,
               1.0 - count(DISTINCT order_id) / count(*) AS v4,
               count(user_segment) / count(*) AS v5,
               CAST(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS VARCHAR) AS DOUBLE) / count(amount) AS v6,
               date_sub('hour', max(updated_at), TIMESTAMP '2024-01-31 00:00:00') AS v7
        FROM prod GROUP BY process_date""",
    "check_rows": """
        SELECT process_date, n, "check", CAST(value AS DOUBLE) AS value, passed,
               CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT process_date, 1 AS n, 'Row Count > 0' AS "check", CAST(v1 AS DOUBLE) AS value,
                     v1 > 0 AS passed FROM checks
              UNION ALL SELECT process_date, 2, 'No Null Primary Keys', v2, v2 = 0 FROM checks
              UNION ALL SELECT process_date, 3, 'No Negative Amounts', v3, v3 = 0 FROM checks
              UNION ALL SELECT process_date, 4, 'Duplicate Rate < 1%', v4, v4 < 0.01 FROM checks
              UNION ALL SELECT process_date, 5, 'User Segment Coverage > 5%', v5, v5 > 0.05 FROM checks
              UNION ALL SELECT process_date, 6, 'Amount Range Sanity (avg $1-$1000)', v6,
                               v6 BETWEEN 1 AND 1000 FROM checks
              UNION ALL SELECT process_date, 7, 'Freshness < 24 Hours', v7, v7 < 24 FROM checks) c""",
    "landed_days": """
        SELECT 'orders' AS source, process_date AS dt, 'parquet' AS format, count(*) AS n
        FROM src_orders GROUP BY process_date
        UNION ALL
        SELECT 'events', CAST(ts AS DATE), f.format, count(*)
        FROM src_events, (VALUES ('parquet'), ('csv')) f(format) GROUP BY ALL
        UNION ALL
        SELECT 'user_segments', NULL, 'parquet', count(*) FROM src_segments
        UNION ALL
        SELECT 'nations', NULL, 'parquet', count(*) FROM nation""",
    "landed_files": """  -- one file for each dated source, day and format
        SELECT source, dt, format FROM landed_days WHERE dt IS NOT NULL
        UNION ALL SELECT 'events', DATE '2025-01-01', 'lacking'""",
}

# Synthetic values are cut from the hex digits of the MD5 of (seed, label, row).
def _code(label: str, start: int, length: int, row: str = "n") -> str:
    return f"substr(md5(concat_ws(':', '42', '{label}', CAST({row} AS VARCHAR))), {start}, {length})"


def _draw(label: str, size: int, start: int, length: int = 8) -> str:
    return f"(CAST(concat('0x', {_code(label, start, length)}) AS BIGINT) % {size})"


def _choice(label: str, values: list[str], start: int) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{listed}], {_draw(label, len(values), start, 4)} + 1)"


def _member(number: str) -> str:
    return f"concat('user_', lpad(CAST({number} AS VARCHAR), 6, '0'))"


def _time(label: str, start: int) -> str:
    seconds = f"TIMESTAMP '2026-03-19 00:00:00' - to_seconds(1 + {_draw(label, 604800, start)})"
    return f"strftime({seconds}, '%Y-%m-%dT%H:%M:%S')"


_PAGES = ["home", "search", "category", "product", "cart", "checkout", "account", "help"]

_ENRICHED = (
    "order_id, user_id, amount, currency, status, event_count, event_types, user_segment, "
    "lifetime_value, country, process_date, row_hash"
)

_SQL = {
    # Scans, sinks, layout
    "scan_orders": "SELECT * FROM src_orders",
    "scan_partition": """
        SELECT order_id, user_id, amount, currency, status,
               strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS created_at,
               CAST(process_date AS VARCHAR) AS process_date
        FROM src_orders WHERE process_date = DATE '1995-04-01'""",
    "scan_latest_dim": "SELECT * FROM src_segments",
    "scan_latest_csv": "SELECT * FROM src_segments",
    "scan_day_both_formats": """
        SELECT order_id, user_id, amount, currency, status,
               strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS created_at,
               CAST(process_date AS VARCHAR) AS process_date
        FROM src_orders WHERE process_date = DATE '1995-04-01'""",
    "scan_csv": "SELECT order_id, user_id, amount, currency, status FROM enriched",
    "sink_partition_overwrite": """
        SELECT * REPLACE (CASE WHEN process_date = DATE '1995-04-01' THEN amount + 1 ELSE amount END
                          AS amount) FROM enriched""",
    "sink_csv_and_parquet": """
        SELECT order_id, amount, f.format FROM enriched, (VALUES ('csv'), ('parquet')) f(format)""",
    "load_staging_truncate": "SELECT * FROM enriched WHERE process_date = DATE '1995-04-01'",
    "load_staging_multifile": """
        SELECT * REPLACE (CASE WHEN process_date < DATE '1995-01-01' THEN NULL ELSE country END
                          AS country) FROM enriched""",
    "verify_staging_count": "SELECT count(*) AS staging_rows FROM enriched",
    "not_null_gate": """
        SELECT * FROM enriched WHERE order_id IS NOT NULL AND amount IS NOT NULL
          AND currency IS NOT NULL AND process_date IS NOT NULL""",
    "clustered_layout": "SELECT * FROM enriched",
    "guarded_partition_read": """
        SELECT * FROM prod WHERE process_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'""",
    "guarded_view": """
        SELECT order_id, user_id, amount, process_date FROM prod
        WHERE process_date >= DATE '1995-01-01' AND process_date < DATE '1996-01-01'""",
    "view_last_90d": """
        SELECT * FROM enriched
        WHERE process_date >= (SELECT max(process_date) FROM enriched) - INTERVAL 90 DAY""",
    "stg_projection": """
        SELECT * REPLACE (TRY_CAST(CASE WHEN status = 'refunded' THEN 'bad-date'
                                        ELSE CAST(process_date AS VARCHAR) END AS DATE)
                          AS process_date) FROM enriched""",
    "expire_partitions": """
        SELECT zone, dt
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS dt FROM events) d,
             (VALUES ('raw', 90), ('quarantine', 14), ('staging', 7)) z(zone, days)
        WHERE dt < DATE '2024-02-06' - to_days(days)""",
    "synth_orders": f"""
        SELECT concat('ORD-', upper({_code('order', 1, 12)})) AS order_id,
               CASE WHEN {_draw('order more', 10000, 1)} >= 50
                    THEN {_member(_draw('order', 10000, 13))} END AS user_id,
               CASE WHEN n IN (42, 9999) THEN -(({_draw('order', 9901, 21)} + 100) / 100.0)
                    ELSE ({_draw('order', 49901, 21)} + 100) / 100.0 END AS amount,
               {_choice('order more', ['USD', 'EUR', 'GBP', 'INR', 'JPY'], 17)} AS currency,
               {_choice('order more', ['completed', 'pending', 'refunded'], 21)} AS status,
               {_time('order more', 9)} AS created_at,
               '2026-03-19' AS process_date
        FROM (SELECT o_orderkey AS n FROM orders) r""",
    "synth_events": f"""
        SELECT concat('EVT-', upper({_code('event id', 1, 12, 'id_row')})) AS event_id,
               {_member(_draw('event', 10000, 1))} AS user_id,
               {_choice('event', ['purchase', 'cart_add', 'page_view', 'wishlist', 'search'], 9)}
                   AS event_type,
               concat_ws('/', {_choice('event', _PAGES, 13)}, {_choice('event', _PAGES, 15)}) AS page_url,
               concat('SES-', {_code('event id', 13, 8)}) AS session_id,
               {_time('event', 17)} AS timestamp,
               '2026-03-19' AS process_date
        FROM (SELECT n, coalesce(last_value(fresh_row IGNORE NULLS) OVER (PARTITION BY n // 100000
                  ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n) AS id_row
              FROM (SELECT n, CASE WHEN {_draw('event', 10000, 25)} >= 100 OR n % 100000 = 0
                                   THEN n END AS fresh_row
                    FROM (SELECT event_id AS n FROM events) e) f) r""",
    "synth_segments": f"""
        SELECT {_member('n')} AS user_id,
               {_choice('segment', ['premium', 'standard', 'budget', 'new', 'churned'], 17)} AS segment,
               ({_draw('segment', 999001, 1)} + 1000) / 100.0 AS lifetime_value,
               CAST(DATE '2026-03-19' - CAST({_draw('segment', 731, 9)} AS INTEGER) AS VARCHAR)
                   AS signup_date,
               {_choice('segment', ['US', 'DE', 'GB', 'IN', 'JP', 'FR', 'BR', 'CA', 'AU', 'ZA'], 21)}
                   AS country
        FROM (SELECT c_custkey AS n, (SELECT count(*) FROM customer) AS size FROM customer) c
        WHERE (n * (SELECT min(s) FROM (SELECT unnest(range(CAST(round(t * 0.6180339887) AS BIGINT), 2 * t)) AS s,
                                               t FROM (SELECT count(*) AS t FROM customer) p) q
                    WHERE gcd(s, t) = 1) + 42) % size < size // 10""",
    # Landing
    "file_inventory": """  -- small tables land as one file for each source, day and format
        SELECT source, dt, format, count(*) AS files, CAST(sum(bytes = 0) AS BIGINT) AS empty_files
        FROM (SELECT source, dt, format, 1 AS bytes FROM landed_days
              UNION ALL VALUES ('events', DATE '2025-01-01', 'parquet', 1),
                               ('events', DATE '2025-01-02', 'parquet', 1),
                               ('events', DATE '2025-01-02', 'parquet', 0)) f
        GROUP BY source, dt, format""",
    "pending_transfer": """
        SELECT file_name, length FROM files
        WHERE file_name NOT IN (SELECT file_name FROM ledger)""",
    "pending_validation": """
        SELECT file_name, length FROM files
        WHERE file_name NOT IN (SELECT file_name FROM ledger WHERE status = 'validated')""",
    "ledger_upsert": "SELECT file_name, TIMESTAMP '2024-01-30 12:00:00' AS processed_at, status FROM judged",
    "ledger_compacted": "SELECT file_name, TIMESTAMP '2024-01-30 12:00:00' AS processed_at, status FROM judged",
    "detect_source": """
        SELECT file_name, source FROM files
        UNION ALL SELECT concat(source, '/x.parquet'), NULL FROM documents""",
    "reject_empty_file": """
        SELECT file_name, 'quarantined:empty' AS status FROM files WHERE length = 0""",
    "schema_check_parquet": """
        SELECT source, dt, true AS is_valid,
               CASE WHEN source <> 'nations' THEN '' END AS missing, n AS rows
        FROM landed_days WHERE format = 'parquet'
        UNION ALL
        SELECT 'events', DATE '2025-01-01', false, 'timestamp', count(*)
        FROM src_events WHERE CAST(ts AS DATE) = DATE '2024-01-01'
        UNION ALL
        SELECT 'events', DATE '2025-01-02', false, NULL, NULL""",
    "schema_check_csv": """
        SELECT source, dt, false AS is_valid, 'timestamp' AS missing, n AS rows
        FROM landed_days WHERE format = 'csv'""",
    "missing_required": """
        SELECT file_name, CASE WHEN missing IS NOT NULL
                               THEN coalesce(list_aggregate(missing, 'string_agg', ','), '') END AS missing,
               CAST(len(missing) AS INTEGER) AS n_missing
        FROM (SELECT * REPLACE (CASE WHEN columns IS NULL THEN NULL ELSE missing END AS missing)
              FROM checked) c""",
    "registry_lookup": """
        SELECT file_name, source, list_aggregate(required, 'string_agg', ',') AS required
        FROM registered""",
    "format_dispatch": "SELECT file_name, is_valid, message FROM judged",
    "route_files": """
        SELECT file_name, status, CASE WHEN is_valid THEN 'validated' ELSE 'quarantine' END AS zone
        FROM judged""",
    "validation_summary": """
        SELECT CASE WHEN file_name IN (SELECT file_name FROM ledger) THEN 'skipped'
                    WHEN is_valid THEN 'validated' ELSE 'quarantined' END AS status_class,
               count(*) AS files
        FROM judged GROUP BY ALL""",
    "quarantine_rate": """
        SELECT source, count(*) AS files, count(*) FILTER (NOT is_valid) AS quarantined,
               count(*) FILTER (NOT is_valid) / count(*) AS rate,
               count(*) FILTER (NOT is_valid) / count(*) > 0.01 AS alert
        FROM judged GROUP BY source""",
    "quarantine_rows": """
        SELECT order_id, seq, amount,
               concat_ws('; ', CASE WHEN user_id IS NULL THEN 'user_id is null' END,
                         CASE WHEN amount <= 0 THEN 'amount is not positive' END) AS reasons
        FROM src_orders WHERE user_id IS NULL OR amount <= 0""",
    "good_rows": "SELECT * FROM valid_orders",
    "schema_drift_by_day": """
        SELECT s.source, s.dt, d.column_name, d.change, count(*) AS files, max(a.n) AS of_files,
               d.change <> 'added' AS is_breaking
        FROM landed_files s
        JOIN (VALUES ('events', 'parquet', 'page_url', 'removed'), ('events', 'parquet', 'session_id', 'removed'),
                     ('events', 'csv', 'page_url', 'removed'), ('events', 'csv', 'session_id', 'removed'),
                     ('events', 'csv', 'timestamp', 'removed'), ('events', 'csv', 'ts', 'added'),
                     ('events', 'lacking', 'page_url', 'removed'), ('events', 'lacking', 'session_id', 'removed'),
                     ('events', 'lacking', 'timestamp', 'removed')) d(source, format, column_name, change)
          ON d.source = s.source AND d.format = s.format
        JOIN (SELECT source, dt, count(*) AS n FROM landed_files GROUP BY ALL) a ON a.source = s.source AND a.dt = s.dt
        GROUP BY s.source, s.dt, d.column_name, d.change""",
    "schema_drift": """
        WITH types(duck, spark) AS (
            VALUES ('VARCHAR', 'string'), ('DOUBLE', 'double'), ('BIGINT', 'bigint'), ('INTEGER', 'int')),
        landed AS (  -- columns of the landed files: as text, or with the type of the table's column
            SELECT v.source, v.column_name, coalesce(t.spark, 'string') AS data_type
            FROM (VALUES ('orders', 'order_id', NULL), ('orders', 'user_id', NULL),
                         ('orders', 'amount', 'o_totalprice'), ('orders', 'currency', NULL),
                         ('orders', 'status', NULL), ('orders', 'created_at', NULL),
                         ('orders', 'process_date', NULL), ('events', 'event_id', NULL),
                         ('events', 'user_id', NULL), ('events', 'event_type', 'event_type'),
                         ('events', 'timestamp', NULL), ('events', 'ts', NULL),
                         ('events', 'process_date', NULL), ('user_segments', 'user_id', NULL),
                         ('user_segments', 'segment', 'c_mktsegment'),
                         ('user_segments', 'lifetime_value', 'c_acctbal'),
                         ('user_segments', 'country', 'n_name')) v(source, column_name, derived)
            LEFT JOIN duckdb_columns() c ON c.column_name = v.derived AND NOT c.internal
            LEFT JOIN types t ON t.duck = c.data_type),
        contract(source, column_name, data_type) AS (
            VALUES ('orders', 'order_id', 'string'), ('orders', 'user_id', 'string'),
                   ('orders', 'amount', 'double'), ('orders', 'currency', 'string'),
                   ('orders', 'status', 'string'), ('orders', 'created_at', 'string'),
                   ('orders', 'process_date', 'string'), ('events', 'event_id', 'string'),
                   ('events', 'user_id', 'string'), ('events', 'event_type', 'string'),
                   ('events', 'page_url', 'string'), ('events', 'session_id', 'string'),
                   ('events', 'timestamp', 'string'), ('events', 'process_date', 'string'),
                   ('user_segments', 'user_id', 'string'), ('user_segments', 'segment', 'string'),
                   ('user_segments', 'lifetime_value', 'double'),
                   ('user_segments', 'signup_date', 'string'), ('user_segments', 'country', 'string'))
        SELECT DISTINCT coalesce(c.source, l.source) AS source,
               coalesce(c.column_name, l.column_name) AS column_name,
               CASE WHEN l.source IS NULL THEN 'removed' WHEN c.source IS NULL THEN 'added'
                    ELSE 'retyped' END AS change, c.source IS NOT NULL AS is_breaking
        FROM contract c FULL OUTER JOIN landed l
          ON c.source = l.source AND c.column_name = l.column_name
        WHERE l.source IS NULL OR c.source IS NULL OR c.data_type <> l.data_type""",
    "stream_validated": """
        SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp,
               CAST(CAST(ts AS DATE) AS VARCHAR) AS process_date
        FROM src_events""",
    "stream_new_files": """
        SELECT order_id, user_id, amount, currency, status,
               strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS created_at,
               CAST(process_date AS VARCHAR) AS process_date
        FROM valid_orders""",
    # Filters and projections
    "filter_positive_amount": "SELECT * FROM src_orders WHERE amount > 0",
    "filter_user_not_null": "SELECT * FROM src_orders WHERE user_id IS NOT NULL",
    "null_key_filter": "SELECT * FROM src_orders WHERE user_id IS NULL",
    "narrow_dimension": "SELECT user_id, segment, lifetime_value, country FROM src_segments",
    "project_enriched": "SELECT * FROM enriched",
    "run_date_column": "SELECT order_id, DATE '2026-03-19' AS process_date FROM enriched",
    "audit_columns": """
        SELECT order_id, TIMESTAMP '2024-01-30 12:00:00' AS created_at,
               TIMESTAMP '2024-01-30 12:00:00' AS updated_at FROM merge_target""",
    "one_date": "SELECT * FROM prod WHERE process_date = DATE '1995-04-01'",
    "incremental_watermark": """
        SELECT *, created_at AS updated_at FROM src_orders
        WHERE created_at > TIMESTAMP '1997-06-30 00:00:00'""",
    "watermark_state": """
        SELECT max(created_at) AS watermark, CAST(0 AS BIGINT) AS rows_after FROM src_orders""",
    "incremental_max_date": """
        SELECT * FROM enriched
        WHERE process_date >= (SELECT max(process_date) FROM prod
                               WHERE process_date < DATE '1995-03-01'
                                 AND process_date >= DATE '1990-01-01')""",
    "recent_done_queries": """
        SELECT job_id, query, creation_time, job_type, state, total_bytes_billed, total_slot_ms
        FROM jobs WHERE creation_time > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 48 HOUR
          AND job_type = 'QUERY' AND state = 'DONE'""",
    "case_labels": "SELECT process_date, completeness_status, uniqueness_status FROM day_labels",
    # Dedup, joins, aggregates
    "dedup_orders": "SELECT * FROM unique_orders",
    "dedup_events": "SELECT * FROM unique_events",
    "join_segments_broadcast": """
        SELECT o.*, s.segment, s.lifetime_value, s.country
        FROM src_orders o LEFT JOIN src_segments s ON o.user_id = s.user_id""",
    "join_event_aggregates": """
        SELECT o.*, e.event_count, e.event_types
        FROM src_orders o LEFT JOIN user_events e ON o.user_id = e.user_id""",
    "enriched_orders": f"SELECT {_ENRICHED} FROM enriched",
    "enriched_orders_exact": """
        SELECT e.order_id, u.event_type_set AS event_types,
               sha256(concat_ws('||', e.order_id, CAST(CAST(e.amount AS DECIMAL(18,2)) AS VARCHAR),
                                e.currency)) AS row_hash
        FROM enriched e LEFT JOIN user_events u ON e.user_id = u.user_id""",
    "join_reconcile": """
        SELECT s.process_date, s.staging_rows, p.production_rows, p.last_updated_at
        FROM (SELECT process_date, count(*) AS staging_rows FROM enriched GROUP BY process_date) s
        LEFT JOIN produced_days p ON s.process_date = p.process_date""",
    "unnest_tables": "SELECT job_id, unnest(refs) AS table_id FROM jobs",
    "events_per_user": "SELECT user_id, event_count FROM user_events",
    "event_types_list": "SELECT user_id, event_types FROM user_events",
    "event_types_set": "SELECT user_id, event_type_set AS event_types FROM user_events",
    "row_hash": """
        SELECT order_id, seq,
               sha256(concat_ws('||', order_id, CAST(amount AS VARCHAR), currency)) AS row_hash,
               sha256(concat_ws('||', order_id, CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR), currency))
                   AS row_hash_exact
        FROM src_orders""",
    "concat_skip_nulls": """
        SELECT order_id, seq, CASE WHEN user_id IS NULL THEN order_id
                                   ELSE order_id || '||' || user_id END AS joined FROM src_orders""",
    "amount_text": """
        SELECT order_id, seq, CAST(amount AS VARCHAR) AS shown,
               CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) AS exact FROM src_orders""",
    "date_literal": """
        SELECT DATE '1995-04-01' AS process_date, count(*) AS row_count
        FROM enriched WHERE process_date = DATE '1995-04-01'""",
    # Reports
    "global_counts": """
        SELECT count(*) AS row_count, count(*) FILTER (user_id IS NULL) AS null_keys FROM src_orders""",
    "staging_stats": """
        SELECT process_date, staging_rows, unique_staging_orders,
               total_staging_revenue,
               avg_staging_amount, null_order_ids
        FROM staged_days""",
    "production_stats": """
        SELECT process_date, production_rows,
               total_production_revenue, last_updated_at
        FROM produced_days""",
    "pipeline_metrics": """
        SELECT process_date, staging_rows, production_rows, completeness_status, uniqueness_status,
               total_staging_revenue,
               total_production_revenue,
               total_staging_revenue - total_production_revenue AS revenue_variance,
               avg_staging_amount AS price_point_telemetry,
               null_order_ids AS primary_key_violations, last_updated_at,
               date_sub('minute', last_updated_at, TIMESTAMP '2024-01-31 00:00:00')
                   AS minutes_since_last_run
        FROM day_labels ORDER BY process_date DESC""",
    "report_by_date": """
        SELECT process_date, production_rows FROM produced_days ORDER BY process_date DESC""",
    "revenue_variance": """
        SELECT s.process_date,
               s.revenue - p.total_production_revenue AS revenue_variance,
               s.revenue = p.total_production_revenue AS is_balanced
        FROM (SELECT process_date, CAST(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS VARCHAR) AS DOUBLE) AS revenue
              FROM enriched GROUP BY process_date) s
        LEFT JOIN produced_days p ON s.process_date = p.process_date""",
    "stage_row_reconcile": """
        SELECT stage_no, stage, rows, lag(rows) OVER (ORDER BY stage_no) - rows AS lost
        FROM (SELECT 1 AS stage_no, 'landed' AS stage, count(*) AS rows FROM src_orders
              UNION ALL SELECT 2, 'valid', count(*) FROM valid_orders
              UNION ALL SELECT 3, 'deduplicated', count(*) FROM unique_orders
              UNION ALL SELECT 4, 'staging', count(*) FROM enriched
              UNION ALL SELECT 5, 'production', count(*) FROM prod) s""",
    "defect_profile": """
        SELECT 'null user_id' AS defect, count(*) AS rows FROM src_orders WHERE user_id IS NULL
        UNION ALL SELECT 'negative amount', count(*) FROM src_orders WHERE amount < 0
        UNION ALL SELECT 'repeated event_id', count(*) - count(DISTINCT event_id) FROM src_events""",
    "cost_by_table": """
        SELECT table_id, count(*) AS query_count,
               round(sum(total_bytes_billed) / pow(1024, 3), 2) AS gb_billed,
               round(sum(total_bytes_billed) / pow(1024, 4) * 6.25, 2) AS estimated_cost_usd
        FROM done_tables GROUP BY table_id ORDER BY gb_billed DESC, table_id""",
    "sort_cost_desc": """
        SELECT table_id, round(sum(total_bytes_billed) / pow(1024, 3), 2) AS gb_billed
        FROM done_tables GROUP BY table_id ORDER BY gb_billed DESC, table_id""",
    "slot_usage_hourly": """
        SELECT date_trunc('hour', creation_time) AS hour, count(*) AS jobs,
               round(sum(total_slot_ms) / 1000 / 3600, 1) AS slot_hours,
               round(avg(total_bytes_billed) / pow(1024, 3), 2) AS avg_gb_per_query
        FROM done GROUP BY 1 ORDER BY 1""",
    "storage_cost": """
        SELECT p_brand AS dataset, count(*) AS table_count,
               round(sum(p_size * 1000000000::BIGINT) / pow(1024, 3), 2) AS total_gb,
               round(sum(p_size * 1000000000::BIGINT) / pow(1024, 4) * 0.02, 4) AS storage_cost_usd_month
        FROM part GROUP BY p_brand ORDER BY total_gb DESC, dataset""",
    "top_scans": """
        SELECT job_id, query, total_bytes_billed,
               round(total_bytes_billed / pow(1024, 3), 2) AS gb_billed,
               CASE WHEN total_bytes_billed > 10737418240
                    THEN '⚠️ LARGE SCAN — check partition filter' ELSE '✅ OK' END AS cost_alert
        FROM done ORDER BY total_bytes_billed DESC, job_id LIMIT 20""",
    # Merge
    "merge_upsert": "SELECT * FROM merged",
    "merge_idempotent": "SELECT * EXCLUDE (updated_at) FROM merged",
    "merge_ambiguous_guard": """
        SELECT order_id, count(*) AS rows FROM prod GROUP BY order_id HAVING count(*) > 1""",
    "late_arrival_merge": """
        SELECT * FROM merged WHERE process_date = DATE '1995-04-01'
        UNION ALL SELECT * FROM merge_target WHERE process_date <> DATE '1995-04-01'""",
    "first_run_publish": """
        SELECT * REPLACE (TIMESTAMP '2024-01-31 00:00:00' AS created_at,
                          TIMESTAMP '2024-01-31 00:00:00' AS updated_at) FROM enriched""",
    "incremental_merge": """
        SELECT * REPLACE (CASE WHEN process_date = DATE '1995-01-01' THEN DATE '1995-02-01'
                               ELSE process_date END AS process_date)
        FROM enriched WHERE process_date >= DATE '1995-01-01'
        UNION ALL
        SELECT * FROM merge_target WHERE process_date < DATE '1995-01-01'""",
    "table_materialise": "SELECT process_date, production_rows, last_updated_at FROM produced_days",
    "changed_rows": """
        SELECT s.order_id, CASE WHEN t.order_id IS NULL THEN 'new' ELSE 'changed' END AS change
        FROM merge_source s LEFT JOIN merge_target t ON s.order_id = t.order_id
        WHERE t.order_id IS NULL OR t.row_hash IS DISTINCT FROM s.row_hash""",
    "merge_verify": """
        SELECT staging_rows, production_rows,
               CASE WHEN production_rows >= staging_rows THEN '✅ MERGE SUCCESSFUL'
                    ELSE '❌ ROW COUNT MISMATCH — INVESTIGATE' END AS status
        FROM (SELECT (SELECT count(*) FROM enriched) AS staging_rows,
                     (SELECT count(*) FROM prod) AS production_rows) c""",
    # Gates, checks, tests
    "gate_nonempty": """
        SELECT 'nonempty' AS gate, CAST(count(*) AS DOUBLE) AS value, count(*) >= 1 AS passed,
               CASE WHEN count(*) < 1 THEN 'QUALITY CHECK FAILED: Output is empty!' END AS message
        FROM enriched""",
    "gate_row_explosion": """
        SELECT 'row_explosion' AS gate, after / before AS value, after <= before * 1.05 AS passed,
               CASE WHEN after > before * 1.05
                    THEN concat('QUALITY CHECK FAILED: Row explosion detected! Input=', before,
                                ', Output=', after) END AS message
        FROM (SELECT (SELECT count(*) FROM unique_orders) AS before,
                     (SELECT count(*) FROM unique_orders)
                     + (SELECT count(*) FROM unique_orders
                        WHERE user_id IN (SELECT user_id FROM src_segments)) AS after) c""",
    "gate_premerge": """
        SELECT gate, CAST(value AS DOUBLE) AS value, passed,
               CASE WHEN NOT passed THEN concat('ABORT: Found ', value,
                    ' rows beyond the first of their order_id in staging') END AS message
        FROM (SELECT 'staging_nonempty' AS gate, count(*) AS value, count(*) > 0 AS passed FROM prod
              UNION ALL
              SELECT 'staging_null_keys', count(*), count(*) = 0 FROM prod WHERE order_id IS NULL
              UNION ALL
              SELECT 'staging_ambiguous', count(order_id) - count(DISTINCT order_id),
                     count(order_id) = count(DISTINCT order_id) FROM prod) g""",
    "gate_thresholds": """
        SELECT 'nonempty' AS gate, CAST(count(*) AS DOUBLE) AS value, false AS passed,
               'QUALITY CHECK FAILED: Output is empty!' AS message FROM prod""",
    "gate_message": """
        SELECT concat('ABORT: Found ', count(*), ' null order_ids in staging') AS message
        FROM src_orders WHERE user_id IS NULL""",
    **{
        key: f"""
        SELECT process_date, "check", value, passed, status FROM check_rows WHERE n = {n}"""
        for n, key in enumerate(
            ("dq_row_count", "dq_null_pk", "dq_negative_amount", "dq_duplicate_rate",
             "dq_segment_coverage", "dq_amount_range", "dq_freshness"), 1)
    },
    "dq_suite": """SELECT process_date, "check", value, passed, status FROM check_rows""",
    "dq_suite_total": """
        SELECT "check", value, passed,
               CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT 'Row Count > 0' AS "check", CAST(count(*) AS DOUBLE) AS value,
                     count(*) > 0 AS passed FROM prod
              UNION ALL SELECT 'No Null Primary Keys', count(*), count(*) = 0
                        FROM prod WHERE order_id IS NULL
              UNION ALL SELECT 'No Negative Amounts', count(*), count(*) = 0 FROM prod WHERE amount < 0
              UNION ALL SELECT 'Duplicate Rate < 1%', 1.0 - count(DISTINCT order_id) / count(*),
                               1.0 - count(DISTINCT order_id) / count(*) < 0.01 FROM prod
              UNION ALL SELECT 'User Segment Coverage > 5%', count(user_segment) / count(*),
                               count(user_segment) / count(*) > 0.05 FROM prod
              UNION ALL SELECT 'Amount Range Sanity (avg $1-$1000)', 
                               CAST(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS VARCHAR) AS DOUBLE) / count(amount),
                               CAST(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS VARCHAR) AS DOUBLE) / count(amount)
                                   BETWEEN 1 AND 1000 FROM prod
              UNION ALL SELECT 'Freshness < 24 Hours',
                               date_sub('hour', max(updated_at), TIMESTAMP '2024-01-31 00:00:00'),
                               date_sub('hour', max(updated_at), TIMESTAMP '2024-01-31 00:00:00') < 24
                        FROM prod) c""",
    "dq_suite_apart": """
        SELECT "check", value, passed,
               CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT 'Row Count > 0' AS "check", CAST(count(*) AS DOUBLE) AS value,
                     count(*) > 0 AS passed FROM prod
              UNION ALL SELECT 'No Null Primary Keys', count(*), count(*) = 0
                        FROM prod WHERE order_id IS NULL
              UNION ALL SELECT 'No Negative Amounts', count(*), count(*) = 0 FROM prod WHERE amount < 0
              UNION ALL SELECT 'Duplicate Rate < 1%', 1.0 - count(DISTINCT order_id) / count(*),
                               1.0 - count(DISTINCT order_id) / count(*) < 0.01 FROM prod
              UNION ALL SELECT 'User Segment Coverage > 5%', count(user_segment) / count(*),
                               count(user_segment) / count(*) > 0.05 FROM prod
              UNION ALL SELECT 'Amount Range Sanity (avg $1-$1000)', 
                               CAST(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS VARCHAR) AS DOUBLE) / count(amount),
                               CAST(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS VARCHAR) AS DOUBLE) / count(amount)
                                   BETWEEN 1 AND 1000 FROM prod
              UNION ALL SELECT 'Freshness < 24 Hours',
                               date_sub('hour', max(updated_at), TIMESTAMP '2024-01-31 00:00:00'),
                               date_sub('hour', max(updated_at), TIMESTAMP '2024-01-31 00:00:00') < 24
                        FROM prod) c
        UNION ALL SELECT 'Discounts Known', NULL, false, 'ERROR'
        UNION ALL SELECT 'Currency Is A Number', NULL, false, 'ERROR'""",
    "dq_score": """
        SELECT process_date, count(*) FILTER (passed) AS passed, count(*) AS checks,
               count(*) FILTER (passed) / count(*) AS score,
               count(*) FILTER (passed) / count(*) < 0.98 AS alert
        FROM check_rows GROUP BY process_date""",
    "test_unique": """
        SELECT order_id, count(*) AS rows FROM prod WHERE order_id IS NOT NULL
        GROUP BY order_id HAVING count(*) > 1""",
    "test_not_null": "SELECT * FROM src_orders WHERE user_id IS NULL",
    "column_tests": """
        SELECT 'unique' AS test, count(*) AS failures
        FROM (SELECT user_id FROM src_orders WHERE user_id IS NOT NULL
              GROUP BY user_id HAVING count(*) > 1) u
        UNION ALL SELECT 'not_null', count(*) FROM src_orders WHERE user_id IS NULL""",
}


def _named_in(sql: str) -> list[str]:
    return [name for name in _PARTS if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql)]


def _with_parts(sql: str) -> str:
    needed: set[str] = set()
    waiting = _named_in(sql)
    while waiting:
        name = waiting.pop()
        if name not in needed:
            needed.add(name)
            waiting += _named_in(_PARTS[name])
    if not needed:
        return sql.strip()
    parts = ",\n".join(f"{name} AS ({_PARTS[name]})" for name in _PARTS if name in needed)
    return f"WITH {parts}\n{sql.strip()}"


def oracle_sql() -> dict[str, str]:
    return {key: _with_parts(sql) for key, sql in _SQL.items()}
