"""The same results in SQL, for checking against another engine."""

from __future__ import annotations

MONEY, TOTAL = "DECIMAL(18,2)", "DECIMAL(28,2)"
NET_PRICE = "l_extendedprice * (1 - l_discount)"
SPLIT, EARLIER = "TIMESTAMP '2024-01-20'", "TIMESTAMP '2024-01-15'"

CUSTOMERS = """
    SELECT c_custkey AS customer_id, c_name AS name, r_name AS region
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

MART = f"""
    SELECT l_orderkey AS txn_id, CAST(l_shipdate AS DATE) AS txn_date, c.customer_id,
           c.name AS customer_name, c.region, p_partkey AS product_sku, p_name AS product_name,
           p_brand AS category, CAST(l_quantity AS BIGINT) AS quantity,
           CAST(l_extendedprice AS {MONEY}) AS revenue,
           CAST(CAST(p_retailprice AS {MONEY}) * CAST(l_quantity AS BIGINT) AS {MONEY}) AS cost,
           CAST(CAST(l_extendedprice AS {MONEY})
                - CAST(p_retailprice AS {MONEY}) * CAST(l_quantity AS BIGINT) AS {MONEY}) AS gross_margin
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN ({CUSTOMERS}) c ON o_custkey = c.customer_id
    JOIN part ON l_partkey = p_partkey
"""

WATERMARK = f"(SELECT max(ts) FROM events WHERE ts < {SPLIT})"
LAGGED = f"{WATERMARK} - INTERVAL 86400 SECOND"

UPSERT = f"""
    WITH batch AS (SELECT * REPLACE (value + 1 AS value) FROM events WHERE ts >= {EARLIER}),
         target AS (SELECT * FROM events WHERE ts < {SPLIT})
    SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.event_id = t.event_id)
    UNION ALL
    SELECT * FROM batch
"""

TYPED_EVENTS = "SELECT * REPLACE (nullif(event_type, 'error') AS event_type) FROM events"

# Surrounding whitespace as code points.
SPACES = "' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(12288)"

BI_REPORT = f"""
    SELECT region, category, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
           CAST(sum(revenue) AS {TOTAL}) AS revenue, CAST(sum(gross_margin) AS {TOTAL}) AS gross_margin
    FROM ({MART}) GROUP BY region, category
"""

ORACLE_SQL: dict[str, str] = {
    "gold_mart": MART,
    "bi_report": BI_REPORT,
    "exported_report": BI_REPORT,
    "csv_report": BI_REPORT,
    "run_all_jobs": f"""
        SELECT region, count(*) AS orders, CAST(sum(CAST(o_totalprice AS {MONEY})) AS {MONEY}) AS revenue
        FROM orders JOIN ({CUSTOMERS}) ON o_custkey = customer_id GROUP BY region
    """,
    "load_history": f"""
        WITH first AS (SELECT *, coalesce(value > 0, false) AS good FROM events WHERE ts < {SPLIT}),
             batch AS (SELECT *, coalesce(value + 1 > 0, false) AS good, event_type = 'error' AS dead FROM events
                       WHERE ts >= (SELECT max(ts) FROM first WHERE good) - INTERVAL 86400 SECOND)
        SELECT 'events' AS table_name, 'loaded' AS status, count(*) FILTER (good) AS rows,
               count(*) FILTER (NOT good) AS rejected, CAST(0 AS BIGINT) AS deleted,
               max(ts) AS cursor_value FROM first
        UNION ALL
        SELECT 'events', 'loaded', count(*) FILTER (NOT dead AND good), count(*) FILTER (NOT dead AND NOT good),
               count(*) FILTER (dead), max(ts) FROM batch
    """,
    "summary_statistics": f"""
        SELECT count(*) AS order_count, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units_sold,
               CAST(round(sum({NET_PRICE}), 2) AS {TOTAL}) AS total_revenue,
               CAST(round(avg({NET_PRICE}), 2) AS {MONEY}) AS avg_order_value,
               count(DISTINCT l_partkey) AS unique_customers
        FROM lineitem
    """,
    "revenue_by_category": f"""
        SELECT p_brand AS category, count(*) AS orders,
               CAST(round(sum({NET_PRICE}), 2) AS {TOTAL}) AS revenue
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
    """,
    "revenue_by_region": f"""
        SELECT region, count(*) AS orders, CAST(round(sum(o_totalprice * 0.907::DOUBLE), 2) AS {TOTAL}) AS revenue
        FROM orders JOIN ({CUSTOMERS}) ON o_custkey = customer_id GROUP BY region
    """,
    "top_orders": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
    """,
    "max_cursor": "SELECT max(ts) AS max_cursor FROM events",
    "row_count": "SELECT count(*) AS row_count FROM events",
    "incremental_scan": f"SELECT * FROM events WHERE ts >= {WATERMARK}",
    "watermark_lag": f"SELECT * FROM events WHERE ts >= {LAGGED}",
    "late_rows": f"SELECT * FROM events WHERE ts >= {LAGGED} AND ts < {WATERMARK}",
    "incremental_orders": """
        SELECT l_orderkey AS order_id, strftime(l_shipdate, '%Y-%m-%d') AS order_date,
               CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS unit_price, l_shipdate AS updated_at,
               round_even(CAST(l_quantity AS BIGINT) * l_extendedprice * 100, 0) / 100 AS revenue
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'
    """,
    "upsert": UPSERT,
    "upsert_idempotent": UPSERT,
    "latest_by_key": """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
    "soft_delete": """
        SELECT * FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'error')
    """,
    "order_snapshot": "SELECT * FROM orders WHERE o_orderkey = 42",
    "ingest_cycle": f"""
        WITH batch AS (SELECT * REPLACE (value + 1 AS value) FROM events WHERE ts >= {LAGGED}),
             dead AS (SELECT event_id FROM batch WHERE event_type = 'error'),
             live AS (SELECT * FROM batch WHERE event_type <> 'error' AND coalesce(value > 0, false)),
             gone AS (SELECT event_id FROM dead UNION ALL SELECT event_id FROM live)
        SELECT * FROM live
        UNION ALL
        SELECT * FROM events WHERE ts <= {WATERMARK} AND event_id NOT IN (SELECT event_id FROM gone)
    """,
    "table_merge": f"""
        SELECT * FROM ({UPSERT})
        WHERE event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'error')
    """,
    "ingest_run": f"""
        WITH first AS (SELECT * FROM events WHERE ts < {SPLIT} AND coalesce(value > 0, false)),
             batch AS (SELECT * REPLACE (value + 1 AS value) FROM events
                       WHERE ts >= (SELECT max(ts) FROM first) - INTERVAL 86400 SECOND),
             dead AS (SELECT event_id FROM batch WHERE event_type = 'error'),
             live AS (SELECT * FROM batch WHERE event_type <> 'error' AND coalesce(value > 0, false)),
             gone AS (SELECT event_id FROM dead UNION ALL SELECT event_id FROM live),
             stored AS (SELECT * FROM live
                        UNION ALL
                        SELECT * FROM first WHERE event_id NOT IN (SELECT event_id FROM gone))
        SELECT event_id, ts, user_id, event_type, CAST(value AS {MONEY}) AS value, props FROM stored
    """,
    "stream_ingest": UPSERT,
    "table_append": "SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id = 42",
    "table_facts": "SELECT count(*) AS row_count, max(ts) AS max_cursor FROM events",
    "csv_with_bad_lines": """
        SELECT doc_id, text, source, '' AS failed FROM documents
        UNION ALL
        SELECT -1 - doc_id, 'cut off', NULL, 'malformed' FROM documents WHERE doc_id % 7 = 0
    """,
    "stream_dedup": "SELECT * FROM events",
    "stream_replay": f"""
        SELECT CAST(1 AS BIGINT) AS batch, count(*) AS rows, 'rejects' AS kind FROM events
        WHERE ts < TIMESTAMP '2024-01-05' AND ts < {WATERMARK} - INTERVAL 604800 SECOND
        UNION ALL
        SELECT NULL, count(*), 'table' FROM events
    """,
    "bucketed_upsert": f"""
        SELECT * FROM ({UPSERT})
        WHERE event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'error')
    """,
    "soft_delete_many": "SELECT * FROM events WHERE event_type <> 'error' OR event_type IS NULL",
    "written_counts": f"""
        SELECT count(*) FILTER (ts < {SPLIT}) AS first, count(*) FILTER (ts >= {SPLIT}) AS added, count(*) AS stored
        FROM events
    """,
    "footer_scalars": "SELECT count(*) AS row_count, max(event_id) AS max_cursor FROM events",
    "describe_columns": """
        SELECT * FROM (VALUES (1, 'txn_id', 'bigint'), (2, 'txn_date', 'date'), (3, 'customer_id', 'bigint'),
            (4, 'customer_name', 'string'), (5, 'region', 'string'), (6, 'product_sku', 'bigint'),
            (7, 'product_name', 'string'), (8, 'category', 'string'), (9, 'quantity', 'bigint'),
            (10, 'revenue', 'decimal(18,2)'), (11, 'cost', 'decimal(18,2)'), (12, 'gross_margin', 'decimal(18,2)'))
            AS t(position, column_name, data_type)
    """,
    "gate_aborts": "SELECT *, CAST(1 AS BIGINT) AS loads FROM customer WHERE c_acctbal > 0",
    "stateful_cursor": """
        WITH o AS (SELECT o_orderdate AS d FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'),
             runs(run, until, prior) AS (VALUES (1, TIMESTAMP '2000-07-01', TIMESTAMP '2000-01-01'),
                 (2, TIMESTAMP '2000-07-01', TIMESTAMP '2000-07-01'), (3, TIMESTAMP '2001-02-01', TIMESTAMP '2000-07-01'),
                 (4, TIMESTAMP '2100-01-01', TIMESTAMP '2001-02-01'))
        SELECT run, (SELECT count(*) FROM o WHERE d < until AND (run = 1 OR d >= (SELECT max(d) FROM o WHERE d < prior))) AS candidates,
               (SELECT count(*) FROM o WHERE d < until) AS stored,
               (SELECT strftime(max(d), '%Y-%m-%dT%H:%M:%S') FROM o WHERE d < until) AS cursor_value
        FROM runs
    """,
    "normalize_columns": """
        SELECT c_custkey AS cust_key, c_name AS name, c_nationkey AS nation_key, c_acctbal AS acct_bal,
               c_mktsegment AS mkt_segment FROM customer
    """,
    "trim_strings": f"""
        SELECT * REPLACE (trim(' ' || chr(9) || chr(10) || text || chr(13) || chr(10) || '  ', {SPACES}) AS text,
                          trim(chr(160) || lang || chr(12288) || chr(9), {SPACES}) AS lang, trim(source, {SPACES}) AS source)
        FROM documents
    """,
    "add_ingested_at": "SELECT *, '2024-02-01T00:00:00+00:00' AS _ingested_at FROM customer",
    "derive_line_totals": """
        SELECT l_orderkey, l_linenumber, l_extendedprice AS amount, l_quantity AS quantity,
               round_even(l_extendedprice / nullif(l_quantity, 0) * 100, 0) / 100 AS unit_price_effective,
               coalesce(l_quantity >= 5, false) AS is_bulk
        FROM lineitem
    """,
    "typed_orders": """
        SELECT l_orderkey AS order_id, CAST(l_shipdate AS DATE) AS order_date,
               CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS unit_price,
               round_even(CAST(l_quantity AS BIGINT) * l_extendedprice * 100, 0) / 100 AS revenue
        FROM lineitem
    """,
    "cast_money": f"SELECT * REPLACE (CAST(s_acctbal AS {MONEY}) AS s_acctbal) FROM supplier",
    "mask_pii": "SELECT * REPLACE (regexp_replace(text, '@[A-Za-z0-9.-]+', '@***', 'g') AS text) FROM documents",
    "add_lineage": f"""
        SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS {MONEY}) AS c_acctbal, c_mktsegment,
               'load-1' AS _load_id,
               sha256(CAST(to_json([CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR),
                                    CAST(CAST(c_acctbal AS {MONEY}) AS VARCHAR), c_mktsegment]) AS VARCHAR)) AS _row_id
        FROM customer
    """,
    "quality_not_null": f"SELECT * FROM ({TYPED_EVENTS}) WHERE event_type IS NULL",
    "quality_missing_column": "SELECT * FROM customer",
    "gate_warns": "SELECT * FROM customer",
    "quality_unique": "SELECT * FROM documents QUALIFY count(*) OVER (PARTITION BY text) > 1",
    "quality_positive": "SELECT * FROM customer WHERE NOT coalesce(c_acctbal > 0, false)",
    "quarantine_good": "SELECT * FROM customer WHERE c_name IS NOT NULL AND c_acctbal > 0",
    "quarantine_rejects": """
        SELECT *, concat_ws(',', CASE WHEN c_name IS NULL THEN 'not_null:c_name' END,
                            CASE WHEN NOT coalesce(c_acctbal > 0, false) THEN 'positive:c_acctbal' END) AS _failed
        FROM customer WHERE c_name IS NULL OR NOT coalesce(c_acctbal > 0, false)
    """,
    "gate_report": f"""
        WITH flags AS (
            SELECT event_type IS NULL AS a, NOT coalesce(value > 0, false) AS b,
                   count(*) OVER (PARTITION BY user_id) > 1 AS c, count(*) OVER (PARTITION BY event_id) > 1 AS d
            FROM ({TYPED_EVENTS}))
        SELECT count(*) AS total, count(*) FILTER (a) AS not_null_event_type,
               count(*) FILTER (b) AS positive_value, count(*) FILTER (c) AS unique_user_id,
               count(*) FILTER (d) AS unique_event_id, count(*) FILTER (a OR b OR c OR d) AS bad_count
        FROM flags
    """,
    "orders_gate": """
        SELECT count(*) AS total_rows, true AS all_required_columns_present,
               count(*) FILTER (l_orderkey IS NULL OR l_shipdate IS NULL OR l_suppkey IS NULL OR l_partkey IS NULL
                   OR l_linestatus IS NULL OR l_returnflag IS NULL OR l_quantity IS NULL
                   OR l_extendedprice IS NULL) = 0
                   AS no_nulls_in_required_fields,
               count(*) = count(DISTINCT l_orderkey) AS order_id_is_unique,
               count(*) FILTER (NOT coalesce(l_quantity > 0, false)) = 0 AS quantity_positive,
               count(*) FILTER (NOT coalesce(l_extendedprice > 0, false)) = 0 AS unit_price_positive,
               count(*) FILTER (l_shipdate IS NULL) = 0 AS order_date_parses
        FROM lineitem
    """,
}
