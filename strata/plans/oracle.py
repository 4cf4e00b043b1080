"""DuckDB oracles: for each registered query, plain SQL over the driver's tables.

Written independently of the Spark code: windows with QUALIFY, anti joins with NOT EXISTS.
"""

from __future__ import annotations

EV = "event_id, ts, user_id, event_type, value, props"
EVC = f'{EV}, event_id % 4 AS "commit"'


def _rn(partition: str, order: str) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {partition} ORDER BY {order}) = 1"


ORDERS_FEED = """
SELECT o_orderkey AS orderid, o_custkey AS customer_id, o_orderdate AS ts,
       o_totalprice AS order_value, o_orderpriority AS priority
FROM orders"""

CUSTOMERS_FEED = """
SELECT c_custkey AS customer_id, c_name AS name, n_name AS state, c_mktsegment AS city,
       lower(c_name) || '@example.com' AS email, TIMESTAMP '2024-01-01 00:00:00' AS ts
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

GOLD = f"""
SELECT c.customer_id, c.name, c.state, c.city, c.email,
       o.orderid, o.ts AS order_ts, o.order_value, o.priority
FROM ({CUSTOMERS_FEED}) c JOIN ({ORDERS_FEED}) o ON c.customer_id = o.customer_id"""

ORDERS_TEXT = """
SELECT CAST(o_orderkey AS VARCHAR) AS orderid, CAST(o_custkey AS VARCHAR) AS customer_id,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS ts,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS order_value,
       o_orderpriority AS priority
FROM orders"""

ARRIVAL_USER = f"SELECT {EVC} FROM events {_rn('user_id', 'event_id % 4 DESC, ts DESC')}"
ARRIVAL_USER_TYPE = f"SELECT {EVC} FROM events {_rn('user_id, event_type', 'event_id % 4 DESC, ts DESC')}"

# orders, deletes at the ship date of returned lines, and the orders again 30 days later: the latest wins
TIMED_DELETES = f"""
SELECT * FROM (
    SELECT orderid, customer_id, ts, order_value, priority, 0 AS "commit", false AS deleted FROM ({ORDERS_FEED})
    UNION ALL SELECT l_orderkey, NULL, max(l_shipdate), NULL, NULL, 1, true FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey
    UNION ALL SELECT orderid, customer_id, ts + INTERVAL 30 DAY, order_value, 'AGAIN', 2, false FROM ({ORDERS_FEED}))
{_rn('orderid', 'ts DESC, "commit" DESC')}"""

ORACLE: dict[str, str] = {
    "precombine": f"SELECT {EV} FROM events {_rn('user_id', 'ts DESC NULLS LAST, event_id DESC')}",
    "upsert_arrival": ARRIVAL_USER,
    "upsert_event_time": f"SELECT {EVC} FROM events {_rn('user_id', 'ts DESC, event_id % 4 DESC')}",
    "upsert_partition_scope": ARRIVAL_USER_TYPE,
    "upsert_global_scope": ARRIVAL_USER,
    "composite_key_upsert": ARRIVAL_USER_TYPE,
    "insert_if_absent": f"""
        WITH e AS (SELECT {EV}, CAST(ts AS DATE) AS day, event_id % 4 AS arrival FROM events),
        base AS (SELECT *, CAST(0 AS BIGINT) AS "commit" FROM e WHERE arrival = 0 {_rn('user_id, day', 'ts DESC')}),
        batch AS (SELECT *, CAST(1 AS BIGINT) AS "commit" FROM e WHERE arrival > 0 {_rn('user_id, day', 'ts DESC, event_id DESC')})
        SELECT * FROM base
        UNION ALL
        SELECT * FROM batch b
        WHERE NOT EXISTS (SELECT 1 FROM base s WHERE s.user_id = b.user_id AND s.day = b.day)""",
    "delete_by_key": """
        SELECT *, CAST(0 AS BIGINT) AS "commit" FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_returnflag = 'R' AND l.l_orderkey = o.o_orderkey)""",
    "insert_overwrite_partition": f"""
        SELECT {EV}, CAST(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS BIGINT) AS "commit"
        FROM events WHERE event_type <> 'click' OR event_id % 2 = 0""",
    "bulk_insert": """
        SELECT *, CAST(0 AS BIGINT) AS "commit" FROM orders
        UNION ALL
        SELECT *, CAST(1 AS BIGINT) AS "commit" FROM orders WHERE o_orderstatus = 'O'""",
    "snapshot_read": ARRIVAL_USER,
    "mor_equals_cow": ARRIVAL_USER,
    "incremental_read": f'SELECT * FROM ({ARRIVAL_USER_TYPE}) WHERE "commit" > 2',
    "incremental_read_event_time": f"""
        SELECT * FROM (SELECT {EVC} FROM events {_rn('user_id, event_type', 'ts DESC, event_id % 4 DESC')})
        WHERE "commit" > 2""",
    "begin_commit": f'SELECT min("commit") - 1 AS begin_commit FROM ({ARRIVAL_USER_TYPE})',
    "last_commit": f"""SELECT max("commit") AS last_commit FROM ({ARRIVAL_USER_TYPE}) WHERE "commit" > 0""",
    "commit_list": 'SELECT DISTINCT o_orderkey % 60 AS "commit" FROM orders ORDER BY 1 LIMIT 50',
    "retain_versions": """
        SELECT *, o_orderkey % 10 AS "commit" FROM orders
        QUALIFY dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 10 DESC) <= 3""",
    "gold_orders": GOLD,
    "gold_incremental": f"SELECT * FROM ({GOLD}) WHERE orderid % 4 = 3",
    "pending_orders": f"SELECT * FROM ({ORDERS_FEED}) WHERE customer_id % 4 = 3",
    "late_dimension": GOLD,
    "refresh_dim": f"""
        SELECT customer_id, name, state, city,
               CASE WHEN city = 'BUILDING' THEN lower(name) || '@new.example.com' ELSE email END AS email,
               orderid, order_ts, order_value, priority
        FROM ({GOLD})""",
    "loader_views": GOLD,
    "sql_transformer": f"""
        SELECT orderid, customer_id, ts, order_value, lower(priority) AS priority FROM ({ORDERS_FEED})""",
    "empty_batch_noop": f'SELECT *, CAST(0 AS BIGINT) AS "commit" FROM ({ORDERS_FEED})',
    "parquet_scan": "SELECT * FROM orders",
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "partitioned_read": f"""SELECT *, CAST(0 AS BIGINT) AS "commit" FROM ({CUSTOMERS_FEED}) WHERE state IN ('NATION_2', 'NATION_7')""",
    "clustered_rewrite": f'SELECT *, CAST(0 AS BIGINT) AS "commit", true AS in_order FROM ({ORDERS_FEED})',
    "packed_log": f'SELECT *, orderid % 12 AS "commit" FROM ({ORDERS_FEED}) WHERE orderid % 12 > 5',
    "file_sizing": f'SELECT *, CAST(0 AS BIGINT) AS "commit" FROM ({ORDERS_FEED})',
    "catalog_table": f'SELECT *, CAST(0 AS BIGINT) AS "commit" FROM ({ORDERS_FEED})',
    "json_roundtrip": ORDERS_TEXT,
    "json_functions": ORDERS_TEXT,
    "bookmark_new_files": ORDERS_TEXT,
    "corrupt_quarantine": f"""
        SELECT t.* FROM ({ORDERS_TEXT}) t JOIN orders o ON t.orderid = CAST(o.o_orderkey AS VARCHAR)
        WHERE o.o_orderstatus <> 'P'""",
    "layered_chain": f"""
        SELECT CAST(c.customer_id AS VARCHAR) AS customer_id, c.name, c.state, c.city, c.email,
               o.orderid, o.ts AS order_ts, o.order_value, o.priority
        FROM ({CUSTOMERS_FEED}) c JOIN ({ORDERS_TEXT}) o ON CAST(c.customer_id AS VARCHAR) = o.customer_id""",
    "gold_stream": GOLD,
    "upsert_touched_buckets": f"SELECT orderid, customer_id, ts, order_value, true AS changed FROM ({ORDERS_FEED})",
    "catalog_table_partitioned": f"""
        SELECT customer_id, name, CASE WHEN city = 'BUILDING' THEN 'MOVED' ELSE state END AS state, city, email, ts,
               CAST(CASE WHEN city = 'BUILDING' THEN 7 END AS INTEGER) AS segment_code,
               CAST(CASE WHEN city = 'BUILDING' THEN 1 ELSE 0 END AS BIGINT) AS "commit"
        FROM ({CUSTOMERS_FEED})""",
    "quarantined_rows": """
        SELECT CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) || ',' || o_orderpriority AS line
        FROM orders WHERE o_orderstatus = 'P'""",
    "first_read_after_expiry": f"""
        SELECT orderid, customer_id, ts, order_value + CASE WHEN orderid % 4 = 1 THEN 1 ELSE 0 END AS order_value, priority
        FROM ({ORDERS_FEED})""",
    "increment_after_expiry": f"""
        SELECT orderid, customer_id, ts, order_value + 1 AS order_value, priority, CAST(4 AS BIGINT) AS "commit"
        FROM ({ORDERS_FEED}) WHERE orderid % 4 = 1""",
    "reset_reprocess": f"SELECT * REPLACE (lower(priority) AS priority) FROM ({GOLD})",
    "gold_deletes": f"""
        SELECT * FROM ({GOLD}) g
        WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_returnflag = 'R' AND l.l_orderkey = g.orderid)""",
    "event_time_deletes": f"""SELECT orderid, customer_id, ts, order_value, priority, CAST("commit" AS BIGINT) AS "commit" FROM ({TIMED_DELETES}) WHERE NOT deleted""",
    "event_time_deletes_increment": f"""SELECT orderid, ts, CAST("commit" AS BIGINT) AS "commit", deleted FROM ({TIMED_DELETES}) WHERE "commit" > 0""",
    "event_time_duplicates": f"""
        SELECT f.*, CAST(1 AS BIGINT) AS "commit" FROM ({ORDERS_FEED}) f JOIN orders o ON f.orderid = o.o_orderkey, range(2)
        WHERE o.o_orderstatus = 'O'""",
    "gold_moved_orders": f"""
        SELECT c.customer_id, c.name, c.state, c.city, c.email, o.orderid, o.ts AS order_ts, o.order_value, o.priority
        FROM ({CUSTOMERS_FEED}) c JOIN ({ORDERS_FEED}) o
          ON c.customer_id = o.customer_id + CASE WHEN o.orderid % 3 = 0 THEN 1 ELSE 0 END""",
    "gold_removed_customer": f"SELECT * FROM ({GOLD}) WHERE city <> 'BUILDING' OR state = 'NATION_2'",
    "get_or_insert": f"""
        WITH e AS (SELECT {EV}, CAST(ts AS DATE) AS day, event_id % 4 AS arrival FROM events),
        base AS (SELECT *, CAST(0 AS BIGINT) AS "commit" FROM e WHERE arrival = 0 {_rn('user_id, day', 'ts DESC')}),
        batch AS (SELECT *, CAST(1 AS BIGINT) AS "commit" FROM e WHERE arrival > 0 AND event_type = 'click' {_rn('user_id, day', 'ts DESC, event_id DESC')})
        SELECT s.* FROM base s SEMI JOIN batch b ON s.user_id = b.user_id AND s.day = b.day
        UNION ALL
        SELECT b.* FROM batch b ANTI JOIN base s ON s.user_id = b.user_id AND s.day = b.day""",
    "snapshot_as_of": f"SELECT {EVC} FROM events WHERE event_id % 4 <= 1 {_rn('user_id', 'event_id % 4 DESC, ts DESC')}",
    "change_rows": f"""
        WITH old AS (SELECT * FROM events WHERE event_id % 4 <= 1 {_rn('user_id', 'event_id % 4 DESC, ts DESC')}),
        new AS (SELECT * FROM ({ARRIVAL_USER}) WHERE "commit" > 1)
        SELECT n.user_id, CASE WHEN o.event_id IS NULL THEN 'insert' ELSE 'update' END AS change, o.event_id AS before_id, n.event_id AS after_id
        FROM new n LEFT JOIN old o ON n.user_id = o.user_id""",
    "delete_without_partition": f"""
        SELECT * FROM ({ARRIVAL_USER_TYPE}) e ANTI JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') c ON e.user_id = c.c_custkey""",
    "ingest_schema_drift": """
        SELECT o_orderkey AS orderid, o_totalprice AS price, strftime(o_orderdate, '%Y-%m-%d') AS ts,
               CASE WHEN o_orderkey % 2 = 0 THEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS rank,
               CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS status,
               CASE WHEN o_orderkey % 2 = 1 THEN '{"rank":"' || o_orderpriority || '"}' END AS _rescued
        FROM orders""",
    "regex_search": """SELECT * FROM events WHERE regexp_matches(props, '"[a-z]+": ?[0-9]*[05]\\b')""",
    "file_inventory": """
        SELECT 'a' AS folder, count(*) AS num_rows, true AS has_bytes FROM orders
        UNION ALL SELECT 'b/c', count(*), true FROM customer""",
    "column_stats": f"""
        SELECT 'orderid' AS "column", count(*) AS num_rows, CAST(min(orderid) AS DOUBLE) AS min_value, CAST(max(orderid) AS DOUBLE) AS max_value,
               CAST(count(*) - count(orderid) AS BIGINT) AS null_rows FROM ({ORDERS_FEED})
        UNION ALL SELECT 'customer_id', count(*), CAST(min(customer_id) AS DOUBLE), CAST(max(customer_id) AS DOUBLE),
               CAST(count(*) - count(customer_id) AS BIGINT) FROM ({ORDERS_FEED})
        UNION ALL SELECT 'order_value', count(*), CAST(min(order_value) AS DOUBLE), CAST(max(order_value) AS DOUBLE),
               CAST(count(*) - count(order_value) AS BIGINT) FROM ({ORDERS_FEED})""",
}
