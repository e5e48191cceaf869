"""DuckDB oracles for layouts, upserts of files and tables by year."""

from __future__ import annotations

from .standin_sql import with_standins

ORACLES = {
    "layout_zorder": with_standins("web_events") + """,
res AS (SELECT COUNT(*) AS n_rows, COUNT(DISTINCT CAST(event_time AS DATE)) AS n_values,
               CAST(SUM(event_id) AS BIGINT) AS checksum FROM web_events)
SELECT variant, res.* FROM res, (VALUES ('unsorted'), ('date_user'), ('z_user_date')) v(variant)""",
    "zorder_skipping": with_standins("web_events") + """
SELECT event_id, user_id, CAST(event_time AS DATE) AS event_date, host FROM web_events
WHERE user_id BETWEEN 20 AND 40
  AND CAST(event_time AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-14'""",
    "upsert_touched_files": """
SELECT o_custkey, COUNT(*) AS n_orders, MAX(o_orderkey) AS last_order
FROM orders, (SELECT MAX(c_custkey) * 2 / 3 AS edge FROM customer)
WHERE o_custkey > edge OR year(o_orderdate) <= 1998
GROUP BY o_custkey""",
    "orders_between": """
SELECT o_orderpriority, COUNT(*) AS n_orders, MIN(o_orderkey) AS first_order, MAX(o_orderkey) AS last_order
FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-11-15' AND DATE '1998-02-10'
GROUP BY o_orderpriority""",
}
