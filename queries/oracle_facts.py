"""DuckDB oracles for date lists, bit packing and reduced facts."""

from __future__ import annotations

from .standin_sql import with_standins

D0, D1 = "DATE '2024-01-01'", "DATE '2024-01-30'"
N_DAYS = 30

ACT = with_standins("web_events") + """,
act AS (SELECT user_id, CAST(event_time AS DATE) AS date, COUNT(*) AS n
        FROM web_events WHERE user_id IS NOT NULL GROUP BY 1, 2)"""

BITS = ACT + f""",
offs AS (SELECT user_id, date_diff('day', date, {D1}) AS o FROM act WHERE date <= {D1}),
bits AS (SELECT user_id,
           CAST(SUM(CASE WHEN o BETWEEN 0 AND 31 THEN CAST(1 AS BIGINT) << (31 - o) ELSE 0 END)
                AS BIGINT) AS datelist_int
         FROM offs GROUP BY user_id)"""

BROWSER = with_standins("web_events", "devices") + """,
dev AS (SELECT DISTINCT device_id, browser_type FROM devices WHERE device_id IS NOT NULL),
ua AS (SELECT DISTINCT user_id, device_id, CAST(event_time AS DATE) AS date
       FROM web_events WHERE user_id IS NOT NULL),
ba AS (SELECT DISTINCT ua.user_id,
              COALESCE(dev.browser_type, 'UNKNOWN_DEVICE_' || CAST(ua.device_id AS VARCHAR))
                AS browser_type, ua.date
       FROM ua LEFT JOIN dev ON dev.device_id = ua.device_id)"""


def list_out(key: str, src: str) -> str:
    return f"""
SELECT {key}, COUNT(*) AS n_dates, MIN(date) AS first_date, MAX(date) AS last_date,
       string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date) AS dates, {D1} AS date
FROM {src} WHERE date <= {D1} GROUP BY {key}"""


def day_csv(pairs: str, field: str, null: str) -> str:
    """Per day of the month the ``field`` of the matching pair, as CSV."""
    return (f"array_to_string(list_transform(range(0, {N_DAYS}), lambda i: "
            f"COALESCE(CAST(struct_extract(list_filter({pairs}, lambda p: p.d = {D0} + CAST(i AS INTEGER))[1],"
            f" '{field}') AS VARCHAR), '{null}')), ',')")


ORACLES = {
    "user_datelist": ACT + list_out("user_id", "act"),
    "host_datelist": with_standins("web_events") + """,
hact AS (SELECT host, CAST(event_time AS DATE) AS date FROM web_events
         WHERE host IS NOT NULL GROUP BY 1, 2)""" + list_out("host", "hact"),
    "datelist_int": BITS + f" SELECT user_id, datelist_int, {D1} AS date FROM bits",
    "datelist_int_compat": ACT + f""",
offs AS (SELECT user_id, date_diff('day', date, {D1}) AS o FROM act WHERE date <= {D1})
SELECT user_id,
       CAST(SUM(CASE WHEN o BETWEEN 0 AND 31 THEN CAST(1 AS BIGINT) << (32 - o) ELSE 0 END)
            AS BIGINT) & 4294967295 AS datelist_int, {D1} AS date
FROM offs GROUP BY user_id""",
    "activity_flags": BITS + """
SELECT user_id, datelist_int,
       bit_count(datelist_int) > 0 AS monthly_active,
       CAST(bit_count(datelist_int) AS BIGINT) AS l32,
       bit_count(datelist_int & 4261412864) > 0 AS weekly_active,
       CAST(bit_count(datelist_int & 4261412864) AS BIGINT) AS l7,
       bit_count(datelist_int & 33292288) > 0 AS weekly_active_previous_week
FROM bits""",
    "device_datelist": BROWSER + list_out("user_id, browser_type", "ba"),
    "device_day_matrix": BROWSER + f""",
per AS (SELECT user_id, browser_type, list(date) AS dates FROM ba WHERE date <= {D1} GROUP BY 1, 2)
SELECT user_id, browser_type,
       array_to_string(list_transform(range(0, {N_DAYS}), lambda i:
         CASE WHEN list_contains(dates, {D0} + CAST(i AS INTEGER)) THEN 1 ELSE 0 END), ',')
         AS datelist_int_array,
       CAST(len(list_filter(dates, lambda d: d BETWEEN {D0} AND {D1})) AS BIGINT) AS bit_count
FROM per""",
    "any_device_bits": BROWSER + f""",
ud AS (SELECT DISTINCT user_id, date FROM ba WHERE date <= {D1})
SELECT user_id,
       CAST(SUM(CASE WHEN date BETWEEN {D0} AND {D1}
                     THEN CAST(1 AS BIGINT) << date_diff('day', {D0}, date) ELSE 0 END) AS BIGINT)
         AS datelist_bits,
       COUNT(CASE WHEN date BETWEEN {D0} AND {D1} THEN 1 END) AS active_days
FROM ud GROUP BY user_id""",
    "monthly_hits": ACT + f""",
per AS (SELECT user_id, MIN(date) AS first_found_date, SUM(n) AS total,
               list({{'d': date, 'n': n}}) AS pairs
        FROM act WHERE date BETWEEN {D0} AND {D1} GROUP BY user_id)
SELECT user_id, {D0} AS month_start, first_found_date, {D1} AS date_partition,
       CAST({N_DAYS} AS BIGINT) AS n_days, CAST(total AS BIGINT) AS hits_total,
       {day_csv('pairs', 'n', 'null')} AS hits
FROM per""",
    "first_days_totals": ACT + f"""
SELECT {D0} AS month_start,
       CAST(SUM(CASE WHEN date = {D0} THEN n ELSE 0 END) AS BIGINT) AS num_hits_first_day,
       CAST(SUM(CASE WHEN date = {D0} + 1 THEN n ELSE 0 END) AS BIGINT) AS num_hits_second_day,
       CAST(SUM(CASE WHEN date = {D0} + 2 THEN n ELSE 0 END) AS BIGINT) AS num_hits_third_day
FROM act WHERE date BETWEEN {D0} AND {D1}""",
    "metric_array": ACT + f""",
per AS (SELECT user_id, SUM(n) AS total, list({{'d': date, 'n': n}}) AS pairs
        FROM act WHERE date BETWEEN {D0} AND {D1} GROUP BY user_id)
SELECT user_id, {D0} AS month_start, 'site_hits' AS metric_name,
       CAST({N_DAYS} AS BIGINT) AS n_days, CAST(total AS BIGINT) AS total,
       {day_csv('pairs', 'n', '0')} AS metric_array
FROM per""",
    "host_activity_reduced": with_standins("web_events") + f""",
hd AS (SELECT host, CAST(event_time AS DATE) AS date, COUNT(*) AS h, COUNT(DISTINCT user_id) AS v
       FROM web_events WHERE user_id IS NOT NULL AND host IS NOT NULL GROUP BY 1, 2),
per AS (SELECT host, list({{'d': date, 'h': h, 'v': v}}) AS pairs
        FROM hd WHERE date BETWEEN {D0} AND {D1} GROUP BY host)
SELECT host, {D0} AS month_start, CAST({N_DAYS} AS BIGINT) AS n_days,
       {day_csv('pairs', 'h', '0')} AS hit_array,
       {day_csv('pairs', 'v', '0')} AS unique_visitors
FROM per""",
    "metric_daily": ACT + f"""
SELECT 'site_hits' AS metric_name, CAST(days.d AS DATE) AS date,
       CAST(COALESCE(SUM(a.n), 0) AS BIGINT) AS value
FROM (SELECT UNNEST(generate_series(CAST({D0} AS TIMESTAMP), CAST({D1} AS TIMESTAMP),
                                    INTERVAL 1 DAY)) AS d) days
LEFT JOIN act a ON a.date = CAST(days.d AS DATE)
GROUP BY 1, 2""",
}

ORACLES["metric_array_upsert"] = ORACLES["metric_array"]
