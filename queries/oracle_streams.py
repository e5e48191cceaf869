"""DuckDB oracles for the streaming jobs (every window of the closed stream)."""

from __future__ import annotations

from .standin_sql import with_standins

PARSED = with_standins("web_events", "geo") + """,
parsed AS (SELECT ip, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS event_time,
                  referrer, host, url, date_trunc('millisecond', event_time) AS event_timestamp
           FROM web_events)"""

SESSIONS = PARSED + """,
marked AS (SELECT ip, host, event_timestamp,
                  CASE WHEN event_timestamp - LAG(event_timestamp) OVER w > INTERVAL 5 MINUTE
                         OR LAG(event_timestamp) OVER w IS NULL THEN 1 ELSE 0 END AS new_
           FROM parsed WINDOW w AS (PARTITION BY ip, host ORDER BY event_timestamp)),
ids AS (SELECT *, SUM(new_) OVER (PARTITION BY ip, host ORDER BY event_timestamp
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
        FROM marked),
sess AS (SELECT ip, host, MIN(event_timestamp) AS session_start,
                MAX(event_timestamp) + INTERVAL 5 MINUTE AS session_end, COUNT(*) AS num_events
         FROM ids GROUP BY ip, host, sid)"""


# the batch job reads the raw (microsecond) event times, not the stream's text
SESSIONS_RAW = PARSED.replace(
    "date_trunc('millisecond', event_time) AS event_timestamp", "event_time AS event_timestamp"
) + SESSIONS[len(PARSED):]

ORACLES = {
    "stream_locate": with_standins("web_events", "networks") + """,
sized AS (SELECT *, CAST(pow(2, 32 - prefix_len) AS BIGINT) AS w FROM networks),
addresses AS (SELECT DISTINCT user_id * 2654435761 % 4294967296 AS address FROM web_events WHERE user_id IS NOT NULL),
ranked AS (
  SELECT a.address, CAST(json_object('country', n.country, 'state', COALESCE(n.state, ''), 'city', n.city) AS VARCHAR) AS geodata,
         ROW_NUMBER() OVER (PARTITION BY a.address
                            ORDER BY n.prefix_len DESC, n.country, n.state NULLS FIRST, n.city) AS rn
  FROM addresses a JOIN sized n ON a.address >= n.network // w * w AND a.address < (n.network // w + 1) * w)
SELECT CASE WHEN number IS NOT NULL THEN concat_ws('.', number // 16777216, number // 65536 % 256,
                                                   number // 256 % 256, number % 256) ELSE '' END AS ip,
       host, url, date_trunc('millisecond', event_time) AS event_timestamp, COALESCE(r.geodata, '{}') AS geodata
FROM (SELECT *, user_id * 2654435761 % 4294967296 AS number FROM web_events) e
LEFT JOIN ranked r ON r.address = e.number AND r.rn = 1""",
    "stream_sessions_recovered": SESSIONS + " SELECT * FROM sess",
    "stream_late_rows": with_standins("web_events") + """,
rows AS (SELECT ip, host, url, event_id % 10 = 0 AS second, date_trunc('millisecond', event_time) AS event_timestamp
         FROM web_events),
mark AS (SELECT MAX(event_timestamp) - INTERVAL 15 SECOND AS wm FROM rows WHERE NOT second)
SELECT ip, host, url, event_timestamp,
       second AND time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE <= wm AS is_late
FROM rows, mark""",
    "stream_exactly_once": PARSED + " SELECT ip, host, url, referrer, event_timestamp FROM parsed",
    "stream_parse": PARSED + " SELECT * FROM parsed",
    "stream_geo": PARSED + """
SELECT p.ip, p.host, p.url,
       CASE WHEN g.country IS NULL THEN '{}'
            ELSE CAST(json_object('country', COALESCE(g.country, ''), 'state', COALESCE(g.state, ''),
                                  'city', COALESCE(g.city, '')) AS VARCHAR) END AS geodata,
       p.event_timestamp
FROM parsed p LEFT JOIN geo g ON g.ip_key = CAST(p.ip AS BIGINT) % 30""",
    "stream_tumbling_host": PARSED + """
SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS event_hour, host,
       COUNT(host) AS num_hits
FROM parsed GROUP BY 1, 2""",
    "stream_tumbling_host_referrer": PARSED + """
SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS event_hour, host, referrer,
       COUNT(host) AS num_hits
FROM parsed GROUP BY 1, 2, 3""",
    "stream_sessions": SESSIONS + " SELECT * FROM sess",
    "sessions_batch": SESSIONS_RAW + " SELECT * FROM sess",
    "stream_dedup": PARSED + """
SELECT ip, event_timestamp, url, host
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ip, event_timestamp ORDER BY url, host) AS rn
      FROM parsed WHERE ip IS NOT NULL) WHERE rn = 1""",
    "session_stats": SESSIONS + """
SELECT COALESCE(host, '(overall)') AS host, round(AVG(num_events), 6) AS avg_events_per_session,
       COUNT(*) AS n_sessions
FROM sess GROUP BY GROUPING SETS ((host), ())""",
}
