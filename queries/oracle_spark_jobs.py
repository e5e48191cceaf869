"""DuckDB oracles for match statistics, layout reports and enrichment jobs."""

from __future__ import annotations

from .standin_sql import with_standins

MATCHES = with_standins("matches", "match_details", "medals_matches_players", "medals",
                        "maps") + """,
stats AS (
  SELECT 'avg_kills_per_game' AS metric, player_gamertag AS key,
         CAST(AVG(player_total_kills) AS DOUBLE) AS value
  FROM match_details GROUP BY player_gamertag
  UNION ALL
  SELECT 'playlist_plays', playlist_id, CAST(COUNT(DISTINCT match_id) AS DOUBLE)
  FROM matches GROUP BY playlist_id
  UNION ALL
  SELECT 'map_plays', mp.name, CAST(COUNT(DISTINCT m.match_id) AS DOUBLE)
  FROM matches m JOIN maps mp ON mp.mapid = m.mapid GROUP BY mp.name
  UNION ALL
  SELECT 'killing_spree_medals', mp.name, CAST(SUM(x.count) AS DOUBLE)
  FROM medals_matches_players x
  JOIN medals md ON md.medal_id = x.medal_id AND md.name = 'Killing Spree'
  JOIN matches m ON m.match_id = x.match_id
  JOIN maps mp ON mp.mapid = m.mapid
  GROUP BY mp.name)"""

AGG = with_standins("web_events", "devices") + """,
agg AS (SELECT user_id, device_id, COUNT(*) AS event_counts FROM web_events
        WHERE user_id IS NOT NULL GROUP BY 1, 2)"""

ORACLES = {
    "bucket_join_report": MATCHES + """,
per_match AS (SELECT match_id, SUM(count) AS n FROM medals_matches_players GROUP BY match_id),
res AS (SELECT playlist_id, COUNT(*) AS n_rows, CAST(SUM(player_total_kills) AS BIGINT) AS kills,
               CAST(SUM(COALESCE(n, 0)) AS BIGINT) AS n_medals
        FROM match_details d JOIN matches m ON m.match_id = d.match_id
        LEFT JOIN per_match p ON p.match_id = d.match_id GROUP BY playlist_id)
SELECT variant, res.* FROM res, (VALUES ('plain'), ('bucketed')) v(variant)""",
    "layout_report": with_standins("web_events") + """,
res AS (SELECT COUNT(*) AS n_rows, COUNT(DISTINCT CAST(event_time AS DATE)) AS n_values,
               CAST(SUM(event_id) AS BIGINT) AS checksum FROM web_events)
SELECT variant, res.* FROM res,
  (VALUES ('unsorted'), ('date_host'), ('host_url_date'), ('global_date_host')) v(variant)""",
    "match_stats": MATCHES + " SELECT metric, key, round(value, 6) AS value FROM stats",
    "match_leaders": MATCHES + """
SELECT metric, key, round(value, 6) AS value
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY metric ORDER BY value DESC, key DESC) AS rn
      FROM stats) WHERE rn = 1""",
    "typed_enrichment": with_standins("web_events", "devices") + """
SELECT e.user_id, d.device_id, upper(d.browser_type) AS browser_type, d.os_type, d.device_type,
       COALESCE(e.referrer, 'unknow') AS referrer, e.host, e.url, e.event_time
FROM web_events e JOIN devices d ON e.device_id = d.device_id
WHERE e.user_id IS NOT NULL AND e.device_id IS NOT NULL""",
    "shared_aggregate_users": AGG + """
SELECT user_id, MAX(event_counts) AS total_hits, COUNT(device_id) AS n_devices,
       CAST(SUM(event_counts) AS BIGINT) AS n_events
FROM agg GROUP BY user_id""",
    "shared_aggregate_devices": AGG + """
SELECT d.device_id, d.device_type, COUNT(*) AS n_users,
       CAST(SUM(a.event_counts) AS BIGINT) AS n_events
FROM devices d JOIN agg a ON a.device_id = d.device_id
GROUP BY d.device_id, d.device_type""",
    "event_device_left": with_standins("web_events", "devices") + """
SELECT e.device_id, e.url, e.referrer, e.user_id, e.host, e.event_time, e.ip, e.event_id,
       CAST(e.event_time AS DATE) AS event_date, d.browser_type AS browser_family,
       d.os_type AS os_family, d.device_type
FROM web_events e LEFT JOIN devices d ON d.device_id = e.device_id""",
}

ORACLES["shared_aggregate_job"] = AGG + """
SELECT 'user' AS side, CAST(user_id AS VARCHAR) AS id, COUNT(device_id) AS n_others,
       CAST(SUM(event_counts) AS BIGINT) AS n_events
FROM agg GROUP BY user_id
UNION ALL
SELECT 'device', CAST(d.device_id AS VARCHAR), COUNT(*), CAST(SUM(a.event_counts) AS BIGINT)
FROM devices d JOIN agg a ON a.device_id = d.device_id GROUP BY d.device_id, d.device_type"""
