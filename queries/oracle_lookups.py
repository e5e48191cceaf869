"""DuckDB oracles for locations, partners and distinct visitors."""

from __future__ import annotations

from .standin_sql import with_standins

ORACLES = {
    "ip_location": with_standins("web_events", "networks") + """,
spread AS (SELECT event_id, host, CASE WHEN event_id % 50 > 0 THEN user_id * 2654435761 % 4294967296 END AS address
           FROM web_events),
addresses AS (SELECT DISTINCT address FROM spread WHERE address IS NOT NULL),
sized AS (SELECT *, CAST(pow(2, 32 - prefix_len) AS BIGINT) AS w FROM networks),
ranked AS (
  SELECT a.address, CAST(json_object('country', n.country, 'state', COALESCE(n.state, ''), 'city', n.city) AS VARCHAR) AS geodata,
         ROW_NUMBER() OVER (PARTITION BY a.address
                            ORDER BY n.prefix_len DESC, n.country, n.state NULLS FIRST, n.city) AS rn
  FROM addresses a JOIN sized n ON a.address >= n.network // w * w AND a.address < (n.network // w + 1) * w)
SELECT s.event_id, s.host,
       CASE WHEN s.address IS NOT NULL THEN concat_ws('.', s.address // 16777216, s.address // 65536 % 256,
                                                      s.address // 256 % 256, s.address % 256) END AS ip,
       COALESCE(r.geodata, '{}') AS geodata
FROM spread s LEFT JOIN ranked r ON r.address = s.address AND r.rn = 1""",
    "strongest_partners": with_standins("game_details") + """,
lines AS (SELECT player_id, game_id, pts,
                 ROW_NUMBER() OVER (PARTITION BY player_id, game_id ORDER BY line_no, part_key, pts) AS rn
          FROM game_details),
one AS (SELECT * FROM lines WHERE rn = 1)
SELECT a.player_id, b.player_id AS partner_id, COUNT(*) AS shared_games,
       SUM(a.pts) AS own_points, SUM(b.pts) AS partner_points
FROM one a JOIN one b ON b.game_id = a.game_id AND b.player_id <> a.player_id
GROUP BY 1, 2 HAVING COUNT(*) >= 6""",
    "distinct_visitors": with_standins("web_events") + """,
seen AS (SELECT host, user_id, CAST(event_time AS DATE) AS day FROM web_events WHERE user_id IS NOT NULL)
SELECT 'day' AS span, host, day AS first_day, COUNT(DISTINCT user_id) AS n_visitors FROM seen GROUP BY ALL
UNION ALL
SELECT 'week', host, CAST(date_trunc('week', day) AS DATE), COUNT(DISTINCT user_id) FROM seen GROUP BY ALL
UNION ALL
SELECT 'month', host, CAST(date_trunc('month', day) AS DATE), COUNT(DISTINCT user_id) FROM seen GROUP BY ALL
UNION ALL
SELECT '5 to 18 January', host, DATE '2024-01-05', COUNT(DISTINCT user_id) FROM seen
WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-18' GROUP BY ALL""",
}
