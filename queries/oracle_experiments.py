"""DuckDB oracles for experiments and data quality."""

from __future__ import annotations

from .standin_sql import STANDINS, with_standins

ASSIGN = with_standins("web_events") + """,
users AS (SELECT DISTINCT user_id FROM web_events WHERE user_id IS NOT NULL),
b AS (SELECT user_id,
             CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR) || ':exp1'), 1, 8)) AS BIGINT) % 100
               AS bucket FROM users),
asg AS (SELECT user_id, 'exp1' AS experiment, bucket,
               CASE WHEN bucket < 50 THEN 'control' ELSE 'treatment' END AS cell,
               CASE WHEN bucket < 50 THEN 'blue' ELSE 'red' END AS button_color,
               'Data Engineering Boot Camp' AS paragraph_text
        FROM b)"""

ORACLES = {
    "experiment_assignment": ASSIGN + " SELECT * FROM asg",
    "experiment_exposures": ASSIGN + """
SELECT e.user_id, a.experiment, a.cell, 'visited_signup' AS event_name, e.event_time
FROM web_events e JOIN asg a ON a.user_id = e.user_id WHERE e.url = '/signup'""",
    "experiment_readout": ASSIGN + """,
per_user AS (SELECT user_id, COUNT(*) AS n_events,
                    MAX(CASE WHEN url = '/purchase' THEN 1 ELSE 0 END) AS converted,
                    MAX(CASE WHEN url = '/signup' THEN 1 ELSE 0 END) AS exposed
             FROM web_events WHERE user_id IS NOT NULL GROUP BY user_id),
j AS (SELECT a.experiment, a.cell, COALESCE(p.n_events, 0) AS n_events,
             COALESCE(p.converted, 0) AS converted, COALESCE(p.exposed, 0) AS exposed
      FROM asg a LEFT JOIN per_user p ON p.user_id = a.user_id),
cells AS (SELECT experiment, cell, COUNT(*) AS n_users, CAST(SUM(exposed) AS BIGINT) AS n_exposed,
                 CAST(SUM(converted) AS BIGINT) AS n_converted,
                 CAST(SUM(converted) AS DOUBLE) / COUNT(*) AS conversion_rate,
                 AVG(n_events) AS events_per_user
          FROM j GROUP BY experiment, cell),
ctl AS (SELECT experiment, n_users AS n0, n_converted AS x0, conversion_rate AS p0
        FROM cells WHERE cell = 'control'),
k AS (SELECT c.*, t.n0, t.x0, t.p0,
             CAST(c.n_converted + t.x0 AS DOUBLE) / (c.n_users + t.n0) AS pool
      FROM cells c LEFT JOIN ctl t ON t.experiment = c.experiment)
SELECT experiment, cell, n_users, n_exposed, n_converted, round(conversion_rate, 6) AS conversion_rate,
       round(events_per_user, 6) AS events_per_user,
       round(conversion_rate - p0, 6) AS diff_vs_control,
       round(CASE WHEN cell = 'control' THEN 0.0
                  ELSE (conversion_rate - p0)
                       / sqrt(pool * (1 - pool) * (1.0 / n_users + 1.0 / n0)) END, 6) AS z_score
FROM k""",
    "experiment_lagging": with_standins("web_events") + """,
per_user AS (SELECT user_id, COUNT(*) AS n FROM web_events WHERE user_id IS NOT NULL GROUP BY 1),
celled AS (SELECT *, CASE WHEN CAST('0x' || substr(md5(CAST(user_id AS VARCHAR) || ':exp1'), 1, 8) AS BIGINT) % 100 < 50
                          THEN 'control' ELSE 'treatment' END AS cell FROM per_user),
drawn AS (SELECT cell, n, r, CAST('0x' || substr(md5(CAST(user_id AS VARCHAR) || ':' || r || ':exp1'), 1, 8) AS BIGINT) AS u
          FROM celled, range(40) t(r)),
weighed AS (SELECT cell, n, r, list_count(list_filter(
              [1580030168, 3160060337, 3950075421, 4213413783, 4279248373, 4292415291, 4294609778], lambda c: u >= c)) AS w
            FROM drawn),
means AS (SELECT cell, r, CAST(SUM(w * n) AS DOUBLE) / SUM(w) AS m FROM weighed GROUP BY 1, 2),
diffs AS (SELECT list(t.m - c.m ORDER BY t.m - c.m) AS d FROM means t JOIN means c USING (r)
          WHERE t.cell = 'treatment' AND c.cell = 'control')
SELECT 'exp1' AS experiment, 'treatment' AS cell,
       round((SELECT AVG(n) FROM celled WHERE cell = 'treatment') - (SELECT AVG(n) FROM celled WHERE cell = 'control'), 6)
         AS diff_events_per_user,
       round(d[CAST(floor(0.025 * 39 + 0.5) AS INT) + 1], 6) AS low,
       round(d[CAST(floor(0.975 * 39 + 0.5) AS INT) + 1], 6) AS high
FROM diffs""",
    "grain_check": with_standins("game_details") + """
SELECT game_id, player_id, COUNT(*) AS n_rows FROM game_details
GROUP BY game_id, player_id HAVING COUNT(*) > 1""",
    "array_size_check": with_standins("web_events") + """,
per AS (SELECT user_id, COUNT(DISTINCT CAST(event_time AS DATE)) AS n FROM web_events
        WHERE user_id IS NOT NULL AND CAST(event_time AS DATE) <= DATE '2024-01-30'
        GROUP BY user_id)
SELECT n AS array_size, COUNT(*) AS n_rows FROM per GROUP BY n""",
    "dedup_game_details": with_standins("game_details") + f""",
games AS ({STANDINS['games']})
SELECT game_id, CAST(team_id AS BIGINT) AS team_id, player_id, player_name, pts, game_date_est,
       CAST(line_no AS BIGINT) AS line_no
FROM (SELECT d.*, g.game_date_est,
             ROW_NUMBER() OVER (PARTITION BY d.game_id, d.team_id, d.player_id
                                ORDER BY g.game_date_est, d.line_no, d.part_key,
                                         d.team_abbreviation, d.player_name, d.start_position,
                                         d.pts) AS rn
      FROM game_details d JOIN games g ON g.game_id = d.game_id)
WHERE rn = 1""",
    "dedup_events": with_standins("web_events") + """
SELECT user_id, event_time, event_id, url, host
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_time ORDER BY event_id) AS rn
      FROM web_events WHERE user_id IS NOT NULL)
WHERE rn = 1""",
    "dedup_events_full": with_standins("web_events") + """
SELECT user_id, event_time, event_id, url, host
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY url, host, user_id, event_time
                                   ORDER BY event_id) AS rn
      FROM web_events WHERE user_id IS NOT NULL)
WHERE rn = 1""",
}
