"""DuckDB oracles for growth accounting and analytical patterns."""

from __future__ import annotations

from .oracle_dimensional import DEDUP_DETAILS, PLAYERS
from .standin_sql import STANDINS, with_standins

D1 = "DATE '2024-01-30'"

GROWTH = with_standins("web_events") + f""",
act AS (SELECT DISTINCT user_id, CAST(event_time AS DATE) AS date FROM web_events
        WHERE user_id IS NOT NULL AND CAST(event_time AS DATE) <= {D1}),
firsts AS (SELECT user_id, MIN(date) AS first_active_date FROM act GROUP BY 1),
grid AS (SELECT user_id, first_active_date,
                CAST(UNNEST(generate_series(CAST(first_active_date AS TIMESTAMP),
                                            CAST({D1} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
         FROM firsts),
marked AS (SELECT g.user_id, g.first_active_date, g.date, a.user_id IS NOT NULL AS active
           FROM grid g LEFT JOIN act a ON a.user_id = g.user_id AND a.date = g.date),
w AS (SELECT *,
        MAX(CASE WHEN active THEN date END) OVER (PARTITION BY user_id ORDER BY date
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_last,
        COUNT(CASE WHEN active THEN 1 END) OVER (PARTITION BY user_id ORDER BY date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_dates,
        string_agg(CASE WHEN active THEN CAST(date AS VARCHAR) END, ',') OVER (PARTITION BY user_id
            ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dates
      FROM marked),
growth AS (
  SELECT user_id, date, first_active_date,
         CASE WHEN active THEN date ELSE prev_last END AS last_active_date,
         CASE WHEN date = first_active_date THEN 'New'
              WHEN active AND prev_last = date - 1 THEN 'Retained'
              WHEN active AND prev_last < date - 1 THEN 'Resurrected'
              WHEN NOT active AND prev_last = date - 1 THEN 'Churned'
              ELSE 'Stale' END AS daily_active_state,
         CASE WHEN date = first_active_date THEN 'New'
              WHEN active AND prev_last < date - 7 THEN 'Resurrected'
              WHEN NOT active AND prev_last = date - 8 THEN 'Churned'
              WHEN (CASE WHEN active THEN date ELSE prev_last END) + 7 >= date - 1 THEN 'Retained'
              ELSE 'Stale' END AS weekly_active_state,
         n_dates, dates
  FROM w)"""

DEVICES_AUG = with_standins("web_events", "devices") + """,
aug AS (SELECT COALESCE(d.os_type, 'unknown') AS os_type,
               COALESCE(d.device_type, 'unknown') AS device_type,
               COALESCE(d.browser_type, 'unknown') AS browser_type,
               e.url, e.user_id, e.referrer, e.event_time
        FROM web_events e JOIN devices d ON e.device_id = d.device_id)"""

GAMES_SETS = DEDUP_DETAILS + f""",
games AS ({STANDINS['games']}),
j AS (SELECT d.player_name, d.team_abbreviation AS team, CAST(g.season AS VARCHAR) AS season,
             d.pts, d.game_id,
             CASE WHEN (d.team_id = g.home_team_id AND g.home_team_wins = 1)
                    OR (d.team_id = g.visitor_team_id AND g.home_team_wins = 0)
                  THEN d.game_id END AS won_game
      FROM deduped d JOIN games g ON g.game_id = d.game_id),
sets AS (
  SELECT 'player__team' AS aggregation_level, COALESCE(player_name, '(overall)') AS player_name,
         COALESCE(team, '(overall)') AS team, '(overall)' AS season, SUM(pts) AS total_pts,
         COUNT(DISTINCT game_id) AS n_games, COUNT(DISTINCT won_game) AS games_won
  FROM j GROUP BY player_name, team
  UNION ALL
  SELECT 'player__season', COALESCE(player_name, '(overall)'), '(overall)',
         COALESCE(season, '(overall)'), SUM(pts), COUNT(DISTINCT game_id), COUNT(DISTINCT won_game)
  FROM j GROUP BY player_name, season
  UNION ALL
  SELECT 'team', '(overall)', COALESCE(team, '(overall)'), '(overall)', SUM(pts),
         COUNT(DISTINCT game_id), COUNT(DISTINCT won_game)
  FROM j GROUP BY team)"""

# fixed values: the channel rules, first match wins
RULES = """,
rules(prio, pattern, label) AS (VALUES (1, '%linkedin%', 'Linkedin'), (2, '%t.co%', 'Twitter'),
    (3, '%google%', 'Google'), (4, '%lnkd%', 'Linkedin'), (5, '%home.example%', 'On Site'),
    (6, '%second-home.example%', 'On Site')),
"""

ORACLES = {
    "growth_accounting": GROWTH + " SELECT * FROM growth",
    "growth_accounting_step": GROWTH + f" SELECT * FROM growth WHERE date = {D1}",
    "retention": GROWTH + """
SELECT date_diff('day', first_active_date, date) AS days_since_first_active,
       round(CAST(COUNT(CASE WHEN daily_active_state IN ('Retained', 'Resurrected', 'New')
                             THEN 1 END) AS DOUBLE) / COUNT(*), 6) AS pct_active,
       COUNT(*) AS n_rows
FROM growth GROUP BY 1""",
    "season_state_changes": PLAYERS + """
SELECT player_id, current_season,
       CASE WHEN prev IS NULL THEN 'New'
            WHEN is_active AND prev THEN 'Continued Playing'
            WHEN NOT is_active AND prev THEN 'Retired'
            WHEN is_active AND NOT prev THEN 'Returned from Retirement'
            ELSE 'Stayed Retired' END AS season_state
FROM (SELECT *, LAG(is_active) OVER (PARTITION BY player_id ORDER BY current_season) AS prev
      FROM players)""",
    "funnel_conversion": with_standins("web_events") + """,
deduped AS (SELECT url, host, user_id, event_time FROM web_events GROUP BY 1, 2, 3, 4),
clean AS (SELECT *, CAST(event_time AS DATE) AS event_date FROM deduped WHERE user_id IS NOT NULL),
marked AS (SELECT *, MAX(event_time) OVER (PARTITION BY user_id, event_date) AS last_ts,
                  MAX(CASE WHEN url = '/purchase' THEN event_time END)
                    OVER (PARTITION BY user_id, event_date) AS last_target
           FROM clean),
conv AS (SELECT user_id, event_time, url, MAX(CASE WHEN last_target > event_time THEN 1 ELSE 0 END)
                  AS converted
         FROM marked WHERE last_ts > event_time GROUP BY 1, 2, 3)
SELECT url, COUNT(*) AS n, round(CAST(SUM(converted) AS DOUBLE) / COUNT(*), 6) AS conversion_rate
FROM conv GROUP BY url
HAVING CAST(SUM(converted) AS DOUBLE) / COUNT(*) > 0 AND COUNT(*) > 100""",
    "grouping_sets_dashboard": DEVICES_AUG + """
SELECT 'os_type__device_type__browser' AS aggregation_level, os_type, device_type, browser_type,
       COUNT(*) AS number_of_hits FROM aug GROUP BY os_type, device_type, browser_type
UNION ALL
SELECT 'browser_type', '(overall)', '(overall)', browser_type, COUNT(*) FROM aug GROUP BY browser_type
UNION ALL
SELECT 'os_type', os_type, '(overall)', '(overall)', COUNT(*) FROM aug GROUP BY os_type
UNION ALL
SELECT 'device_type', '(overall)', device_type, '(overall)', COUNT(*) FROM aug GROUP BY device_type""",
    "grouping_sets_games": GAMES_SETS + """
SELECT aggregation_level, player_name, team, season, round(total_pts, 6) AS total_pts,
       n_games, games_won FROM sets""",
    "grouping_sets_games_top": GAMES_SETS + """
SELECT aggregation_level, player_name, team, season, round(total_pts, 6) AS total_pts
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY aggregation_level
        ORDER BY total_pts DESC, player_name DESC, team DESC, season DESC) AS rn FROM sets)
WHERE rn = 1""",
    "referrer_trend": DEVICES_AUG + RULES + """chan AS (SELECT e.url, CAST(e.event_time AS DATE) AS event_date,
                COALESCE((SELECT r.label FROM rules r WHERE e.referrer LIKE r.pattern
                          ORDER BY r.prio LIMIT 1), e.referrer) AS referrer
         FROM aug e),
agg AS (SELECT url, referrer, event_date, COUNT(*) AS count,
               ROW_NUMBER() OVER (PARTITION BY referrer, url ORDER BY event_date) AS d
        FROM chan GROUP BY url, referrer, event_date),
tot AS (SELECT referrer, url, SUM(count) AS total FROM agg GROUP BY referrer, url),
mon AS (SELECT referrer, url, date_trunc('month', event_date) AS m, SUM(count) AS month_total
        FROM agg GROUP BY referrer, url, date_trunc('month', event_date)),
roll AS (SELECT a.referrer, a.url, a.event_date,
                SUM(CASE WHEN b.d BETWEEN a.d - 6 AND a.d THEN b.count END) AS weekly_rolling_count,
                SUM(CASE WHEN b.d BETWEEN a.d - 13 AND a.d - 6 THEN b.count END) AS previous_weekly_rolling_count
         FROM agg a JOIN agg b ON b.referrer = a.referrer AND b.url = a.url
         GROUP BY a.referrer, a.url, a.event_date)
SELECT a.referrer, a.url, a.event_date, a.count,
       CAST(r.weekly_rolling_count AS BIGINT) AS weekly_rolling_count,
       CAST(r.previous_weekly_rolling_count AS BIGINT) AS previous_weekly_rolling_count,
       round(CAST(a.count AS DOUBLE) / m.month_total, 6) AS pct_of_month,
       round(CAST(a.count AS DOUBLE) / t.total, 6) AS pct_of_total
FROM agg a
JOIN roll r ON r.referrer = a.referrer AND r.url = a.url AND r.event_date = a.event_date
JOIN tot t ON t.referrer = a.referrer AND t.url = a.url
JOIN mon m ON m.referrer = a.referrer AND m.url = a.url AND m.m = date_trunc('month', a.event_date)
WHERE t.total > 100 AND a.referrer IS NOT NULL""",
    "referrer_trend_calendar": DEVICES_AUG + RULES + """chan AS (SELECT e.url, CAST(e.event_time AS DATE) AS event_date,
                COALESCE((SELECT r.label FROM rules r WHERE e.referrer LIKE r.pattern
                          ORDER BY r.prio LIMIT 1), e.referrer) AS referrer
         FROM aug e),
agg AS (SELECT url, referrer, event_date, COUNT(*) AS count,
               CAST(event_date - DATE '1970-01-01' AS BIGINT) AS d
        FROM chan GROUP BY url, referrer, event_date),
tot AS (SELECT referrer, url, SUM(count) AS total FROM agg GROUP BY referrer, url),
mon AS (SELECT referrer, url, date_trunc('month', event_date) AS m, SUM(count) AS month_total
        FROM agg GROUP BY referrer, url, date_trunc('month', event_date)),
roll AS (SELECT a.referrer, a.url, a.event_date,
                SUM(CASE WHEN b.d BETWEEN a.d - 6 AND a.d THEN b.count END) AS weekly_rolling_count,
                SUM(CASE WHEN b.d BETWEEN a.d - 13 AND a.d - 7 THEN b.count END) AS previous_weekly_rolling_count
         FROM agg a JOIN agg b ON b.referrer = a.referrer AND b.url = a.url
         GROUP BY a.referrer, a.url, a.event_date)
SELECT a.referrer, a.url, a.event_date, a.count,
       CAST(r.weekly_rolling_count AS BIGINT) AS weekly_rolling_count,
       CAST(r.previous_weekly_rolling_count AS BIGINT) AS previous_weekly_rolling_count,
       round(CAST(a.count AS DOUBLE) / m.month_total, 6) AS pct_of_month,
       round(CAST(a.count AS DOUBLE) / t.total, 6) AS pct_of_total
FROM agg a
JOIN roll r ON r.referrer = a.referrer AND r.url = a.url AND r.event_date = a.event_date
JOIN tot t ON t.referrer = a.referrer AND t.url = a.url
JOIN mon m ON m.referrer = a.referrer AND m.url = a.url AND m.m = date_trunc('month', a.event_date)
WHERE t.total > 100 AND a.referrer IS NOT NULL""",
    "best_stretch": with_standins("games") + """,
rows_ AS (SELECT home_team_id AS team_id, game_date_est, game_id, home_team_wins AS won FROM games
          UNION ALL
          SELECT visitor_team_id, game_date_est, game_id, 1 - home_team_wins FROM games)
SELECT team_id, CAST(MAX(w) AS BIGINT) AS max_wins_in_stretch
FROM (SELECT team_id, SUM(won) OVER (PARTITION BY team_id ORDER BY game_date_est, game_id
                                     ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS w FROM rows_)
GROUP BY team_id""",
    "longest_streak": DEDUP_DETAILS + """,
marked AS (SELECT player_id, game_id, pts > 10 AS over_,
                  SUM(CASE WHEN pts > 10 THEN 0 ELSE 1 END) OVER (PARTITION BY player_id
                      ORDER BY game_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
           FROM deduped),
runs AS (SELECT player_id, run, COUNT(*) AS len FROM marked WHERE over_ GROUP BY 1, 2)
SELECT player_id, MAX(len) AS longest_run, COUNT(*) AS n_runs FROM runs GROUP BY player_id""",
}
