"""DuckDB oracles for cumulative, SCD2 and graph queries."""

from __future__ import annotations

from .standin_sql import with_standins

FIRST, LAST, STEP = 1995, 2001, 2001

CLASS_PTS = ("CASE WHEN {v} > 20 THEN 'star' WHEN {v} > 15 THEN 'good' "
             "WHEN {v} > 10 THEN 'average' ELSE 'bad' END")
CLASS_RATING = ("CASE WHEN {v} > 8 THEN 'star' WHEN {v} > 7 THEN 'good' "
                "WHEN {v} > 6 THEN 'average' ELSE 'bad' END")

# closed form of the player snapshots: one row per (player, season) from the
# first season through LAST, facts of the seasons so far
PLAYERS = with_standins("entity_seasons") + f""",
keys AS (SELECT player_id, MIN(season) AS first_season, MAX(player_name) AS player_name,
                MAX(country) AS country FROM entity_seasons GROUP BY player_id),
snap AS (SELECT player_id, player_name, country,
                UNNEST(generate_series(first_season, {LAST})) AS current_season FROM keys),
so_far AS (SELECT s.player_id, s.current_season, COUNT(*) AS n_seasons,
                  MIN(e.season) AS first_season, MAX(e.season) AS last_season,
                  string_agg(e.season || ':' || e.gp, ',' ORDER BY e.season) AS season_list
           FROM snap s JOIN entity_seasons e
             ON e.player_id = s.player_id AND e.season <= s.current_season
           GROUP BY 1, 2),
players AS (
  SELECT s.player_id, s.player_name, s.country, CAST(s.current_season AS BIGINT) AS current_season,
         a.n_seasons, CAST(a.first_season AS BIGINT) AS first_season,
         CAST(a.last_season AS BIGINT) AS last_season, e.pts AS last_pts, a.season_list,
         {CLASS_PTS.format(v='e.pts')} AS scoring_class,
         CAST(s.current_season - a.last_season AS BIGINT) AS periods_since_last_active,
         a.last_season = s.current_season AS is_active
  FROM snap s JOIN so_far a ON a.player_id = s.player_id AND a.current_season = s.current_season
  JOIN entity_seasons e ON e.player_id = s.player_id AND e.season = a.last_season)
"""

PLAYERS_OUT = """SELECT player_id, player_name, country, current_season, n_seasons, first_season,
       last_season, round(last_pts, 6) AS last_pts, season_list, scoring_class, periods_since_last_active,
       is_active FROM players"""


def scd_sql(as_of: int) -> str:
    return PLAYERS + f""",
islands AS (
  SELECT player_id, scoring_class, is_active, current_season,
         ROW_NUMBER() OVER (PARTITION BY player_id ORDER BY current_season)
         - ROW_NUMBER() OVER (PARTITION BY player_id, scoring_class, is_active
                              ORDER BY current_season) AS island
  FROM players WHERE current_season <= {as_of})
SELECT player_id, scoring_class, is_active, MIN(current_season) AS start_period,
       MAX(current_season) AS end_period, CAST({as_of} AS BIGINT) AS current_period
FROM islands GROUP BY player_id, scoring_class, is_active, island"""


FILMS = with_standins("entity_films") + f""",
per_year AS (SELECT actorid, year, AVG(rating) AS avg_rating, COUNT(*) AS n FROM entity_films GROUP BY 1, 2),
keys AS (SELECT actorid, MIN(year) AS first_year, MAX(actor) AS actor FROM entity_films GROUP BY 1),
snap AS (SELECT actorid, actor, UNNEST(generate_series(first_year, {LAST})) AS current_year FROM keys),
so_far AS (SELECT s.actorid, s.current_year, COUNT(*) AS n_films, SUM(f.votes) AS total_votes,
                  MAX(f.year) AS last_year
           FROM snap s JOIN entity_films f ON f.actorid = s.actorid AND f.year <= s.current_year
           GROUP BY 1, 2),
lists AS (SELECT s.actorid, s.current_year, string_agg(y.year || ':' || y.n, ',' ORDER BY y.year) AS year_list
          FROM snap s JOIN per_year y ON y.actorid = s.actorid AND y.year <= s.current_year GROUP BY 1, 2)
SELECT s.actorid, s.actor, CAST(s.current_year AS BIGINT) AS current_year, a.n_films,
       CAST(a.total_votes AS BIGINT) AS total_votes, round(p.avg_rating, 6) AS latest_avg_rating, l.year_list,
       {CLASS_RATING.format(v='p.avg_rating')} AS quality_class,
       CAST(s.current_year - a.last_year AS BIGINT) AS periods_since_last_active,
       a.last_year = s.current_year AS is_active
FROM snap s JOIN so_far a ON a.actorid = s.actorid AND a.current_year = s.current_year
JOIN per_year p ON p.actorid = s.actorid AND p.year = a.last_year
JOIN lists l ON l.actorid = s.actorid AND l.current_year = s.current_year"""


DEDUP_DETAILS = with_standins("game_details") + """,
deduped AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY player_id, game_id
                   ORDER BY line_no, part_key, team_id, team_abbreviation, player_name,
                            start_position, pts) AS rn
                 FROM game_details) WHERE rn = 1)"""


ORACLES = {
    "cumulative_backfill": PLAYERS + PLAYERS_OUT,
    "cumulative_step": PLAYERS + PLAYERS_OUT + f" WHERE current_season = {STEP}",
    "cumulative_multi": FILMS,
    "history_unnest": with_standins("entity_seasons") + f"""
SELECT player_id, CAST(season AS BIGINT) AS season, gp, round(pts, 6) AS pts,
       round(reb, 6) AS reb, round(ast, 6) AS ast
FROM entity_seasons WHERE season <= {LAST}""",
    "history_ratio": with_standins("entity_seasons") + f""",
ends AS (SELECT player_id, MIN(season) AS s0, MAX(season) AS s1 FROM entity_seasons
         WHERE season <= {LAST} GROUP BY 1)
SELECT e.player_id,
       round(b.pts / CASE WHEN a.pts = 0 THEN 1 ELSE a.pts END, 6) AS ratio_most_recent_to_first
FROM ends e JOIN entity_seasons a ON a.player_id = e.player_id AND a.season = e.s0
JOIN entity_seasons b ON b.player_id = e.player_id AND b.season = e.s1""",
    "scd2_backfill": PLAYERS + """,
islands AS (
  SELECT player_id, scoring_class, current_season,
         ROW_NUMBER() OVER (PARTITION BY player_id ORDER BY current_season)
         - ROW_NUMBER() OVER (PARTITION BY player_id, scoring_class ORDER BY current_season) AS island
  FROM players)
SELECT player_id, scoring_class, MIN(current_season) AS start_period,
       MAX(current_season) AS end_period
FROM islands GROUP BY player_id, scoring_class, island""",
    "scd2_backfill_multi": scd_sql(LAST),
    "scd2_incremental": scd_sql(STEP),
    "team_vertices": with_standins("teams") + """
SELECT team_id AS identifier, 'team' AS type, abbreviation, nickname, city, arena,
       CAST(yearfounded AS VARCHAR) AS year_founded
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY team_id
        ORDER BY abbreviation, nickname, city, arena, yearfounded) AS rn FROM teams)
WHERE rn = 1""",
    "player_game_edges": DEDUP_DETAILS + """
SELECT player_id AS subject_identifier, 'player' AS subject_type, game_id AS object_identifier,
       'game' AS object_type, 'plays_in' AS edge_type, start_position,
       CAST(pts AS VARCHAR) AS pts, CAST(team_id AS VARCHAR) AS team_id, team_abbreviation
FROM deduped""",
    "player_partner_totals": DEDUP_DETAILS + """,
counted AS (
  SELECT player_id, player_name, pts,
         COUNT(*) OVER (PARTITION BY game_id, team_abbreviation)
           - COUNT(*) OVER (PARTITION BY game_id, team_abbreviation, player_name) AS mates,
         COUNT(*) OVER (PARTITION BY game_id) - COUNT(*) OVER (PARTITION BY game_id, player_name)
           - (COUNT(*) OVER (PARTITION BY game_id, team_abbreviation)
              - COUNT(*) OVER (PARTITION BY game_id, team_abbreviation, player_name)) AS opps,
         SUM(pts) OVER (PARTITION BY game_id, team_abbreviation)
           - SUM(pts) OVER (PARTITION BY game_id, team_abbreviation, player_name) AS mate_pts,
         SUM(pts) OVER (PARTITION BY game_id) - SUM(pts) OVER (PARTITION BY game_id, player_name)
           - (SUM(pts) OVER (PARTITION BY game_id, team_abbreviation)
              - SUM(pts) OVER (PARTITION BY game_id, team_abbreviation, player_name)) AS opp_pts
  FROM deduped),
sides AS (
  SELECT player_id, player_name, 'shares_team' AS edge_type, mates AS partners,
         pts * mates AS own, mate_pts AS other FROM counted
  UNION ALL
  SELECT player_id, player_name, 'plays_against', opps, pts * opps, opp_pts FROM counted)
SELECT player_id, player_name, edge_type, CAST(SUM(partners) AS BIGINT) AS partner_games,
       round(SUM(own), 6) AS own_points, round(SUM(other), 6) AS partner_points
FROM sides WHERE partners > 0 GROUP BY 1, 2, 3""",
}

# the same closed form cut at an earlier season: later players have no rows
ORACLES["cumulative_backfill_bounded"] = (PLAYERS + PLAYERS_OUT).replace(
    f"generate_series(first_season, {LAST})", "generate_series(first_season, 1998)")
ORACLES["scd2_incremental_rerun"] = ORACLES["scd2_incremental"]
