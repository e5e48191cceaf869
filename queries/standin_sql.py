"""DuckDB SQL text of the stand-in tables (independent of the Spark code in
``dimstack.sources.standins``; both follow FIXTURES.md §3 and the README)."""

from __future__ import annotations

STANDINS = {
    "entity_seasons": """
      SELECT o.player_id, c.c_name AS player_name, CAST(c.c_nationkey AS VARCHAR) AS country,
             o.season, o.gp,
             CAST(o.s_sum AS DOUBLE) / (o.gp * CAST(15000 AS DOUBLE)) AS pts,
             CAST(o.s_min AS DOUBLE) / CAST(15000 AS DOUBLE) AS reb,
             CAST(o.s_max AS DOUBLE) / CAST(15000 AS DOUBLE) AS ast
      FROM (SELECT o_custkey AS player_id, year(o_orderdate) AS season,
                   COUNT(*) AS gp,
                   SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS s_sum,
                   MIN(CAST(o_totalprice AS DECIMAL(18,2))) AS s_min,
                   MAX(CAST(o_totalprice AS DECIMAL(18,2))) AS s_max
            FROM orders GROUP BY 1, 2) o
      JOIN customer c ON c.c_custkey = o.player_id""",
    "entity_films": """
      SELECT c.c_name AS actor, o.o_custkey AS actorid, 'film_' || CAST(o.o_orderkey AS VARCHAR) AS film,
             year(o.o_orderdate) AS year, o.o_orderkey % 1000 AS votes,
             o.o_totalprice / CAST(50000 AS DOUBLE) AS rating, o.o_orderkey AS filmid
      FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""",
    "game_details": """
      SELECT l.l_orderkey AS game_id, s.s_nationkey AS team_id, n.n_name AS team_abbreviation,
             l.l_suppkey AS player_id, s.s_name AS player_name, l.l_returnflag AS start_position,
             l.l_quantity AS pts, l.l_linenumber AS line_no, l.l_partkey AS part_key
      FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
      JOIN nation n ON n.n_nationkey = s.s_nationkey""",
    "games": """
      SELECT o.o_orderkey AS game_id, CAST(o.o_orderdate AS DATE) AS game_date_est,
             year(o.o_orderdate) AS season,
             CAST(c.c_nationkey AS BIGINT) AS home_team_id,
             CAST((c.c_nationkey + 1 + o.o_orderkey % 24) % 25 AS BIGINT) AS visitor_team_id,
             CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS home_team_wins
      FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""",
    "teams": """
      SELECT CAST(s.s_nationkey AS BIGINT) AS team_id, substr(n.n_name, 1, 3) AS abbreviation,
             s.s_name AS nickname, n.n_name AS city, CAST(s.s_suppkey AS VARCHAR) AS arena,
             CAST(1900 + s.s_suppkey % 100 AS BIGINT) AS yearfounded
      FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey""",
    "web_events": """
      SELECT '/' || event_type AS url,
             CASE event_id % 8
               WHEN 0 THEN 'https://www.linkedin.com/feed/'
               WHEN 1 THEN 'https://t.co/x1'
               WHEN 2 THEN 'https://www.google.com/'
               WHEN 3 THEN 'https://lnkd.in/abc'
               WHEN 4 THEN 'https://www.home.example/blog'
               WHEN 5 THEN 'https://blog.second-home.example/about'
               WHEN 6 THEN 'https://news.ycombinator.com/'
               ELSE NULL END AS referrer,
             user_id,
             CAST(json_extract_string(props, '$.k') AS BIGINT) AS device_id,
             CASE CAST(json_extract_string(props, '$.k') AS BIGINT) % 3
               WHEN 0 THEN 'www.home.example'
               WHEN 1 THEN 'home.example'
               ELSE 'lab.partner.example' END AS host,
             ts AS event_time, CAST(user_id AS VARCHAR) AS ip, event_id
      FROM events""",
    "devices": """
      SELECT p_partkey AS device_id, p_brand AS browser_type,
             CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_type END AS os_type,
             CAST(p_size AS VARCHAR) AS device_type
      FROM part WHERE p_type <> 'PROMO'""",
    "geo": """
      SELECT CAST(n.n_nationkey AS BIGINT) AS ip_key, n.n_name AS country, r.r_name AS state,
             n.n_name AS city
      FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "networks": """
      SELECT s.s_suppkey * 2246822519 % 3758096384 AS network,
             CASE s.s_suppkey % 5 WHEN 0 THEN 3 WHEN 1 THEN 6 WHEN 2 THEN 10 WHEN 3 THEN 14 ELSE 20 END AS prefix_len,
             n.n_name AS country, CASE WHEN s.s_suppkey % 11 <> 0 THEN r.r_name END AS state, s.s_name AS city
      FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
      JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "matches": """
      SELECT o.o_orderkey AS match_id, CAST(c.c_nationkey AS BIGINT) AS mapid,
             (o.o_orderkey % 2 = 0) AS is_team_game, o.o_orderpriority AS playlist_id,
             CAST(o.o_orderdate AS DATE) AS completion_date
      FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""",
    "match_details": """
      SELECT l_orderkey AS match_id, 'gamer_' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
             CAST(SUM(l_quantity) AS BIGINT) AS player_total_kills,
             COUNT(*) AS player_total_deaths
      FROM lineitem GROUP BY 1, 2""",
    "medals_matches_players": """
      SELECT l_orderkey AS match_id, 'gamer_' || CAST(l_suppkey AS VARCHAR) AS player_gamertag,
             l_partkey AS medal_id, CAST(1 AS BIGINT) AS count
      FROM lineitem""",
    "medals": """
      SELECT p_partkey AS medal_id,
             CASE WHEN p_type = 'PROMO' THEN 'Killing Spree' ELSE p_type END AS name
      FROM part""",
    "maps": """
      SELECT CAST(n_nationkey AS BIGINT) AS mapid, n_name AS name FROM nation""",
}


def with_standins(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the named stand-ins (append more
    CTEs with a leading comma, or a SELECT)."""
    return "WITH " + ",\n".join(f"{n} AS ({STANDINS[n]})" for n in names)
