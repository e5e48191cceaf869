"""Stand-in tables derived from the driver's TPC-H-like parquet.

The reference's own tables (player seasons, films, game details, web events,
devices ...) ship no data.  Each stand-in is a lazy DataFrame over the driver
tables, so every job's work grows with the scale factor.  Aggregations run
*before* joins where the grain allows it (orders are reduced to one row per
customer-year before meeting the customer dimension).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from .tables import read_table

# fixed values of the web-event stand-in (hosts and referrers chosen so every
# channel branch of the referrer mapping and a NULL referrer occur)
HOSTS = ("www.home.example", "home.example", "lab.partner.example")
REFERRERS = (
    "https://www.linkedin.com/feed/",
    "https://t.co/x1",
    "https://www.google.com/",
    "https://lnkd.in/abc",
    "https://www.home.example/blog",
    "https://blog.second-home.example/about",
    "https://news.ycombinator.com/",
    None,
)
NETWORK_LENGTHS = (3, 6, 10, 14, 20)
GEO_KEYS = 30          # users map onto 30 ip-prefix keys; 25..29 are unknown


def _money(col: str):
    return F.col(col).cast("decimal(18,2)")


def entity_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """player_seasons stand-in: one row per (customer, order year)."""
    o = read_table(spark, sf_dir, "orders")
    per_year = (o.groupBy(F.col("o_custkey").alias("player_id"),
                          F.year("o_orderdate").alias("season"))
                 .agg(F.count(F.lit(1)).alias("gp"),
                      F.sum(_money("o_totalprice")).alias("_sum"),
                      F.min(_money("o_totalprice")).alias("_min"),
                      F.max(_money("o_totalprice")).alias("_max")))
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("player_id"), F.col("c_name").alias("player_name"),
        F.col("c_nationkey").cast("string").alias("country"))
    return (per_year.join(c, "player_id")
            .select("player_id", "player_name", "country", "season", "gp",
                    (F.col("_sum").cast("double") / (F.col("gp") * 15000.0)).alias("pts"),
                    (F.col("_min").cast("double") / 15000.0).alias("reb"),
                    (F.col("_max").cast("double") / 15000.0).alias("ast")))


def entity_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """actor_films stand-in: every order is a film of its customer."""
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("actorid"), F.col("o_orderkey").alias("filmid"),
        F.year("o_orderdate").alias("year"),
        (F.col("o_orderkey") % 1000).alias("votes"),
        (F.col("o_totalprice") / 50000.0).alias("rating"))
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("actorid"), F.col("c_name").alias("actor"))
    return (o.join(c, "actorid")
            .select("actor", "actorid",
                    F.concat(F.lit("film_"), F.col("filmid").cast("string")).alias("film"),
                    "year", "votes", "rating", "filmid"))


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """game_details stand-in: a line item is a player's line in a game."""
    l = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("player_id"),
        F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias("part_key"),
        F.col("l_returnflag").alias("start_position"), F.col("l_quantity").alias("pts"))
    s = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("player_id"), F.col("s_name").alias("player_name"),
        F.col("s_nationkey").alias("team_id"))
    n = bounded_broadcast(read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team_abbreviation")))
    return l.join(s, "player_id").join(n, "team_id").select(
        "game_id", "team_id", "team_abbreviation", "player_id", "player_name",
        "start_position", "pts", "line_no", "part_key")


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """games stand-in: an order is a game hosted by its customer's nation."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return o.join(c, "o_custkey").select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date_est"),
        F.year("o_orderdate").alias("season"),
        F.col("c_nationkey").cast("bigint").alias("home_team_id"),
        ((F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % 25).cast("bigint")
        .alias("visitor_team_id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("home_team_wins"))


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """teams stand-in (with duplicate team ids: one row per supplier)."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = bounded_broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_nationkey").cast("bigint").alias("team_id"),
        F.substring("n_name", 1, 3).alias("abbreviation"),
        F.col("s_name").alias("nickname"),
        F.col("n_name").alias("city"),
        F.col("s_suppkey").cast("string").alias("arena"),
        (F.lit(1900) + F.col("s_suppkey") % 100).cast("bigint").alias("yearfounded"))


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events stand-in (url, referrer, user_id, device_id, host, event_time, ip)."""
    return web_events_from(read_table(spark, sf_dir, "events"))


def web_events_from(e: DataFrame) -> DataFrame:
    """The web-event projection of a batch or streaming ``events`` frame."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    host = F.element_at(F.array(*[F.lit(h) for h in HOSTS]), (k % 3 + 1).cast("int"))
    ref = F.element_at(F.array(*[F.lit(r).cast("string") for r in REFERRERS]),
                       (F.col("event_id") % len(REFERRERS) + 1).cast("int"))
    return e.select(
        F.concat(F.lit("/"), F.col("event_type")).alias("url"),
        ref.alias("referrer"),
        F.col("user_id"),
        k.alias("device_id"),
        host.alias("host"),
        F.col("ts").alias("event_time"),
        F.col("user_id").cast("string").alias("ip"),
        F.col("event_id"))


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """devices stand-in: parts are devices; PROMO parts are missing (unknown
    devices), SMALL parts have no os_type."""
    p = read_table(spark, sf_dir, "part")
    return p.where(F.col("p_type") != "PROMO").select(
        F.col("p_partkey").alias("device_id"),
        F.col("p_brand").alias("browser_type"),
        F.when(F.col("p_type") == "SMALL", F.lit(None).cast("string"))
         .otherwise(F.col("p_type")).alias("os_type"),
        F.col("p_size").cast("string").alias("device_type"))


def ip_text(user_id):
    """An address for a user: a fixed multiplier spreads them over all of IPv4."""
    n = user_id * 2654435761 % (1 << 32)
    return F.concat_ws(".", *[(F.shiftright(n, k) % 256).cast("string") for k in (24, 16, 8, 0)])


def networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Networks of five nested lengths, one per supplier, with its nation's
    names; none in the top eighth of the addresses, which stay unknown."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    length = F.element_at(F.array(*[F.lit(n) for n in NETWORK_LENGTHS]), (F.col("s_suppkey") % 5 + 1).cast("int"))
    place = F.col("s_suppkey") * 2246822519 % (7 << 29)
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(place.alias("network"), length.alias("prefix_len"), F.col("n_name").alias("country"),
                    F.when(F.col("s_suppkey") % 11 != 0, F.col("r_name")).alias("state"), F.col("s_name").alias("city")))


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ip-prefix → location lookup built from nation and region."""
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("ip_key"),
        F.col("n_name").alias("country"), F.col("r_name").alias("state"),
        F.col("n_name").alias("city"))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return o.join(c, "o_custkey").select(
        F.col("o_orderkey").alias("match_id"),
        F.col("c_nationkey").cast("bigint").alias("mapid"),
        (F.col("o_orderkey") % 2 == 0).alias("is_team_game"),
        F.col("o_orderpriority").alias("playlist_id"),
        F.to_date("o_orderdate").alias("completion_date"))


def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read_table(spark, sf_dir, "lineitem")
    return l.groupBy(F.col("l_orderkey").alias("match_id"),
                     F.concat(F.lit("gamer_"), F.col("l_suppkey").cast("string"))
                     .alias("player_gamertag")).agg(
        F.sum("l_quantity").cast("bigint").alias("player_total_kills"),
        F.count(F.lit(1)).alias("player_total_deaths"))


def medals_matches_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read_table(spark, sf_dir, "lineitem")
    return l.select(F.col("l_orderkey").alias("match_id"),
                    F.concat(F.lit("gamer_"), F.col("l_suppkey").cast("string"))
                    .alias("player_gamertag"),
                    F.col("l_partkey").alias("medal_id"),
                    F.lit(1).cast("bigint").alias("count"))


def medals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("medal_id"),
                    F.when(F.col("p_type") == "PROMO", F.lit("Killing Spree"))
                     .otherwise(F.col("p_type")).alias("name"))


def maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("bigint").alias("mapid"),
                    F.col("n_name").alias("name"))
