"""Match statistics and event enrichment jobs.

Each statistic joins only what it needs and aggregates before joining the
next table, so rows never multiply (the reference's one wide join of details,
matches and medals repeats every medal row per player line).  Dimension
sides (medals, maps, devices) are broadcast only behind a bounded size check.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import bounded_broadcast

KILLING_SPREE = "Killing Spree"     # fixed value: medal name


def match_stats(matches: DataFrame, details: DataFrame, medals_mp: DataFrame,
                medals: DataFrame, maps: DataFrame, *, medal_name: str = KILLING_SPREE,
                max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """P32 (J17): (metric, key, value) for every key of four statistics:
    average kills per game by player, plays by playlist, plays by map,
    ``medal_name`` medals by map.

    Every table is read once: medals are summed per match, meet the matches once,
    and one grouping-sets pass over the result gives playlists and maps.  Tables
    bucketed by match_id (``plans.layout.match_join``) meet without a shuffle, and
    the wanted medals reach the scan of the large medal table as a broadcast or,
    beyond that, a runtime Bloom filter.  The players' averages need no match, so
    details do not take part in the join."""
    maps_b = bounded_broadcast(maps.select("mapid", F.col("name").alias("map_name")),
                               max_broadcast_rows)
    spree_ids = bounded_broadcast(
        medals.where(F.col("name") == medal_name).select("medal_id"), max_broadcast_rows)
    per_match = (medals_mp.join(spree_ids, "medal_id")
                 .groupBy("match_id").agg(F.sum("count").alias("medals")))
    one = matches.dropDuplicates(["match_id"]).select("match_id", "playlist_id", "mapid")
    wide = one.join(per_match, "match_id", "left").join(maps_b, "mapid", "left")
    by = (wide.groupingSets([["playlist_id"], ["mapid", "map_name"]], "playlist_id", "mapid", "map_name")
          .agg(F.count(F.lit(1)).alias("plays"), F.sum("medals").alias("medals"),
               F.grouping("playlist_id").alias("_by_map")))
    by = by.select(F.inline(F.array(
        F.struct(F.when(F.col("_by_map") == 1, "map_plays").otherwise("playlist_plays").alias("metric"),
                 F.when(F.col("_by_map") == 1, F.col("map_name")).otherwise(F.col("playlist_id")).alias("key"),
                 F.col("plays").cast("double").alias("value"), (F.col("_by_map") == 1).alias("_map")),
        F.struct(F.lit("killing_spree_medals").alias("metric"), F.col("map_name").alias("key"),
                 F.when(F.col("_by_map") == 1, F.col("medals")).cast("double").alias("value"),
                 (F.col("_by_map") == 1).alias("_map")))))
    # maps without a name are no key, and no medal is no row
    by = by.where("NOT (_map AND key IS NULL) AND NOT (metric = 'killing_spree_medals' AND value IS NULL)").drop("_map")
    kills = details.groupBy("player_gamertag").agg(F.avg("player_total_kills").alias("value")).select(
        F.lit("avg_kills_per_game").alias("metric"), F.col("player_gamertag").alias("key"),
        F.col("value").cast("double").alias("value"))
    return kills.unionByName(by)


def require_columns(df: DataFrame, required: dict[str, T.DataType]) -> DataFrame:
    """Fail fast when a required column is missing or has another type (the
    typed-Dataset contract of the reference, checked on the schema)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"{c}: missing" for c in required if c not in fields]
    problems += [f"{c}: {fields[c].simpleString()} != {t.simpleString()}"
                 for c, t in required.items() if c in fields and fields[c] != t]
    if problems:
        raise ValueError("schema check failed: " + "; ".join(problems))
    return df


EVENT_REQUIRED = {"user_id": T.LongType(), "device_id": T.LongType()}
DEVICE_REQUIRED = {"device_id": T.LongType(), "browser_type": T.StringType()}
MISSING_REFERRER = "unknow"         # fixed value: the reference's default text


def typed_enrichment(events: DataFrame, devices: DataFrame, *,
                     missing_referrer: str = MISSING_REFERRER) -> DataFrame:
    """Required columns enforced, events with user and device only,
    inner join with devices, default for a missing referrer, upper-case
    browser."""
    e = require_columns(events, EVENT_REQUIRED).where(
        F.col("user_id").isNotNull() & F.col("device_id").isNotNull()).alias("e")
    d = require_columns(devices, DEVICE_REQUIRED).alias("d")
    return e.join(d, F.col("e.device_id") == F.col("d.device_id"), "inner").select(
        F.col("e.user_id"), F.col("d.device_id"), F.upper(F.col("d.browser_type")).alias("browser_type"),
        F.col("d.os_type"), F.col("d.device_type"),
        F.coalesce(F.col("e.referrer"), F.lit(missing_referrer)).alias("referrer"),
        F.col("e.host"), F.col("e.url"), F.col("e.event_time"))


def typed_enrichment_sql(spark, events: DataFrame, devices: DataFrame, *,
                         missing_referrer: str = MISSING_REFERRER) -> DataFrame:
    """The same join written as SQL over parameterised relations (S05
    without a global temp view); Catalyst produces the same plan."""
    require_columns(events, EVENT_REQUIRED)
    require_columns(devices, DEVICE_REQUIRED)
    return spark.sql("""
        SELECT e.user_id, d.device_id, upper(d.browser_type) AS browser_type, d.os_type,
               d.device_type, coalesce(e.referrer, :missing) AS referrer, e.host, e.url,
               e.event_time
        FROM {events} e JOIN {devices} d ON e.device_id = d.device_id
        WHERE e.user_id IS NOT NULL AND e.device_id IS NOT NULL""",
                     args={"missing": missing_referrer}, events=events, devices=devices)


def events_aggregated(events: DataFrame) -> DataFrame:
    """(user, device) → event count and number of distinct hosts (the shared
    aggregate; the reference's host array is kept as a count, since a bot
    user-device pair may touch unboundedly many hosts)."""
    return (events.where(F.col("user_id").isNotNull())
            .groupBy("user_id", "device_id")
            .agg(F.count(F.lit(1)).alias("event_counts"),
                 F.count_distinct("host").alias("n_hosts")))


def shared_aggregate(events: DataFrame, devices: DataFrame, *, persist: bool = True,
                     level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """One aggregate feeding two joins.  Returns ``(users_and_devices,
    devices_on_events, aggregate)``; with ``persist`` the aggregate is cached
    and the caller unpersists it after both outputs are written.

    The reference collects each user's devices and each device's users into
    arrays; a shared device id may hold a third of all users, so those lists
    stay in long form (the aggregate: one row per user and device) and the
    two outputs carry counts.  An event without a device counts as an event,
    not as a device."""
    agg = events_aggregated(events)
    if persist:
        agg = agg.persist(level)
    users_and_devices = (agg.groupBy("user_id")
                         .agg(F.max("event_counts").alias("total_hits"),
                              F.count("device_id").alias("n_devices"),
                              F.sum("event_counts").alias("n_events")))
    devices_on_events = (devices.select("device_id", "device_type").join(agg, "device_id")
                         .groupBy("device_id", "device_type")
                         .agg(F.count(F.lit(1)).alias("n_users"),
                              F.sum("event_counts").alias("n_events")))
    return users_and_devices, devices_on_events, agg


def event_device_left(events: DataFrame, devices: DataFrame,
                      renames: dict[str, str] | None = None) -> DataFrame:
    """Every event with its device's attributes (NULL when unknown),
    device columns renamed."""
    renames = renames or {"browser_type": "browser_family", "os_type": "os_family"}
    df = (events.withColumn("event_date", F.to_date("event_time"))
          .join(devices, on="device_id", how="left"))
    return df.withColumnsRenamed(renames)

