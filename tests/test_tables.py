"""Z-order and file skipping, upserts of touched files, tables by year, and match
statistics from one read of each table."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from dimstack.operators import matches as mt
from dimstack.plans import clustering as cl
from dimstack.plans.inspect import plan_text
from dimstack.plans.layout import written_layouts
from dimstack.session import checkpoint_path
from dimstack.sources import filetable as ft
from dimstack.sources import standins as si
from dimstack.sources.years import read_between, write_by_year

SF = "/root/testdata/sf0.01"


def folder(spark, name):
    return checkpoint_path(spark, "tests", f"{name}-{uuid.uuid4().hex}")


def test_two_column_filter_touches_fewer_files(spark):
    df = spark.range(20_000).select("id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("x"),
                                    F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("y"),
                                    F.when(F.col("id") % 100 > 0, F.concat(F.lit("n"), F.col("id") % 7)).alias("name"))
    paths = written_layouts(spark, df, partition_col="x", sorts={"plain": []}, global_sorts={"by_x": ["x"]},
                            z_orders={"z": ["x", "y"]}, partitions=32)
    where = {"x": (100, 300), "y": (700, 800)}
    sizes = {r.variant: r for r in cl.layout_sizes(spark, paths, ["x", "y"], where).collect()}
    assert sizes["z"].n_files >= 16 and sizes["z"].total_bytes > 0
    assert sizes["z"].files_touched <= sizes["z"].n_files / 4
    assert sizes["z"].files_touched / sizes["z"].n_files < sizes["plain"].files_touched / sizes["plain"].n_files
    assert sizes["z"].bytes_touched < sizes["z"].total_bytes / 2
    rows = cl.read_touched(spark, paths["z"], cl.file_ranges(spark, paths["z"], ["x", "y"]), where)
    assert sorted(map(tuple, rows.collect())) == sorted(
        map(tuple, df.where("x BETWEEN 100 AND 300 AND y BETWEEN 700 AND 800").collect()))
    none = cl.read_touched(spark, paths["z"], cl.file_ranges(spark, paths["z"], ["x", "y"]), {"x": (5000, None)})
    assert none.count() == 0 and none.columns == df.columns


def test_z_order_keeps_rows_of_any_type(spark):
    df = spark.createDataFrame([(None, None, None), (1, "b", 2.5), (1, "a", float("nan")), (2, "é", -1.0)] * 5,
                               "k int, name string, v double")
    out = cl.z_order(df, ["k", "name", "v"], 3)
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    assert cl.z_order(df.limit(0), ["k"], 3).count() == 0


TABLE = "k int, v string"


def table(spark, n=100):
    path = folder(spark, "files")
    ft.create(spark, spark.createDataFrame([(i, f"old {i}") for i in range(n)] + [(None, "old null")], TABLE)
              .repartitionByRange(8, "k"), path)
    return path


def test_upsert_rewrites_only_touched_files(spark):
    path = table(spark)
    before = set(ft.files_of(spark, path))
    updates = spark.createDataFrame([(5, "new 5"), (6, "new 6"), (1000, "new key")], TABLE)
    assert ft.upsert(spark, path, updates, ["k"]) == 2
    after = set(ft.files_of(spark, path))
    assert len(before) >= 6 and len(before - after) == 1
    got = {r.k: r.v for r in ft.read(spark, path).collect()}
    assert got == {**{i: f"old {i}" for i in range(100)}, None: "old null", 5: "new 5", 6: "new 6", 1000: "new key"}
    assert {r.k: r.v for r in ft.read(spark, path, 1).collect()}[5] == "old 5"


def test_stop_between_write_and_commit(spark):
    path = table(spark)
    updates = spark.createDataFrame([(None, "new null"), (3, "new 3")], TABLE)
    files, base = ft.prepare_upsert(spark, path, updates, ["k"])
    assert ft.version(spark, path) == base == 1
    assert {r.v for r in ft.read(spark, path).collect()}.isdisjoint({"new 3", "new null"})
    ft.upsert(spark, path, updates, ["k"])
    got = [r for r in ft.read(spark, path).collect() if r.k in (None, 3)]
    assert sorted(r.v for r in got) == ["new 3", "new null"] and ft.read(spark, path).count() == 101
    # the stopped writer comes back: its version is taken
    with pytest.raises(RuntimeError):
        ft.commit(spark, path, files, base)
    assert ft.version(spark, path) == 2


def test_upsert_refuses_bad_updates(spark):
    path = table(spark, 3)
    with pytest.raises(ValueError):
        ft.upsert(spark, path, spark.createDataFrame([(1, "a"), (1, "b")], TABLE), ["k"])
    with pytest.raises(ValueError):
        ft.upsert(spark, path, spark.createDataFrame([(1, 2)], "k int, w int"), ["k"])
    with pytest.raises(ValueError):
        ft.read(spark, folder(spark, "nothing"))


def test_date_filter_prunes_years(spark):
    path = folder(spark, "years")
    df = spark.range(2000).select("id", F.date_add(F.lit("2019-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    df = df.unionByName(spark.createDataFrame([(-1, None)], "id long, d date"))
    write_by_year(df, path, "d", files_per_year=2)
    got = read_between(spark, path, "d", "2020-12-30", "2021-01-02")
    plan = plan_text(got)
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "d_year" in filters.split("PartitionFilters")[1].split("]")[0]
    assert sorted(r.d.isoformat() for r in got.collect()) == ["2020-12-30", "2020-12-31", "2021-01-01", "2021-01-02"]
    assert read_between(spark, path, "d").count() == 2001 and got.columns == ["id", "d"]


def test_match_stats_reads_each_table_once(spark):
    stats = mt.match_stats(si.matches(spark, SF), si.match_details(spark, SF), si.medals_matches_players(spark, SF),
                           si.medals(spark, SF), si.maps(spark, SF))
    scans = [line for line in plan_text(stats).splitlines() if "Location" in line or "FileScan" in line]
    # lineitem stands in for details and medals; orders and customer for matches
    for name, times in (("orders", 1), ("lineitem", 2), ("part", 1)):
        assert sum(f"/{name}.parquet" in line for line in scans) == times, name


def test_wanted_medals_reach_the_scan_as_a_bloom_filter(spark):
    n = spark.range(20_000)
    frames = {
        "medals": spark.range(500).select(F.col("id").alias("medal_id"), F.when(F.col("id") % 50 == 0, "Killing Spree")
                                          .otherwise("other").alias("name")),
        "mmp": n.select((F.col("id") % 1000).alias("match_id"), (F.col("id") % 500).alias("medal_id"), F.lit(1).alias("count"))}
    for name, df in frames.items():
        df.write.parquet(folder_ := folder(spark, name))
        frames[name] = spark.read.parquet(folder_)
    matches = spark.range(1000).select(F.col("id").alias("match_id"), (F.col("id") % 3).alias("mapid"), F.lit("p").alias("playlist_id"))
    maps = spark.range(3).select(F.col("id").alias("mapid"), F.concat(F.lit("m"), "id").alias("name"))
    details = matches.select("match_id", F.lit("g").alias("player_gamertag"), F.lit(2).alias("player_total_kills"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        stats = mt.match_stats(matches, details, frames["mmp"], frames["medals"], maps, max_broadcast_rows=0)
        assert "might_contain" in plan_text(stats)
        got = {(r.metric, r.key): r.value for r in stats.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(v for (metric, _), v in got.items() if metric == "killing_spree_medals") == 20_000 / 50


def test_match_stats_with_unknown_maps_and_repeated_matches(spark):
    matches = spark.createDataFrame([(1, 10, "a"), (1, 10, "a"), (2, 99, "a"), (3, None, None)],
                                    "match_id int, mapid int, playlist_id string")
    details = spark.createDataFrame([(1, "p", 4), (7, "p", 8)], "match_id int, player_gamertag string, player_total_kills int")
    mmp = spark.createDataFrame([(1, 5, 2), (2, 5, 3), (9, 5, 1), (1, 6, 9)], "match_id int, medal_id int, count int")
    medals = spark.createDataFrame([(5, "Killing Spree"), (6, "other")], "medal_id int, name string")
    maps = spark.createDataFrame([(10, "ten")], "mapid int, name string")
    got = {(r.metric, r.key): r.value for r in mt.match_stats(matches, details, mmp, medals, maps).collect()}
    assert got == {("avg_kills_per_game", "p"): 6.0, ("playlist_plays", "a"): 2.0, ("playlist_plays", None): 1.0,
                   ("map_plays", "ten"): 1.0, ("killing_spree_medals", "ten"): 2.0}
