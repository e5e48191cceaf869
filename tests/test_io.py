"""Readers, writers and SQL-callable functions."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimstack.functions.sql import register_sql_functions
from dimstack.operators.matches import typed_enrichment, typed_enrichment_sql
from dimstack.session import checkpoint_path
from dimstack.sources import files
from dimstack.sources import standins as si
from dimstack.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def test_csv_readers(spark):
    path = checkpoint_path(spark, "tests", uuid.uuid4().hex, "maps")
    read_table(spark, SF, "nation").select(
        F.col("n_nationkey").alias("mapid"), F.col("n_name").alias("name")) \
        .write.option("header", True).csv(path)
    strings = files.read_csv(spark, path)
    inferred = files.read_csv(spark, path, infer=True)
    typed = files.read_csv(spark, path, schema=T.StructType([
        T.StructField("mapid", T.LongType()), T.StructField("name", T.StringType())]))
    assert dict(strings.dtypes)["mapid"] == "string"
    assert dict(inferred.dtypes)["mapid"] == "int"
    assert dict(typed.dtypes)["mapid"] == "bigint" and typed.count() == 25


def test_dynamic_partition_overwrite_and_upsert(spark):
    path = checkpoint_path(spark, "tests", uuid.uuid4().hex, "t")
    day1 = spark.createDataFrame([(1, "a", "d1"), (2, "b", "d1")], "k int, v string, ds string")
    day2 = spark.createDataFrame([(1, "c", "d2")], "k int, v string, ds string")
    files.write_partitions(day1, path, ["ds"])
    files.write_partitions(day2, path, ["ds"])
    files.write_partitions(day2.withColumn("v", F.lit("c2")), path, ["ds"])   # rerun of d2
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "ds").collect())
    assert got == [(1, "a", "d1"), (1, "c2", "d2"), (2, "b", "d1")]
    files.upsert_partitions(spark, spark.createDataFrame([(2, "z", "d1")], "k int, v string, ds string"),
                            path, ["k", "ds"], ["ds"])
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "ds").collect())
    assert got == [(1, "a", "d1"), (1, "c2", "d2"), (2, "z", "d1")]
    sizes = files.file_sizes(spark, path).collect()[0]
    assert sizes["n_files"] >= 2 and sizes["total_bytes"] > 0


def test_create_table_as(spark):
    name = f"ctas_{uuid.uuid4().hex[:8]}"
    path = checkpoint_path(spark, "tests", name)
    files.create_table_as(spark, name, read_table(spark, SF, "region"), path=path)
    try:
        assert spark.table(name).count() == 5
    finally:
        files.drop_table(spark, name)


def test_sql_functions_match_column_builders(spark):
    register_sql_functions(spark)
    row = spark.sql("SELECT scoring_class_of(21.0) a, scoring_class_of(10.0) b, "
                    "quality_class_of(7.5) c, referrer_channel('https://t.co/x') d, "
                    "referrer_channel('https://x.org') e, hash_bucket_of('5', ':exp1', 100) f"
                    ).collect()[0]
    assert (row.a, row.b, row.c, row.d, row.e) == ("star", "bad", "good", "Twitter", "https://x.org")
    assert 0 <= row.f < 100


def test_sql_and_dataframe_forms_agree(spark):
    ev, dev = si.web_events(spark, SF), si.devices(spark, SF)
    a = typed_enrichment(ev, dev)
    b = typed_enrichment_sql(spark, ev, dev)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_catalog_writers(spark):
    db = f"db_{uuid.uuid4().hex[:8]}"
    files.create_database(spark, db, checkpoint_path(spark, "tests", db))
    t = f"{db}.staging"
    files.create_staging_table(spark, t, "user_id BIGINT, device_id BIGINT, event_counts BIGINT, "
                               "host_array ARRAY<STRING>")
    rows = spark.createDataFrame([(1, 2, 3, ["a"], "2024-01-01"), (4, 5, 6, ["b"], "2024-01-02")],
                                 "user_id bigint, device_id bigint, event_counts bigint, "
                                 "host_array array<string>, ds string")
    files.append_into(rows, t)
    files.insert_overwrite(rows.where("ds = '2024-01-02'").withColumn("event_counts", F.lit(9)), t)
    got = sorted((r["ds"], r["event_counts"]) for r in spark.table(t).collect())
    assert got == [("2024-01-01", 3), ("2024-01-02", 9)]      # only 2024-01-02 was replaced
    files.truncate(spark, t)
    assert spark.table(t).count() == 0
    files.drop_table(spark, t)
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_domain_check_and_size_estimate(spark):
    from dimstack.plans.inspect import estimated_size_bytes
    from dimstack.schemas import SCORING_CLASSES, check_domain
    from queries.dimensional import players_state
    state = players_state(spark, SF)
    assert check_domain(state, "scoring_class", SCORING_CLASSES).count() == 0
    small = estimated_size_bytes(read_table(spark, SF, "nation"))
    big = estimated_size_bytes(read_table(spark, SF, "lineitem"))
    assert small is not None and big is not None and small < big
