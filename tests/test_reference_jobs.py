"""Month totals, SCD2 intervals and vertices on small frames, and the runnable
catalog jobs that use them."""

import uuid

import pytest

from dimstack.jobs import run
from dimstack.operators.graph import vertices
from dimstack.operators.reduced import first_days_totals
from dimstack.operators.scd import scd2_backfill


@pytest.mark.parametrize("n, wanted", [
    (1, [("2030-05-01", 7), ("2030-06-01", 0)]),
    (3, [("2030-05-01", 7, 5, 0), ("2030-06-01", 0, 0, 0)]),
    (4, [("2030-05-01", 7, 5, 0, 9), ("2030-06-01", 0, 0, 0, 0)]),
])
def test_first_days_of_each_month(spark, n, wanted):
    """Arrays shorter than n, empty ones, NULL elements, another partition."""
    rows = [("2030-05-01", [4, None, 0, 9], "p"), ("2030-05-01", [3, 5], "p"), ("2030-06-01", [], "p"),
            ("2030-06-01", [None], "p"), ("2030-06-01", [100, 100], "q")]
    src = spark.createDataFrame(rows, "month_start string, hit_array array<bigint>, date_partition string")
    out = first_days_totals(src, date_partition="p", n=n)
    assert out.columns[1] == "num_hits_first_day" and len(out.columns) == n + 1
    assert sorted(tuple(r) for r in out.collect()) == wanted


SEASONS = [("Ada", 2010, "Star"), ("Ada", 2011, "Star"), ("Ada", 2013, "Star"), ("Ada", 2014, None), ("Ada", 2015, None),
           ("Ada", 2016, "Star"), ("Ben", 2012, "Bad")]
INTERVALS = [("Ada", "Star", 2010, 2013), ("Ada", None, 2014, 2015), ("Ada", "Star", 2016, 2016), ("Ben", "Bad", 2012, 2012)]


def _seasons(spark):
    return spark.createDataFrame(SEASONS, "player_name string, current_season bigint, scoring_class string")


def test_intervals_span_gaps_and_null_classes(spark):
    out = scd2_backfill(_seasons(spark), key="player_name", attrs=["scoring_class"], period="current_season",
                        start_col="start_date", end_col="end_date")
    assert out.columns == ["player_name", "scoring_class", "start_date", "end_date"]
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, INTERVALS))


def test_one_vertex_per_id_from_three_copies(spark):
    rows = [(7, "OWL", name, "North", 1950 + i) for i, name in enumerate(("Owls", "Barn Owls", "Snow Owls"))]
    src = spark.createDataFrame([*rows, (8, None, "Elks", None, None)],
                                "id int, abbreviation string, nickname string, city string, founded int")
    out = vertices(src, id_col="id", vertex_type="club", prop_cols=["abbreviation", "nickname", "city", "founded"],
                   order_cols=["founded"], descending=True)
    got = {r["identifier"]: (r["type"], r["properties"]) for r in out.collect()}
    assert got[7] == ("club", {"abbreviation": "OWL", "nickname": "Snow Owls", "city": "North", "founded": "1952"})
    assert got[8][1]["nickname"] == "Elks" and got[8][1].get("city") is None


def test_job_reads_and_writes_catalog_tables(spark):
    tag = uuid.uuid4().hex[:8]
    src, dst = f"seasons_{tag}", f"intervals_{tag}"
    _seasons(spark).write.saveAsTable(src)
    spark.sql(f"CREATE TABLE {dst} (player_name STRING, scoring_class STRING, start_date BIGINT, "
              "end_date BIGINT) USING parquet")
    try:
        run(spark, "player_scd", src, dst)
        assert sorted(map(str, (tuple(r) for r in spark.table(dst).collect()))) == sorted(map(str, INTERVALS))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {src}")
        spark.sql(f"DROP TABLE IF EXISTS {dst}")
