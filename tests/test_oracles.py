"""Every registered query against its DuckDB oracle (the driver's check),
at sf0.001 by default; ORACLE_SF_DIR=/root/testdata/sf0.01 for the full run."""

import os

import pytest

from queries import all_oracles, all_queries
import tools.oracle_check as oc
from tools.oracle_check import compare, duck

oc.STRICT = True          # exact values: the driver hashes them

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
KEYS = sorted(all_oracles())


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("key", KEYS)
def test_oracle(spark, con, key):
    ok, msg, _ = compare(spark, con, key, all_queries()[key], all_oracles()[key], SF_DIR)
    assert ok, msg


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert df.columns == ["player_id", "scoring_class", "start_period", "end_period"]
