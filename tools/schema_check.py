"""Compare column types of each registered query (Spark) with its oracle
(DuckDB), by type family, at a given scale factor."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tools.oracle_check import duck  # noqa: E402

SPARK = {"bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8",
         "double": "float64", "float": "float32", "string": "str", "boolean": "bool",
         "date": "date", "timestamp_ntz": "ts", "timestamp": "tstz"}
DUCK = {"BIGINT": "int64", "INTEGER": "int32", "SMALLINT": "int16", "TINYINT": "int8",
        "HUGEINT": "int128", "DOUBLE": "float64", "FLOAT": "float32", "VARCHAR": "str",
        "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "ts", "TIMESTAMP WITH TIME ZONE": "tstz"}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from dimstack.session import get_session
    from queries import all_oracles, all_queries
    spark = get_session("schema-check")
    con = duck(sf_dir)
    bad = 0
    for k, sql in all_oracles().items():
        s = {n: SPARK.get(t, t) for n, t in all_queries()[k](spark, sf_dir).dtypes}
        rel = con.sql(sql)
        d = {n: DUCK.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
        diff = {n: (s.get(n), d.get(n)) for n in set(s) | set(d) if s.get(n) != d.get(n)}
        if diff:
            bad += 1
            print(f"{k}: {diff}", flush=True)
    print(f"{bad} queries with type differences")


if __name__ == "__main__":
    main()
