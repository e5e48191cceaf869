"""Shared parameters and output normalisation for registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# parameters of the registered queries (stand-in data ranges)
FIRST_SEASON, LAST_SEASON = 1995, 2001
STEP_SEASON = 2001                  # cumulative / SCD step: 2000 → 2001
AS_OF = "2024-01-30"                # last day of the web-event stand-in
MONTH_START = "2024-01-01"
DIGITS = 6


def round_half_up(c, digits: int = DIGITS):
    """floor(x * 10^d + 0.5) / 10^d in plain IEEE double arithmetic, so Spark
    and DuckDB round identical inputs to identical outputs (their ``round``
    functions differ on values like 16.6000995)."""
    scale = float(10 ** digits)
    return F.floor(c * scale + 0.5) / scale


def round_sql(sql: str, digits: int = DIGITS) -> str:
    """Rewrite every ``round(expr, digits)`` of oracle SQL into the same
    floor-based rounding as ``round_half_up``."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            ch = sql[k]
            depth += ch == "("
            depth -= ch == ")"
            if depth == 0:
                break
            k += 1
        inner = sql[j + len(key):k]
        expr, _, d = inner.rpartition(",")
        if d.strip() != str(digits):
            out.append(sql[i:k + 1])
        else:
            expr = round_sql(expr, digits)
            scale = f"CAST({10 ** digits} AS DOUBLE)"
            out.append(sql[i:j] + f"(floor(CAST(({expr}) AS DOUBLE) * {scale} + 0.5) / {scale})")
        i = k + 1


def finalize(df: DataFrame) -> DataFrame:
    """Comparable output: integers as BIGINT, doubles rounded, NTZ kept."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = round_half_up(c.cast("double"), DIGITS)
        cols.append(c.alias(f.name))
    return df.select(*cols)
