"""Join helpers.

Broadcast policy: a side is broadcast only after its size is checked, in two
stages.  First Catalyst's size estimate (file sizes of the pruned scan, no
job): above ``max_bytes`` the side is not broadcast and nothing runs.  Only a
side already estimated small is then counted with ``limit(max_rows + 1)``,
which reads at most that many rows.  Otherwise the plain DataFrame is
returned and the join runs as a shuffle (sort-merge) join, which AQE may
still turn into a broadcast once it has measured the shuffle output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if it is estimated under ``max_bytes`` and has at
    most ``max_rows`` rows, else ``df`` unchanged."""
    from ..plans.inspect import estimated_size_bytes
    est = estimated_size_bytes(df)
    if est is not None and est > max_bytes:
        return df
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def full_outer_on_key(prev: DataFrame, today: DataFrame, key: str | list[str]) -> DataFrame:
    """``prev`` ⟗ ``today`` on ``key`` with both sides aliased ``y`` / ``t``.

    Null keys are dropped first: they never match and would all land in one
    shuffle partition (AQE skew handling does not split full outer joins).
    """
    keys = [key] if isinstance(key, str) else list(key)
    cond = None
    for k in keys:
        c = F.col(f"y.{k}") == F.col(f"t.{k}")
        cond = c if cond is None else cond & c
    y = prev.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).alias("y")
    t = today.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).alias("t")
    return y.join(t, cond, "full_outer")
