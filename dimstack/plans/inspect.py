"""Plan inspection (H05, S21): explain text and operator counts.

Uses only the public ``DataFrame.explain``; the text is captured from
stdout.  Used by the reports (P33) and by tests that pin a plan shape
(no extra shuffle, filters pushed into the scan, broadcast chosen).
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count_exchanges(df: DataFrame) -> int:
    """Shuffle exchanges (hash / range / round-robin) in the physical plan."""
    text = plan_text(df, "simple")
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|"
                          r"SinglePartition)", text))


def has_broadcast(df: DataFrame) -> bool:
    return "BroadcastHashJoin" in plan_text(df, "simple") or \
        "BroadcastExchange" in plan_text(df, "simple")


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df, "formatted"))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df, "formatted"))


_UNITS = {"B": 1, "KiB": 1 << 10, "MiB": 1 << 20, "GiB": 1 << 30, "TiB": 1 << 40,
          "PiB": 1 << 50, "EiB": 1 << 60}


def estimated_size_bytes(df: DataFrame) -> float | None:
    """Catalyst's size estimate of the optimized plan's root (no job runs;
    for file scans it comes from file sizes and the pruned columns)."""
    text = plan_text(df, "cost")
    m = re.search(r"Statistics\(sizeInBytes=([0-9.Ee+]+) ?([KMGTPE]?i?B)", text)
    if not m:
        return None
    return float(m.group(1)) * _UNITS.get(m.group(2), 1)
