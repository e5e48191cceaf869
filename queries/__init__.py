"""Registered queries (one per SURVEY §2 job) and their DuckDB oracles."""

from __future__ import annotations

import importlib

_FAMILIES = ["dimensional", "facts", "analytics", "spark_jobs", "streams", "experiments", "lookups", "tables"]


def all_queries() -> dict:
    out = {}
    for fam in _FAMILIES:
        out.update(importlib.import_module(f"queries.{fam}").QUERIES)
    return out


def all_oracles() -> dict:
    from .common import round_sql
    out = {}
    for fam in _FAMILIES:
        out.update(importlib.import_module(f"queries.oracle_{fam}").ORACLES)
    return {k: round_sql(v) for k, v in out.items()}
