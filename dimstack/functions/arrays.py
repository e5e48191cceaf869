"""Array helpers (N01-N17) as higher-order Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def empty_array(element_type: str) -> Column:
    """ARRAY[]::type[]."""
    return F.array().cast(f"array<{element_type}>")


def append_if(arr: Column, cond: Column, value: Column, element_type: str) -> Column:
    """COALESCE(arr, []) || CASE WHEN cond THEN [value] ELSE [] END."""
    base = F.coalesce(arr, empty_array(element_type))
    return F.when(cond, F.concat(base, F.array(value))).otherwise(base)


def last_element(arr: Column) -> Column:
    """arr[CARDINALITY(arr)] without raising on an empty array."""
    return F.try_element_at(arr, F.lit(-1))


def first_element(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(1))


def safe_get(arr: Column, i: int, default=0) -> Column:
    """0-based get with a default for short arrays and NULL elements."""
    return F.coalesce(F.get(arr, i), F.lit(default))


def bits_from_offsets(offsets: Column, width: int = 32) -> Column:
    """Fold day offsets into an integer: offset 0 → most significant of
    ``width`` bits (shiftleft(1, width-1-offset)); offsets outside
    [0, width) are ignored.  No join, no shuffle (A19)."""
    return F.aggregate(
        offsets, F.lit(0).cast("bigint"),
        lambda acc, d: F.when((d >= 0) & (d < width),
                              acc.bitwiseOR(pow2(F.lit(width - 1) - d)))
        .otherwise(acc))


def pow2(n: Column) -> Column:
    """2^n as BIGINT for a column n in 0..62 (exact in double)."""
    return F.pow(F.lit(2.0), n).cast("bigint")


def dates_csv(arr: Column) -> Column:
    """array<date> → 'yyyy-MM-dd,...' (order kept) for comparison output."""
    return F.array_join(F.transform(arr, lambda d: F.date_format(d, "yyyy-MM-dd")), ",")


def any_list_contains(map_col: Column, value: Column) -> Column:
    """Does any array value of a map<k, array<v>> contain ``value``."""
    return F.exists(F.map_values(map_col), lambda arr: F.array_contains(arr, value))
