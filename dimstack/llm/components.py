"""Connected components of an edge table by alternating large-star and
small-star steps, each a grouped minimum and a join, written between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over ``edges(u, v)``, both directions present.

    large: every neighbour greater than u is linked to the smallest node
    around u.  small: u and its smaller neighbours are linked to it.
    The minima are written first, so that the join reads two plain tables and
    the adaptive skew join can split a hub's rows.
    """
    seen = edges if large else edges.filter("v < u")
    low = materialize(seen.groupBy("u").agg(F.min("v").alias("m"))
                      .select("u", F.least("u", "m").alias("m")), "cc-min")
    joined = seen.join(low.hint("merge"), "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(low.select("u", F.col("m").alias("v"))))
    return out.filter("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(u, v)`` of an orderable type -> ``(node, root)`` for each node
    with an edge; root is the smallest node of its component.

    Self loops, repeated and mirrored edges are fine; an empty table gives an
    empty result.  Stops when a round changes nothing (checked by count and an
    order-free checksum of the edges).
    """
    now = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .filter("u <> v").distinct(), "cc")
    mark = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        after_large = materialize(_star(both, large=True), "cc")
        now = materialize(_star(after_large, large=False), "cc")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = new
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
