"""Location of an address by its longest matching network.

Networks are (prefix length, prefix).  An address has one candidate prefix for
each length that occurs, so the lookup is an equi-join and the longest match
wins; no range join is needed.  Only distinct addresses are looked up, so a hot
address costs one row until the events take the result over.

There are at most 2 ** n prefixes of n bits: the short lengths, whose prefixes
half of all addresses may share, are few enough to broadcast, and a long prefix
covers few addresses, so the shuffle join of those has no hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 32
#: Prefixes of at most so many bits are broadcast: under 2 ** 13 rows together.
SHORT = 12


def ipv4_number(text: Column) -> Column:
    """``a.b.c.d`` as a BIGINT; NULL for anything else."""
    parts = F.split(text, r"\.", -1)
    octets = F.transform(parts, lambda p: F.when(p.rlike("^[0-9]{1,3}$"), p.cast("bigint")))
    good = (F.size(parts) == 4) & F.forall(octets, lambda o: F.coalesce(o <= 255, F.lit(False)))
    return F.when(good, F.aggregate(octets, F.lit(0).cast("bigint"), lambda acc, o: acc * 256 + o))


def _prefix(number: Column, length: Column) -> Column:
    return F.call_function("shiftright", number, (F.lit(BITS) - length).cast("int"))


def longest_match(addresses: DataFrame, networks: DataFrame, values: Sequence[str]) -> DataFrame:
    """``(address, prefix_len, *values)`` of the longest network that holds each
    of the ``addresses`` (one BIGINT column, distinct); unknown ones are absent.

    ``networks(network, prefix_len, *values)``: network is any address of it.  Of
    equal networks the smallest values count, so the result does not depend on
    row order.  NULL networks and lengths outside 0..32 hold nothing.
    """
    nets = (networks.where(F.col("network").isNotNull() & F.col("prefix_len").between(0, BITS))
            .select(F.col("prefix_len").cast("int").alias("prefix_len"),
                    _prefix(F.col("network"), F.col("prefix_len")).alias("prefix"), *values)
            .groupBy("prefix_len", "prefix").agg(F.min(F.struct(*values)).alias("v")))
    # at most 33 lengths
    lengths = sorted(r.prefix_len for r in nets.select("prefix_len").distinct().collect())
    found = None
    for some, short in (([n for n in lengths if n <= SHORT], True), ([n for n in lengths if n > SHORT], False)):
        if not some:
            continue
        side = nets.where(F.col("prefix_len").isin(some))
        candidates = addresses.select(
            F.col(addresses.columns[0]).alias("address"),
            F.explode(F.array(*[F.lit(n) for n in some])).alias("prefix_len")).withColumn(
            "prefix", _prefix(F.col("address"), F.col("prefix_len")))
        hit = candidates.join(F.broadcast(side) if short else side, ["prefix_len", "prefix"])
        hit = hit.select("address", "prefix_len", "v")
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        return addresses.limit(0).select(F.col(addresses.columns[0]).alias("address"), F.lit(0).alias("prefix_len"),
                                         *[F.lit(None).cast(networks.schema[c].dataType).alias(c) for c in values])
    best = F.max_by("v", "prefix_len")
    return found.groupBy("address").agg(F.max("prefix_len").alias("prefix_len"), best.alias("v")).select(
        "address", "prefix_len", "v.*")


def locate(events: DataFrame, networks: DataFrame, ip_col: str = "ip",
           values: Sequence[str] = ("country", "state", "city")) -> DataFrame:
    """All rows of ``events`` with ``geodata``: the JSON text of the longest
    matching network's values (empty text for missing ones), ``{}`` for an
    address that no network holds, or that is none.  Batch, or a micro-batch."""
    numbered = events.withColumn("__address", ipv4_number(F.col(ip_col)))
    seen = numbered.select("__address").where("__address IS NOT NULL").distinct()
    places = longest_match(seen, networks, values).select(
        F.col("address").alias("__address"),
        F.to_json(F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in values])).alias("geodata"))
    return numbered.join(places, "__address", "left").select(
        *events.columns, F.coalesce("geodata", F.lit("{}")).alias("geodata"))
