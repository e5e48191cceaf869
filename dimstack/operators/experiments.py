"""Experiment assignment and readout.

Assignment is a stable hash of the user id (md5 of id and salt, first 32
bits, modulo 100), so a user keeps the cell across restarts (the reference
hashes with Python's per-process salted ``hash``, Q25).  Cells are a short
parameter list turned into a CASE expression: no join, nothing broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import hash_bucket
from ..schemas import DEFAULT_PARAMS, EXPOSURE_EVENT

# (cell name, share of 100 buckets, parameters)
DEFAULT_CELLS = (
    ("control", 50, {"Button Color": "blue"}),
    ("treatment", 50, {"Button Color": "red"}),
)


def _cell_of(bucket: Column, cells) -> Column:
    expr, lo = None, 0
    for name, share, _ in cells:
        cond = (bucket >= lo) & (bucket < lo + share)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
        lo += share
    return expr


def _param(cell: Column, cells, key: str) -> Column:
    expr = None
    for name, _, params in cells:
        if key in params:
            expr = (F.when(cell == name, params[key]) if expr is None
                    else expr.when(cell == name, params[key]))
    default = F.lit(DEFAULT_PARAMS.get(key))
    return default if expr is None else expr.otherwise(default)


def assign(users: DataFrame, *, experiment: str, salt: str | None = None,
           cells=DEFAULT_CELLS, user_col: str = "user_id") -> DataFrame:
    """User → bucket 0..99 → cell; parameters from the cell with the
    defaults for users outside every cell."""
    salt = f":{experiment}" if salt is None else salt
    b = hash_bucket(F.col(user_col), salt, 100)
    out = users.select(user_col).distinct().withColumn("bucket", b)
    out = out.withColumn("cell", _cell_of(F.col("bucket"), cells))
    return out.select(user_col, F.lit(experiment).alias("experiment"), "bucket", "cell",
                      _param(F.col("cell"), cells, "Button Color").alias("button_color"),
                      _param(F.col("cell"), cells, "Paragraph Text").alias("paragraph_text"))


def with_cell(rows: DataFrame, *, experiment: str, salt: str | None = None,
              cells=DEFAULT_CELLS, user_col: str = "user_id") -> DataFrame:
    """``rows`` with ``experiment`` and ``cell``: the cell is a function of the
    user alone, so no assignment table has to be joined."""
    salt = f":{experiment}" if salt is None else salt
    return (rows.withColumn("experiment", F.lit(experiment))
            .withColumn("cell", _cell_of(hash_bucket(F.col(user_col), salt, 100), cells)))


def exposures(events: DataFrame, *, experiment: str, exposure_url: str = "/signup",
              event_name: str = EXPOSURE_EVENT, **assignment) -> DataFrame:
    """Exposure events: a visit of ``exposure_url`` by a user, with the cell."""
    e = events.where((F.col("url") == exposure_url) & F.col("user_id").isNotNull())
    return with_cell(e, experiment=experiment, **assignment).select(
        "user_id", "experiment", "cell", F.lit(event_name).alias("event_name"), "event_time")


def readout(events: DataFrame, *, experiment: str, target_url: str,
            exposure_url: str = "/signup", control: str = "control", **assignment) -> DataFrame:
    """Per cell the users, exposed users, converted users (leading
    metric: share with a ``target_url`` event), events per user (lagging
    metric), and against the control cell the difference in conversion and
    the two-proportion z statistic (pooled).

    One scan: events are summed per user, users per cell; the control cell's
    values come from a window over the few cell rows."""
    per_user = (events.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.max(F.when(F.col("url") == target_url, 1).otherwise(0)).alias("converted"),
        F.max(F.when(F.col("url") == exposure_url, 1).otherwise(0)).alias("exposed")))
    n = F.count(F.lit(1))
    cells = with_cell(per_user, experiment=experiment, **assignment).groupBy("experiment", "cell").agg(
        n.alias("n_users"), F.sum("exposed").alias("n_exposed"), F.sum("converted").alias("n_converted"),
        (F.sum("converted") / n).alias("conversion_rate"), F.avg("n_events").alias("events_per_user"))
    all_cells = Window.partitionBy("experiment")

    def of_control(col):
        return F.max(F.when(F.col("cell") == control, F.col(col))).over(all_cells)
    k = cells.select("*", of_control("n_users").alias("_n0"), of_control("n_converted").alias("_x0"),
                     of_control("conversion_rate").alias("_p0"))
    pooled = (F.col("n_converted") + F.col("_x0")) / (F.col("n_users") + F.col("_n0"))
    se = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n_users") + 1 / F.col("_n0")))
    return k.select("experiment", "cell", "n_users", "n_exposed", "n_converted",
                    "conversion_rate", "events_per_user",
                    (F.col("conversion_rate") - F.col("_p0")).alias("diff_vs_control"),
                    F.when(F.col("cell") == control, F.lit(0.0))
                    .otherwise(F.try_divide(F.col("conversion_rate") - F.col("_p0"), se))
                    .alias("z_score"))


#: P(Poisson(1) <= k) for k = 0, 1, ... as shares of 2 ** 32 (fixed values).
POISSON_CUTS = tuple(int(x * (1 << 32)) for x in (
    0.36787944117, 0.73575888234, 0.91969860293, 0.98101184312, 0.99634015317, 0.99940581518, 0.99991675888))


def poisson_weight(user: Column, replicate: Column, salt: str) -> Column:
    """How often the user is drawn in a bootstrap replicate: a Poisson(1) number
    from 32 bits of the hash of user, replicate and salt, the same on every run,
    in every task and in any engine."""
    text = F.concat(user.cast("string"), F.lit(":"), replicate.cast("string"), F.lit(f":{salt}"))
    u = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    # over an array of one: the hash is computed once for all cuts
    return F.aggregate(F.array(u), F.lit(0), lambda acc, x: acc + sum(
        (F.when(x >= c, 1).otherwise(0) for c in POISSON_CUTS), F.lit(0)))


def lagging_difference(events: DataFrame, *, experiment: str, control: str = "control", replicates: int = 40,
                       level: float = 0.95, **assignment) -> DataFrame:
    """P44, lagging metric: per cell other than ``control`` the difference of
    events per user and its bootstrap interval: ``(experiment, cell,
    diff_events_per_user, low, high)``.

    One pass: events are summed per user, then each user is weighed for every
    replicate and summed up per cell and replicate before the shuffle, so what
    is shuffled is ``replicates`` rows per task and cell.  The bounds are the
    replicates' differences at the two tails, by rank.  A cell without users in
    a replicate leaves that replicate out."""
    per_user = (events.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events")))
    rows = with_cell(per_user, experiment=experiment, **assignment).where(F.col("cell").isNotNull())
    # replicate -1 is the sample itself
    draws = rows.select("experiment", "cell", "user_id", "n_events",
                        F.explode(F.sequence(F.lit(-1), F.lit(replicates - 1))).alias("r"))
    weight = F.when(F.col("r") < 0, 1).otherwise(poisson_weight(F.col("user_id"), F.col("r"), experiment))
    means = (draws.withColumn("w", weight).groupBy("experiment", "cell", "r")
             .agg(F.try_divide(F.sum(F.col("w") * F.col("n_events")).cast("double"), F.sum("w")).alias("mean")))
    # a few rows from here on: cells times replicates
    base = F.max_by("mean", F.col("cell") == control).over(Window.partitionBy("experiment", "r"))
    found = F.max(F.col("cell") == control).over(Window.partitionBy("experiment", "r"))
    diff = means.withColumn("d", F.when(found, F.col("mean") - base)).where(F.col("cell") != control)
    out = diff.groupBy("experiment", "cell").agg(
        F.max(F.when(F.col("r") < 0, F.col("d"))).alias("diff_events_per_user"),
        F.array_sort(F.collect_list(F.when(F.col("r") >= 0, F.col("d")))).alias("diffs"))
    tail = (1 - level) / 2
    at = lambda q: F.get("diffs", F.floor(q * (F.size("diffs") - 1) + 0.5).cast("int"))
    return out.select("experiment", "cell", "diff_events_per_user", at(tail).alias("low"), at(1 - tail).alias("high"))
