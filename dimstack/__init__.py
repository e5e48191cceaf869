"""dimstack: data-modelling and analytics jobs as lazy Spark DataFrame functions.

Modules
-------
operators.cumulative   cumulative snapshots: step, backfill, history queries (P01-P04)
operators.scd          SCD type 2 backfill and incremental merge (P05-P07)
operators.graph        vertices, player-game edges, partner totals (P08-P10)
operators.datelist     date lists, bit-packed activity, per-device maps (P11-P17)
operators.reduced      monthly metric arrays, upserts, daily rows (P18-P22)
operators.growth       growth accounting, season states, retention (P23-P25)
operators.patterns     funnel, grouping sets, rolling windows, running index,
                       streaks, batch sessions (P26-P31, P42)
operators.matches      match statistics, typed/shared/left enrichment (P32, P35-P37)
operators.experiments  assignment and readout (P43-P44)
operators.quality      grain checks and deduplication (P45-P47)
operators.joins        size-checked broadcast, null-safe full outer join
streaming.jobs         parse, geo enrichment, tumbling/session windows, sinks (P38-P42)
plans                  explain inspection, layout/bucket reports, day loop, materialize
sources                driver tables, stand-ins, readers/writers/DDL
functions              Column builders and SQL-bodied functions
jobs                   runnable catalog-table jobs
"""

__version__ = "0.1.0"
