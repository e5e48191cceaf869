"""Registered queries: streaming jobs run over the events file as a stream
(P38-P42).  Each runs to completion (availableNow) and returns its sink.
Aggregations run in append mode: a window is emitted once, when the 15 s
watermark passes it, and its state goes.  A heartbeat far behind the last event
closes the stream, so every window of the data comes out."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dimstack.operators.locate import locate
from dimstack.schemas import EVENTS_DRIVER
from dimstack.session import checkpoint_path
from dimstack.sources import standins as si
from dimstack.streaming import jobs as sj
from dimstack.streaming.late import split_late
from dimstack.streaming.ledger import read_ledger, write_ledger

from .common import finalize

SESSION_GAP_MINUTES = 5
HEARTBEAT = "2100-01-01T00:00:00.000Z"


def _parsed(spark, sf_dir):
    raw = sj.parquet_stream(spark, sf_dir, schema=EVENTS_DRIVER, file_glob="events.parquet")
    return sj.parse_events(sj.as_messages(si.web_events_from(raw)))


def _closed(spark, sf_dir):
    """The parsed events followed by one heartbeat (no host, no ip)."""
    raw = sj.parquet_stream(spark, sf_dir, schema=EVENTS_DRIVER, file_glob="events.parquet")
    folder = _sink(spark, "heartbeat")
    spark.range(1).select(F.to_json(F.struct(F.lit(HEARTBEAT).alias("event_time"))).alias("value")) \
        .write.parquet(folder)
    beat = spark.readStream.schema("value string").parquet(folder)
    return sj.parse_events(sj.as_messages(si.web_events_from(raw)).select("value").union(beat))


def _sink(spark, name):
    return checkpoint_path(spark, "sinks", f"{name}_{uuid.uuid4().hex[:10]}")


def _parallelism(spark):
    """State-store partitions for the test streams: one per core."""
    return spark.sparkContext.defaultParallelism


def _ntz(df, *cols):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def q_stream_parse(spark, sf_dir):
    p = _parsed(spark, sf_dir).select("ip", "event_time", "referrer", "host", "url",
                                      "event_timestamp")
    return finalize(_ntz(sj.run_available(p, _sink(spark, "parse")), "event_timestamp"))


def q_stream_geo(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    e = sj.geo_enrich(p, si.geo(spark, sf_dir),
                      key_expr=F.col("ip").cast("bigint") % si.GEO_KEYS)
    e = e.select("ip", "host", "url", "geodata", "event_timestamp")
    return finalize(_ntz(sj.run_available(e, _sink(spark, "geo")), "event_timestamp"))


#: Sink folders of finished runs by (application, table folder): the two tumbling
#: queries read the two sinks of one run.
_RUNS: dict[tuple[str, str], tuple[str, str]] = {}


def _tumbling(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _RUNS:
        # the other query's result of the same run: each run feeds one pair
        return tuple(sj.read_sink(spark, p) for p in _RUNS.pop(key))
    agg = sj.tumbling_counts(_closed(spark, sf_dir), ["host", "referrer"])
    main, hosts = _sink(spark, "host_referrer"), _sink(spark, "host")
    sj.run_available(agg, main, state_partitions=_parallelism(spark),
                     extra_sinks=[(hosts, sj.host_counts_from_referrer_counts)])
    _RUNS[key] = (main, hosts)
    return sj.read_sink(spark, main), sj.read_sink(spark, hosts)


def q_stream_tumbling_host(spark, sf_dir):
    return finalize(_ntz(_tumbling(spark, sf_dir)[1], "event_hour"))


def q_stream_tumbling_host_referrer(spark, sf_dir):
    return finalize(_ntz(_tumbling(spark, sf_dir)[0], "event_hour"))


def q_stream_dedup(spark, sf_dir):
    d = sj.dedup_within_watermark(_parsed(spark, sf_dir).where(F.col("ip").isNotNull()),
                                  ["ip", "event_timestamp"])
    out = sj.run_available(d.select("ip", "event_timestamp", "url", "host"), _sink(spark, "dedup"),
                           state_partitions=_parallelism(spark))
    return finalize(_ntz(out, "event_timestamp"))


def _sessions(spark, sf_dir):
    s = sj.sessions(_closed(spark, sf_dir), ["ip", "host"], gap=f"{SESSION_GAP_MINUTES} minutes")
    return sj.run_available(s, _sink(spark, "sessions"), state_partitions=_parallelism(spark))


def q_stream_sessions(spark, sf_dir):
    return finalize(_ntz(_sessions(spark, sf_dir), "session_start", "session_end"))


def q_sessions_batch(spark, sf_dir):
    """The same sessions from a batch read, with the skew-safe numbering."""
    from dimstack.operators.patterns import sessions_batch
    ev = si.web_events(spark, sf_dir).select("ip", "host",
                                             F.col("event_time").alias("event_timestamp"))
    return finalize(sessions_batch(ev, ["ip", "host"], gap_seconds=SESSION_GAP_MINUTES * 60))


def q_session_stats(spark, sf_dir):
    return finalize(sj.session_stats(_sessions(spark, sf_dir)))


def q_stream_locate(spark, sf_dir):
    """Addresses by longest network, looked up per micro-batch."""
    p = _parsed(spark, sf_dir).withColumn("ip", si.ip_text(F.col("ip").cast("bigint")))
    nets = si.networks(spark, sf_dir)
    out = sj.run_available(p.select("ip", "host", "url", "event_timestamp"), _sink(spark, "locate"),
                           each_batch=lambda batch: locate(batch, nets))
    return finalize(_ntz(out, "event_timestamp"))


def _deliver(spark, events, folder, part):
    """Write some events as messages, as a topic would receive them later."""
    sj.as_messages(events).write.mode("overwrite").parquet(f"{folder}/part={part}")


def _source(spark, folder):
    raw = spark.readStream.schema("value string").option("recursiveFileLookup", True).parquet(folder)
    return sj.parse_events(raw)


def q_stream_sessions_recovered(spark, sf_dir):
    """Sessions of a stream that stops after the first half of the time and goes
    on from its checkpoint: those open at the stop are neither lost nor cut."""
    ev = si.web_events(spark, sf_dir)
    low, high = ev.agg(F.min("event_time"), F.max("event_time")).first()
    folder, sink = _sink(spark, "recovery_source"), _sink(spark, "recovery")
    checkpoint = checkpoint_path(spark, "streams", uuid.uuid4().hex)
    first = F.col("event_time") < F.lit(low + (high - low) / 2)
    beat = spark.range(1).select(F.to_json(F.struct(F.lit(HEARTBEAT).alias("event_time"))).alias("value"))
    for part, write in enumerate((lambda p: _deliver(spark, ev.where(first), folder, p),
                                  lambda p: _deliver(spark, ev.where(~first), folder, p),
                                  lambda p: beat.write.parquet(f"{folder}/part={p}"))):
        write(part)
        s = sj.sessions(_source(spark, folder), ["ip", "host"], gap=f"{SESSION_GAP_MINUTES} minutes")
        out = sj.run_available(s, sink, checkpoint=checkpoint, state_partitions=_parallelism(spark), rocksdb=True)
    return finalize(_ntz(out, "session_start", "session_end"))


def q_stream_late_rows(spark, sf_dir):
    """Every tenth event arrives after all others: what its window no longer
    takes in goes to the late sink, and on time and late are all rows."""
    ev = si.web_events(spark, sf_dir)
    folder, on_time, late = (_sink(spark, n) for n in ("late_source", "on_time", "late"))
    checkpoint = checkpoint_path(spark, "streams", uuid.uuid4().hex)
    for part, some in enumerate((F.col("event_id") % 10 != 0, F.col("event_id") % 10 == 0)):
        _deliver(spark, ev.where(some), folder, part)
        split_late(_source(spark, folder).select("ip", "host", "url", "event_timestamp"), on_time=on_time, late=late,
                   checkpoint=checkpoint)
    out = None
    for path, flag in ((on_time, False), (late, True)):
        rows = sj.read_sink(spark, path).withColumn("is_late", F.lit(flag))
        out = rows if out is None else out.unionByName(rows)
    return finalize(_ntz(out, "event_timestamp"))


def q_stream_exactly_once(spark, sf_dir):
    """The parsed events in a ledger sink, all batches delivered a second time."""
    path = _sink(spark, "ledger")
    rows = _parsed(spark, sf_dir).select("ip", "host", "url", "referrer", "event_timestamp")
    for _ in range(2):  # a new checkpoint numbers its batches from 0 again
        write_ledger(rows, path, checkpoint_path(spark, "streams", uuid.uuid4().hex))
    return finalize(_ntz(read_ledger(spark, path, rows.schema), "event_timestamp"))


QUERIES = {
    "stream_locate": q_stream_locate,
    "stream_sessions_recovered": q_stream_sessions_recovered,
    "stream_late_rows": q_stream_late_rows,
    "stream_exactly_once": q_stream_exactly_once,
    "stream_parse": q_stream_parse,
    "stream_geo": q_stream_geo,
    "stream_tumbling_host": q_stream_tumbling_host,
    "stream_tumbling_host_referrer": q_stream_tumbling_host_referrer,
    "stream_sessions": q_stream_sessions,
    "stream_dedup": q_stream_dedup,
    "sessions_batch": q_sessions_batch,
    "session_stats": q_session_stats,
}
