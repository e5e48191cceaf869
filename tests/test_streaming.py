"""Streaming semantics: append mode and the watermark, late rows, two sinks,
bad event-time text."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from dimstack.session import checkpoint_path
from dimstack.streaming import jobs as sj


def _write_batches(spark, folder, batches):
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "value string")
        df.write.mode("append").parquet(f"{folder}/b{i:03d}")


def _msg(host, ts, referrer="r"):
    return ('{"url": "/", "referrer": "%s", "host": "%s", "ip": "1", "event_time": "%s"}'
            % (referrer, host, ts))


def _run_in_batches(spark, base, batches, build, output_mode="append"):
    """Deliver ``batches`` one micro-batch at a time: write a file, run the
    query over what is available, restart on the same checkpoint (watermark
    and state carry over).  Returns (sink frame, progress reports)."""
    progress = []
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "value string").write.parquet(f"{base}/src/b{i:03d}")
        raw = (spark.readStream.schema("value string").option("recursiveFileLookup", True)
               .parquet(f"{base}/src"))
        q = (build(raw).writeStream.outputMode(output_mode)
             .foreachBatch(lambda df, e: df.write.mode("overwrite").parquet(f"{base}/out/epoch={e}"))
             .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
        progress += q.recentProgress
    return sj.read_sink(spark, f"{base}/out"), progress


def test_append_mode_drops_late_rows_and_holds_open_windows(spark):
    base = checkpoint_path(spark, "tests", uuid.uuid4().hex)
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)

    def ts(sec):
        return (t0 + dt.timedelta(seconds=sec)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    out, _ = _run_in_batches(spark, base, [
        [(_msg("a", ts(10)),), (_msg("a", ts(20)),)],
        [(_msg("a", ts(400)),)],          # advances the watermark past window 1
        [(_msg("a", ts(30)),)],           # late: older than the watermark → dropped
        [(_msg("a", ts(700)),)],          # closes window 2
    ], lambda raw: sj.tumbling_counts(sj.parse_events(raw), ["host"]))
    got = sorted((r["event_hour"].replace(tzinfo=None), r["num_hits"]) for r in out.collect())
    assert got[0] == (t0, 2)              # the late row was not counted
    assert len(got) == 2                  # window 3 (ts 700) is still open


def test_two_sinks_from_one_query(spark):
    base = checkpoint_path(spark, "tests", uuid.uuid4().hex)
    src = f"{base}/src"
    _write_batches(spark, src, [[(_msg("a", "2024-01-01T00:00:01.000Z", "x"),),
                                 (_msg("a", "2024-01-01T00:00:02.000Z", "y"),),
                                 (_msg("b", "2024-01-01T00:00:03.000Z", "y"),)]])
    raw = spark.readStream.schema("value string").option("recursiveFileLookup", True).parquet(src)
    agg = sj.tumbling_counts(sj.parse_events(raw), ["host", "referrer"])
    main = sj.run_available(agg, f"{base}/main", output_mode="complete",
                            extra_sinks=[(f"{base}/hosts", sj.host_counts_from_referrer_counts)])
    hosts = {r["host"]: r["num_hits"] for r in sj.read_sink(spark, f"{base}/hosts").collect()}
    assert main.count() == 3 and hosts == {"a": 2, "b": 1}


def test_bad_event_time_is_kept_aside(spark):
    raw = spark.createDataFrame([(_msg("a", "not a time"),), (_msg("a", "2024-01-01T00:00:01.000Z"),)],
                                "value string")
    parsed = sj.parse_events(raw, delay=None)
    assert sj.bad_events(parsed).count() == 1
    assert parsed.where(F.col("event_timestamp").isNotNull()).count() == 1


def test_sessions_batch_equals_gap_rule(spark):
    rows = [("1", "h", dt.datetime(2024, 1, 1, 0, m)) for m in (0, 3, 8, 20, 24)]
    df = spark.createDataFrame(rows, "ip string, host string, event_timestamp timestamp")
    s = sj.sessions(df, ["ip", "host"], gap="5 minutes").orderBy("session_start").collect()
    # gaps: 3, 5 (equal to the gap: merged), 12, 4
    assert [r["num_events"] for r in s] == [3, 2]


def test_dropped_rows_are_counted(spark):
    base = checkpoint_path(spark, "tests", uuid.uuid4().hex)
    _, progress = _run_in_batches(spark, base, [
        [(_msg("a", "2024-01-01T00:10:00.000Z"),)],
        [(_msg("a", "2024-01-01T00:00:01.000Z"),)]],          # late
        lambda raw: sj.tumbling_counts(sj.parse_events(raw), ["host"]))
    dropped = sum(int(op.get("numRowsDroppedByWatermark", 0))
                  for p in progress for op in p.get("stateOperators", []))
    assert dropped == 1


def test_session_stats_overall_and_by_host(spark):
    df = spark.createDataFrame([("1", "h1", 3), ("2", "h1", 1), ("3", "h2", 2)],
                               "ip string, host string, num_events long")
    got = {r["host"]: (r["avg_events_per_session"], r["n_sessions"])
           for r in sj.session_stats(df).collect()}
    assert got == {"h1": (2.0, 2), "h2": (2.0, 1), "(overall)": (2.0, 3)}


def test_streaming_dedup_within_watermark(spark):
    from dimstack.operators.quality import dedup_stream
    base = checkpoint_path(spark, "tests", uuid.uuid4().hex)
    m = _msg("a", "2024-01-01T00:00:01.000Z")
    out, _ = _run_in_batches(spark, base, [[(m,), (m,)], [(m,)],
                                           [(_msg("a", "2024-01-01T00:00:02.000Z"),)]],
                             lambda raw: dedup_stream(sj.parse_events(raw, delay=None),
                                                      ["ip", "event_timestamp"],
                                                      "event_timestamp", "1 hour")
                             .select("ip", "event_timestamp"))
    assert out.count() == 2           # the copies in batch 1 and the replay in batch 2 dropped
