"""Restarts from a checkpoint, late rows, and a sink that takes a batch once."""

import uuid

from pyspark.sql import functions as F

from dimstack.session import checkpoint_path
from dimstack.streaming import jobs as sj
from dimstack.streaming.late import LateRows, batch_watermark, split_late
from dimstack.streaming.ledger import LedgerWriter, Written, read_ledger, write_ledger
from dimstack.streaming.recovery import ROCKSDB, open_state, stateful_settings

HEARTBEAT = '{"event_time": "2100-01-01T00:00:00.000Z"}'


def msg(ip, minute, second=0, host="h"):
    return (f'{{"url": "/", "referrer": "r", "host": "{host}", "ip": "{ip}", '
            f'"event_time": "2024-01-01T{minute // 60:02d}:{minute % 60:02d}:{second:02d}.000Z"}}')


def deliver(spark, folder, part, texts):
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.parquet(f"{folder}/part={part}")


def source(spark, folder):
    return sj.parse_events(spark.readStream.schema("value string").option("recursiveFileLookup", True).parquet(folder))


def base(spark, name):
    return checkpoint_path(spark, "tests", f"{name}-{uuid.uuid4().hex}")


def run_sessions(spark, at, part, **options):
    return sj.run_available(sj.sessions(source(spark, f"{at}/src")), f"{at}/out", checkpoint=f"{at}/ckpt",
                            state_partitions=2, rocksdb=True, **options)


def test_restart_equals_one_run(spark):
    first = [msg("a", 0), msg("a", 3), msg("b", 4), msg("a", 60)]
    then = [msg("a", 64), msg("b", 61), msg("c", 62)]
    one, two = base(spark, "one"), base(spark, "two")
    deliver(spark, f"{one}/src", 0, first + then)
    whole = run_sessions(spark, one, 0)
    deliver(spark, f"{one}/src", 1, [HEARTBEAT])
    whole = run_sessions(spark, one, 1)
    deliver(spark, f"{two}/src", 0, first)
    run_sessions(spark, two, 0)
    # stopped: a's second session is open and must be in the state
    state = open_state(spark, f"{two}/ckpt")
    held = [str(r) for r in state.collect()]
    assert any("'a'" in r for r in held), held
    deliver(spark, f"{two}/src", 1, then)
    run_sessions(spark, two, 1)
    deliver(spark, f"{two}/src", 2, [HEARTBEAT])
    again = run_sessions(spark, two, 2)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(again) == key(whole)
    mine = {(r.ip, r.num_events) for r in again.collect()}
    assert mine == {("a", 2), ("b", 1), ("c", 1)} and again.count() == 5


def test_settings_hold_while_a_query_starts_and_not_after(spark):
    key = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = (spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions"))
    with stateful_settings(spark, state_partitions=3):
        assert spark.conf.get(key) == "true" and spark.conf.get("spark.sql.shuffle.partitions") == "3"
        assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB
    assert (spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")) == before
    at, seen = base(spark, "start"), []
    deliver(spark, f"{at}/src", 0, [msg("a", 0)])

    def look(batch, epoch):
        seen.append((batch.sparkSession.conf.get(key), batch.count()))
    # the production entry point, run to the end of what is there
    sj.start(sj.sessions(source(spark, f"{at}/src")), look, checkpoint=f"{at}/ckpt", trigger={"availableNow": True},
             state_partitions=2).awaitTermination()
    assert seen and all(s[0] == "true" for s in seen) and spark.conf.get(key) == before[0]


def test_late_rows_are_kept_and_counted(spark):
    at = base(spark, "late")
    early = [msg("a", m) for m in (0, 7, 20)]
    after = [msg("b", 1), msg("b", 2), msg("b", 16, 30), msg("b", 30), '{"host": "h", "event_time": "bad"}']
    for part, texts in enumerate((early, after)):
        deliver(spark, f"{at}/src", part, texts)
        q = split_late(source(spark, f"{at}/src").select("ip", "host", "event_timestamp"), on_time=f"{at}/on", late=f"{at}/late",
                       checkpoint=f"{at}/ckpt")
    on_time, late = (sj.read_sink(spark, f"{at}/{x}") for x in ("on", "late"))
    # the watermark of the second batch: 00:20 less 15 seconds; the window of 00:16 is open
    assert batch_watermark(spark, f"{at}/ckpt", 1) == 1704067200000 + 20 * 60_000 - 15_000
    minutes = lambda df: sorted(str(r.event_timestamp)[11:19] for r in df.collect())
    assert minutes(late) == ["", "00:01:00", "00:02:00"]
    assert minutes(on_time) == ["00:00:00", "00:07:00", "00:16:30", "00:20:00", "00:30:00"]
    assert on_time.count() + late.count() == len(early) + len(after) and q is not None


def test_listener_adds_up_all_batches(spark):
    at, listener = base(spark, "listener"), LateRows()
    spark.streams.addListener(listener)
    try:
        for part, texts in enumerate(([msg("a", 40)], [msg("b", 1), msg("c", 11)], [msg("d", 2)], [msg("e", 50)])):
            deliver(spark, f"{at}/src", part, texts)
            counts = sj.tumbling_counts(source(spark, f"{at}/src"), ["ip"])
            q = sj.start(counts, lambda df, e: df.count(), checkpoint=f"{at}/ckpt", trigger={"availableNow": True},
                         state_partitions=2)
            q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(listener)
    assert listener.dropped[str(q.id)] == 3


def test_a_batch_is_taken_once(spark):
    at = base(spark, "ledger")
    deliver(spark, f"{at}/src", 0, [msg("a", 0), msg("b", 1)])
    rows = source(spark, f"{at}/src").select("ip", "event_timestamp")
    write_ledger(rows, f"{at}/sink", f"{at}/ckpt")
    deliver(spark, f"{at}/src", 1, [msg("c", 2)])
    write_ledger(rows, f"{at}/sink", f"{at}/ckpt")
    read = lambda: sorted(r.ip for r in read_ledger(spark, f"{at}/sink", rows.schema).collect())
    assert read() == ["a", "b", "c"]
    # a lost checkpoint: batch 0 is delivered again, with all rows
    write_ledger(rows, f"{at}/sink", f"{at}/ckpt2")
    assert read() == ["a", "b", "c"]


def test_aborted_tasks_leave_nothing(spark):
    at = base(spark, "abort").removeprefix("file://")
    writer = LedgerWriter("file://" + at)
    batches = spark.range(10).select(F.col("id").cast("string").alias("ip")).toArrow().to_batches()
    done, other = writer.write(iter(batches)), writer.write(iter(batches))
    assert writer.write(iter([])) == Written(None)
    writer.abort([done, None], 0)
    schema = spark.range(0).select(F.col("id").cast("string").alias("ip")).schema
    writer.commit([other, Written(None)], 1)
    writer.commit([writer.write(iter(batches))], 1)
    assert read_ledger(spark, "file://" + at, schema).count() == 10
    import os
    assert len(os.listdir(f"{at}/data")) == 1
