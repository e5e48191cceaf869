"""Event-time streaming.

Sources: Kafka (``value`` JSON text) in production; a file stream over
Parquet in tests (no Kafka jar here).  Every job is a function of a
streaming DataFrame, so it also runs on a batch DataFrame (same plan shape,
used by the oracle tests).  Output goes through ``foreachBatch`` so one
stateful query can feed several sinks (T05); checkpoints and sink folders
live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import parse_event_time
from ..schemas import EVENT_TIME_PATTERN, WEB_EVENT_JSON
from ..session import checkpoint_path
from .recovery import stateful_settings

WATERMARK_DELAY = "15 seconds"      # fixed values of the reference jobs
WINDOW_SIZE = "5 minutes"
SESSION_GAP = "5 minutes"


# --- sources and sinks ---------------------------------------------------

def kafka_source(spark: SparkSession, *, servers: str, topic: str,
                 starting_offsets: str = "latest", options: dict | None = None) -> DataFrame:
    """Kafka topic → ``value`` as text (security options are passed
    through ``options``)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"))


def parquet_stream(spark: SparkSession, folder: str, *, schema: T.StructType,
                   file_glob: str = "*.parquet", max_files: int | None = None) -> DataFrame:
    """A file stream over Parquet files in ``folder`` (tests, replays)."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def as_messages(events: DataFrame, *, ts_col: str = "event_time",
                pattern: str = EVENT_TIME_PATTERN) -> DataFrame:
    """Render web events as the JSON text a Kafka topic carries."""
    text = F.date_format(ts_col, pattern)
    return events.select(F.to_json(F.struct(
        "url", "referrer", F.lit(None).cast("string").alias("user_agent"), "host", "ip",
        F.lit(None).cast("string").alias("headers"), text.alias("event_time"))).alias("value"))


def kafka_sink_frame(df: DataFrame) -> DataFrame:
    """Rows → ``value`` JSON text for ``writeStream.format("kafka")``."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def to_kafka(df: DataFrame, *, servers: str, topic: str, checkpoint: str,
             options: dict | None = None):
    """Start a streaming query writing ``df`` as JSON to a topic."""
    w = (kafka_sink_frame(df).writeStream.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("topic", topic)
         .option("checkpointLocation", checkpoint))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w.start()


def jdbc_batch_writer(url: str, table: str, properties: dict):
    """A ``foreachBatch`` function appending each micro-batch to a JDBC
    table (one transaction per partition; re-delivered batches are the
    sink's concern, as with the reference's JDBC connector)."""
    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.jdbc(url=url, table=table, mode="append", properties=properties)
    return write


def start(df: DataFrame, batch_fn, *, checkpoint: str, output_mode: str = "append",
          trigger: dict | None = None, state_partitions: int | None = None, rocksdb: bool = True):
    """Start a query with a ``foreachBatch`` sink and its checkpoint under
    shared storage, by default every ten seconds, with the settings of
    ``recovery.stateful_settings``.  Started again on the same checkpoint it goes
    on where it stopped.  Returns the StreamingQuery."""
    with stateful_settings(df.sparkSession, state_partitions=state_partitions, rocksdb=rocksdb):
        return (df.writeStream.outputMode(output_mode).foreachBatch(batch_fn)
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


# --- transformations -------------------------------------------------------

def parse_events(raw: DataFrame, *, schema: T.StructType = WEB_EVENT_JSON,
                 pattern: str = EVENT_TIME_PATTERN, delay: str | None = WATERMARK_DELAY,
                 value_col: str = "value") -> DataFrame:
    """P38 (T01, T02): JSON text → columns, event time parsed from text
    (NULL when malformed), bounded-delay watermark."""
    parsed = raw.select(F.from_json(F.col(value_col), schema).alias("m")).select("m.*")
    out = parsed.withColumn("event_timestamp", parse_event_time("event_time", pattern))
    return out.withWatermark("event_timestamp", delay) if delay else out


def bad_events(parsed: DataFrame) -> DataFrame:
    """Rows whose event time text did not parse (kept aside, not dropped)."""
    return parsed.where(F.col("event_timestamp").isNull())


def geo_enrich(events: DataFrame, geo: DataFrame, *, key_expr, key_col: str = "ip_key") -> DataFrame:
    """Stream-static left join with a location table; ``geodata`` is the
    JSON text {country, state, city} (empty text for missing values) or
    ``{}`` when the key is unknown.  The table is read again for every batch and
    has no hint: a size checked at the stream's start would bind it for life.
    ``operators.locate.locate`` looks addresses up by network, per batch."""
    g = geo.select(key_col, "country", "state", "city")
    j = events.withColumn(key_col, key_expr).join(g, key_col, "left")
    loc = F.to_json(F.struct(*[F.coalesce(c, F.lit("")).alias(c)
                               for c in ("country", "state", "city")]))
    return j.withColumn("geodata", F.when(F.col(f"`{key_col}`").isNull() |
                                          F.col("country").isNull(), F.lit("{}"))
                        .otherwise(loc)).drop("country", "state", "city", key_col)


def dedup_within_watermark(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P47 on a stream: drop repeated events of the same keys; the state of a
    key is kept only until the watermark passes it, so state stays bounded."""
    return events.dropDuplicatesWithinWatermark(list(keys))


def tumbling_counts(events: DataFrame, keys: Sequence[str], *, size: str = WINDOW_SIZE,
                    ts_col: str = "event_timestamp", count_col: str = "host") -> DataFrame:
    """P40/P41 (T03/T04): tumbling windows; ``event_hour`` is the window start
    (the reference's name, Q23); the count is of non-null ``count_col``."""
    return (events.groupBy(F.window(ts_col, size).alias("w"), *keys)
            .agg(F.count(count_col).alias("num_hits"))
            .select(F.col("w.start").alias("event_hour"), *keys, "num_hits"))


def sessions(events: DataFrame, keys: Sequence[str] = ("ip", "host"), *,
             gap: str = SESSION_GAP, ts_col: str = "event_timestamp") -> DataFrame:
    """P42 (T09): session windows by ``keys`` with an inactivity ``gap``."""
    return (events.groupBy(F.session_window(ts_col, gap).alias("s"), *keys)
            .agg(F.count(F.lit(1)).alias("num_events"))
            .select(*keys, F.col("s.start").alias("session_start"),
                    F.col("s.end").alias("session_end"), "num_events"))


def session_stats(sessions_df: DataFrame, by: str = "host") -> DataFrame:
    """Mean events per session, per ``by`` and overall (batch)."""
    return (sessions_df.groupingSets([[by], []], by)
            .agg(F.avg("num_events").alias("avg_events_per_session"),
                 F.count(F.lit(1)).alias("n_sessions"))
            .select(F.coalesce(F.col(by), F.lit("(overall)")).alias(by),
                    "avg_events_per_session", "n_sessions"))


# --- running ---------------------------------------------------------------

def run_available(df: DataFrame, sink_path: str, *, output_mode: str = "append",
                  checkpoint: str | None = None, extra_sinks=None, each_batch=None,
                  state_partitions: int | None = None, rocksdb: bool = False) -> DataFrame:
    """Run a streaming frame over all available input (``availableNow``),
    writing each micro-batch to Parquet at ``sink_path``; ``extra_sinks`` is a
    list of ``(path, fn)``: each batch also writes ``fn(batch)`` there (T05);
    ``each_batch`` is applied to every batch before it is written.

    Writes are idempotent, so a micro-batch replayed after a failure does not
    duplicate rows: complete mode overwrites the sink, append mode overwrites
    the batch's own ``epoch=<id>`` folder.  ``state_partitions`` sizes the
    state store of a stateful query (fixed for the life of its checkpoint).
    Returns the sink read back."""
    spark = df.sparkSession
    checkpoint = checkpoint or checkpoint_path(spark, "streams", uuid.uuid4().hex)
    targets = [(sink_path, each_batch), *(extra_sinks or [])]

    def write(batch: DataFrame, epoch: int) -> None:
        for path, fn in targets:
            out = batch if fn is None else fn(batch)
            if output_mode == "complete":
                out.write.mode("overwrite").parquet(path)
            else:
                out.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    start(df, write, checkpoint=checkpoint, output_mode=output_mode, trigger={"availableNow": True},
          state_partitions=state_partitions, rocksdb=rocksdb).awaitTermination()
    return read_sink(spark, sink_path)


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    """A sink folder written by ``run_available`` (epoch folders merged)."""
    df = spark.read.parquet(path)
    return df.drop("epoch") if "epoch" in df.columns else df


def host_counts_from_referrer_counts(batch: DataFrame) -> DataFrame:
    """Host-level counts derived from (window, host, referrer) counts: one
    stateful query serves both sinks of the reference job."""
    return batch.groupBy("event_hour", "host").agg(F.sum("num_hits").alias("num_hits"))
