"""Rows behind the watermark (T11): counted over all batches, and kept."""

from __future__ import annotations

import json
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .jobs import WINDOW_SIZE


class LateRows(StreamingQueryListener):
    """Adds up, per query, what stateful operators dropped as late in all of its
    batches.  An aggregation counts what reaches its state, so rows that a task
    has summed up before count once; ``split_late`` keeps the rows themselves."""

    def __init__(self) -> None:
        super().__init__()
        self.dropped: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.dropped[str(progress.id)] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def batch_watermark(spark: SparkSession, checkpoint: str, epoch: int) -> int:
    """The watermark, in milliseconds, that batch ``epoch`` runs under: what its
    entry of the checkpoint's offset log says."""
    lines = [r.value for r in spark.read.text(f"{checkpoint}/offsets/{epoch}").collect()]
    return int(next(json.loads(x)["batchWatermarkMs"] for x in lines if "batchWatermarkMs" in x))


def is_late(watermark_ms: int, ts_col: str, size: str):
    """Whether a row's tumbling window is closed by the watermark; a row without
    an event time is in no window and counts as late."""
    end = F.unix_millis(F.window(ts_col, size)["end"])
    return F.coalesce(end <= F.lit(watermark_ms), F.lit(True))


def split_late(events: DataFrame, *, on_time: str, late: str, checkpoint: str, size: str = WINDOW_SIZE,
               ts_col: str = "event_timestamp"):
    """Run a watermarked stream over all available input and write every row to
    one of two folders: ``on_time`` what windows of ``size`` still take in, under
    the watermark of the row's batch, ``late`` the rest.  Both are overwritten per
    epoch, so a replayed batch changes nothing.  Returns the ended query."""
    spark = events.sparkSession

    def write(batch: DataFrame, epoch: int) -> None:
        # window() drops rows without a time, so those are set apart first
        marked = batch.withColumn("__late", F.lit(True)).where(F.col(ts_col).isNull()).unionByName(
            batch.where(F.col(ts_col).isNotNull())
            .withColumn("__late", is_late(batch_watermark(spark, checkpoint, epoch), ts_col, size)))
        marked = marked.persist()
        try:
            for path, flag in ((on_time, False), (late, True)):
                marked.where(F.col("__late") == flag).drop("__late").write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        finally:
            marked.unpersist()

    q = (events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
