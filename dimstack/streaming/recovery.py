"""Stateful streams that survive a restart (T07): settings, and a look into the
state that a checkpoint holds."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def stateful_settings(spark: SparkSession, *, state_partitions: int | None = None, rocksdb: bool = True) -> Iterator[None]:
    """Session settings that a stateful query takes with it when it starts:

    * state in RocksDB, outside the heap, with a changelog per batch instead of
      a snapshot (``rocksdb``; fixed for the life of a checkpoint);
    * sessions of a hot key merged inside each input partition first, so one
      (ip, host) does not send all its rows to one task;
    * ``state_partitions`` state stores (fixed for the life of a checkpoint).

    The settings are put back on leaving."""
    wanted = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}
    if rocksdb:
        wanted["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
        wanted["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def open_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """The rows (key, value, partition_id) that a stopped query's operator holds,
    from its checkpoint: windows and sessions that no watermark has closed."""
    with stateful_settings(spark):
        return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
