"""Session helpers.

Every job in this package is a pure function ``(DataFrame..., params) ->
DataFrame``; only the helpers here and the writers in ``sources.files`` touch
session state.  The defaults favour a cluster: AQE on (coalesces shuffle
partitions, converts joins to broadcast when the *measured* side is small,
splits skewed join partitions), UTC session clock, Arrow for pandas transfer.
"""

from __future__ import annotations

import os
import pathlib
import tempfile
import zipfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def _given() -> SparkConf:
    """What spark-submit, the submit arguments or spark-defaults have set."""
    if SparkContext._active_spark_context is None:
        conf = SparkConf(loadDefaults=False)
        if "driver-memory" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
            conf.set("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        SparkContext._ensure_initialized(conf=conf)
    return SparkConf()


def get_session(app: str = "dimstack", master: str | None = None,
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the jobs assume.

    A master or shuffle partition count that spark-submit or a cluster manager
    has chosen is never changed; ``local[N]`` and 8 partitions are defaults for
    a plain ``python`` run.  Arguments given here win over both.
    """
    given = _given()
    chosen = given.get("spark.master", None)
    builder = SparkSession.builder.appName(app)
    if master or not chosen:
        builder = builder.master(master or f"local[{os.environ.get('BENCH_CPUS', '8')}]")
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # AQE sizes reducers by bytes; the static count is an upper bound
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "128m",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    elif not chosen and not given.contains("spark.sql.shuffle.partitions"):
        conf["spark.sql.shuffle.partitions"] = "8"
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is; without it there is an error.  Only a local session, whose executors
    are this machine, gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getConf().get(CHECKPOINT_CONF) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="dimstack-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    """A sub-path of the shared checkpoint folder (for written tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: Python workers
    of another machine may not have it on their path."""
    sc = spark.sparkContext
    if getattr(sc, "_dimstack_sent", False):
        return
    root = pathlib.Path(__file__).resolve().parent
    target = pathlib.Path(tempfile.mkdtemp(prefix="dimstack-package-")) / "dimstack_core.zip"
    with zipfile.ZipFile(target, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._dimstack_sent = True
