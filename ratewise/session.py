"""Session construction and shared-storage helpers.

Scale notes: AQE is on so that shuffle partitions are coalesced at runtime, skewed join
partitions are split, and joins whose build side turns out small at runtime become broadcast
joins (the size check is AQE's, against ``spark.sql.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete checkpoint files once their DataFrame is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None, app: str = "ratewise",
                  conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(DEFAULT_CONF)
    if master.startswith("local"):
        # local mode runs every task in the driver JVM
        settings["spark.driver.memory"] = "8g"
        shuffle_partitions = shuffle_partitions or 8
    if shuffle_partitions:  # on a cluster the caller's or Spark's own setting holds
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read here; it is an error
    if it is unset. Under a local master (tests) a private folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ratewise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that operators with a
    Python step also work where the workers cannot see the driver's import path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(top)
    stage = tempfile.mkdtemp(prefix="ratewise-ship-")
    shutil.copytree(top, os.path.join(stage, name), ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(stage, f"{name}-src"), "zip", stage, name))
    _SHIPPED.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder, for tables written between jobs."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/ratewise-{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LONGEST_METHOD = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_removed(spark: SparkSession):
    """Queries that are run inside delete their shuffle files when they end, not when the driver
    collects garbage. For writes: what is written is read again, never the shuffles it came from."""
    return _set(spark, _CLEANUP, "true")


def code_in_parts(spark: SparkSession):
    """For writes of long chains of expressions: a stage whose code as one method has more than 8,000 bytes,
    which the JVM only interprets, is run operator by operator, whose code Spark cuts into short methods."""
    return _set(spark, _LONGEST_METHOD, "8000")


def arrow_rows(spark: SparkSession, n: int):
    """Queries that are planned inside hand ``n`` rows at a time to their Python steps."""
    return _set(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(n))


def stored(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder as Parquet and read it back."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.options(**({"compression": "zstd"} | (options or {}))).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours under the checkpoint folder, once nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: materialise into the shared checkpoint folder so that lost
    executors do not force recomputation of the whole lineage."""
    checkpoint_dir(df.sparkSession)
    cp = df.checkpoint(eager=True)
    # fresh attribute ids: a checkpoint keeps its input's ids, and joining two tables that share
    # ids makes Spark rewrite one side, which can lose its recorded partitioning
    return cp.select(*[cp[c].alias(c) for c in cp.columns])

