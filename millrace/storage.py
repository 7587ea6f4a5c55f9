"""Intermediate storage that outlives an executor.

Work that is read more than once, or that would otherwise drag a long lineage
behind it, is written to the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, as the session names it."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def on_one_machine(spark: SparkSession) -> SparkSession:
    """Name a shared folder for a session of tests, bench or smoke run that has none.

    Only where driver and executors are one process; on a cluster a folder of the
    driver's is none of the executors', and work that lands anything stops with an error.
    """
    alone = spark.sparkContext.master.partition("[")[0] == "local"
    if alone and not spark.conf.get(CHECKPOINT_KEY, None):
        spark.conf.set(CHECKPOINT_KEY, f"file://{tempfile.mkdtemp(prefix='millrace-')}")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession, path: str) -> None:
    """Delete a landed folder that no later read needs."""
    if not path.startswith(shared_dir(spark) + "/"):
        raise ValueError(f"{path} is not in the shared folder")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(*landed: DataFrame) -> None:
    """Delete what ``land`` has written for these frames, when nothing reads it any more."""
    for df in landed:
        release(df.sparkSession, df.landed_at)


FREE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def land(df: DataFrame, label: str = "landed", free: bool = False) -> DataFrame:
    """Write ``df`` once and return a frame that reads the files back.

    The lineage is cut, the rows are computed once however often they are used,
    and Spark knows the size on disk: it broadcasts the frame in a join only
    while that size is under ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffles (with the adaptive skew split) beyond it. With ``free``, the shuffle
    files of the write are removed as soon as it ends: for frames that nothing runs again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(FREE_KEY, "false")
    if free:
        spark.conf.set(FREE_KEY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_KEY, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.landed_at = path
    return out


BATCH_BYTES = 2 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let no Arrow batch that goes to Python exceed ``BATCH_BYTES``, where rows may be wide.

    Spark's own bound is 64 MB, which JVM and Python hold several times over for each
    worker, and an executor keeps more workers than cores. A session that asks for less keeps its setting.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
