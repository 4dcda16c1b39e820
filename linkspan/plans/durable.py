"""Cutting lineage through the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's own clean-up at the end of an execution, for DataFrames that are not run through Connect.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where none is set, a local folder is made if all runs on one machine; a cluster needs one."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="linkspan-")
        spark.sparkContext.setCheckpointDir(found)
    return found


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside drops its shuffles when it is done; else they stay until the driver's garbage is collected."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def durable(df: DataFrame) -> DataFrame:
    """df, written once as Parquet to the shared folder and read back.

    Unlike a local checkpoint it outlives any executor; unlike checkpoint() it stays columnar, so later
    readers prune columns. The shuffles of the write go with it. The files go when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/linkspan-{uuid.uuid4().hex}"
    with _shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_durable_path"] = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete the files of durable tables that nothing will read again, and let Spark drop shuffles that nothing refers to.

    Shuffle files stay until the driver's garbage is collected, which may be long after their last use.
    """
    for df in tables:
        path = df.__dict__.pop("_durable_path", None)
        if path:
            sc = df.sparkSession.sparkContext
            hadoop_path = sc._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hadoop_path, True)
    if tables:
        gc.collect()
        tables[0].sparkSession.sparkContext._jvm.System.gc()
