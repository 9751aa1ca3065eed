"""Intermediate results that outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: list[tempfile.TemporaryDirectory] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder that goes away
    with the process; a cluster has to name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if not _local_dirs:
        _local_dirs.append(tempfile.TemporaryDirectory(prefix="docstrata-"))
    return _local_dirs[0].name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder, deleted when the application ends."""
    folder = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return f"{folder}/data"


def durable(df: DataFrame) -> DataFrame:
    """The same rows, written down once: later reads see these very rows."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint(eager=True)
