"""Session-level helpers: UTC time zone and fault-tolerant cuts of long lineages."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Folders that this process has written, by the id of their Spark application.
_written: dict[str, list[str]] = {}


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone, so that "N days" never shifts at a clock change."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back
    to a temporary folder, because there every executor shares the driver's disk; that
    folder goes when Python ends.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            configured = tempfile.mkdtemp(prefix="wayfare-checkpoint-")
            atexit.register(shutil.rmtree, configured, ignore_errors=True)
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage: write it as Parquet to the shared folder, read it back.

    A lost executor costs nothing but the running tasks: the rows are in shared storage.
    Compared with a checkpoint, columns are compressed and pruned and sizes are known.
    ``release`` deletes what was written.
    """
    spark = df.sparkSession
    path = new_folder(spark, "wayfare")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for tables in the shared folder, which ``release`` deletes."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def hadoop_path(spark: SparkSession, name: str):
    """Path and file system of a folder in any store that Spark reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, name: str) -> None:
    path, system = hadoop_path(spark, name)
    system.delete(path, True)


def release(spark: SparkSession) -> int:
    """Delete what this session wrote to the shared folder; DataFrames over it are then invalid."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for name in paths:
        delete_folder(spark, name)
    return len(paths)
