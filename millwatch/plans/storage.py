"""Where intermediate tables and stream checkpoints go: the folder the cluster names."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_made: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Without one, a job in a single JVM (``local[...]``, as in tests) takes a temporary
    folder; on a cluster this raises, as executors do not see each other's disks.
    """
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {SETTING} to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="millwatch-")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps survive lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def discard(*tables: DataFrame) -> None:
    """Remove ``written`` tables that nothing reads any more, and let go of the shuffle files of finished steps.

    Spark removes shuffle files once the driver has collected what refers to them, which a long run of
    large steps on a small driver may put off until the disks are full.
    """
    for table in tables:
        spark, path = table.sparkSession, table._stored_at
        _remove(spark, path)
        _made[spark.sparkContext.applicationId].remove(path)
    gc.collect()
    SparkSession.getActiveSession()._jvm.System.gc()


def release(spark: SparkSession) -> None:
    """Remove what this application put into the shared folder, once its results are stored elsewhere."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        _remove(spark, path)
