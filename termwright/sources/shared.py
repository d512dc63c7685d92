"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDER: list = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, a local session gets a temporary one, and on a cluster that is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _FOLDER:
        _FOLDER.append(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return _FOLDER[0]


def new_place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, its lineage cut. It goes when the session's JVM ends."""
    path = new_place(df.sparkSession, name)
    df.write.parquet(path)
    files, at = file_system(df.sparkSession, path)
    files.deleteOnExit(at)
    return df.sparkSession.read.schema(df.schema).parquet(path)
