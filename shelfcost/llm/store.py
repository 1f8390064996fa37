"""Intermediate tables in the folder that driver and executors share.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Only where
that is unset (tests, local mode) a temporary folder of this machine is used.
A written table cuts the lineage like a checkpoint does, and survives lost
executors: a later read needs only the shared folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcost.session import checkpoint_dir


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder as a path or URI, without a trailing slash."""
    return checkpoint_dir(spark).rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def save(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_fs(uri: str):
    """(file system, path) of a path or URI, for tasks that write or read files of their own."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of :func:`new_path`, once nothing reads it any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop(df: DataFrame) -> None:
    """Delete the files of a table that :func:`save` returned, once nothing reads it any more."""
    spark = df.sparkSession
    base = shared_dir(spark).split(":", 1)[-1].lstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if base in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: A saved table of at most this many bytes may be broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 16 << 20


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, a table that :func:`save` returned, marked for broadcast if its files take at most ``limit`` bytes."""
    fs_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path
    conf = df.sparkSession._jsc.hadoopConfiguration()
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    size = 0
    for folder in folders:
        path = fs_path(folder)
        size += path.getFileSystem(conf).getContentSummary(path).getLength()
    return F.broadcast(df) if size <= limit else df
