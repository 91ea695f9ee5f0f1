"""Cutting lineage with tables that outlive any executor.

An iterative operator writes the state of each round as a Parquet table below ``spark.checkpoint.dir`` and reads it
back.  The folder is shared by all executors, so a lost executor costs only the tasks it was running.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of the session's ``spark.checkpoint.dir``; a temporary one is set only for a local master without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="machiya-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


class Table:
    """A written intermediate result: ``df`` reads it, ``drop()`` deletes it before the session's end does."""

    def __init__(self, df: DataFrame, path: str):
        self.df, self.path = df, path

    def drop(self) -> None:
        fs, where = _file_system(self.df.sparkSession, self.path)
        fs.delete(where, True)


def write_table(df: DataFrame, label: str = "step") -> Table:
    """Write ``df`` below the shared folder and return the written table; it is deleted when the session ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/machiya/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    fs, where = _file_system(spark, path)
    fs.deleteOnExit(where)
    return Table(spark.read.schema(df.schema).parquet(path), path)
