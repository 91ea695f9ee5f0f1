"""Enough tasks for work that is costly per row."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """A scan over at least as many partitions as the session has cores.

    Only an input with fewer splits than cores is shuffled; a large table has more and is read as it lies.  Frames with a
    shuffle of their own stay as they are, since asking for their partitions would run it.
    """
    if "AdaptiveSparkPlan" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def evenly(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` over the session's number of shuffle partitions, which adaptive execution then leaves apart.

    For frames whose rows are small but costly, so that their bytes would merge them into one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
