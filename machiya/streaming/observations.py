"""Structured Streaming forms: changes per key with state, sessions and windows with watermarks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from machiya.plans.durable import shared_folder


def event_stream(spark: SparkSession, folder: str, name: str = "events", time: str = "ts", delay: str | None = "1 day", files: int | None = 4) -> DataFrame:
    """A table's files as a stream, its time as a timestamp with a watermark.

    Rows that are later than ``delay`` may be dropped; without one nothing is.  ``files`` are read per trigger, all at
    once without it.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema)
    stream = (reader if files is None else reader.option("maxFilesPerTrigger", files)).parquet(f"{folder}/{name}.parquet*")
    stream = stream.withColumn(time, F.col(time).cast("timestamp"))
    return stream if delay is None else stream.withWatermark(time, delay)


def sessions(stream: DataFrame, key: str, time: str, gap: str) -> DataFrame:
    """(key, start, end, events): sessions that end after a gap without events."""
    out = stream.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("events"))
    return out.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


def tumbling(stream: DataFrame, key: str, time: str, width: str) -> DataFrame:
    """(key, start, events, value): counts and means per window of time."""
    out = stream.groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("events"))
    return out.select(key, F.col("w.start").alias("start"), "events")


def changes(stream: DataFrame, key: str, time: str, compared: Sequence[str]) -> DataFrame:
    """Rows (key, time, compared as text) that differ from the key's row before; the state is the last compared values.

    Within a batch the rows of a key are taken in the order of their times.
    """
    names = [key, time, *compared]
    schema = f"{key} string, {time} timestamp, " + ", ".join(f"{c} string" for c in compared)

    def step(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values([time, *compared])
        last = tuple(state.get) if state.exists else None
        kept = []
        for r in rows.itertuples(index=False):
            now = tuple(r)[2:]
            if now != last:
                kept.append(tuple(r))
                last = now
        state.update(last)
        yield pd.DataFrame(kept, columns=names)

    texts = stream.select(F.col(key).cast("string").alias(key), time, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in compared])
    return texts.groupBy(key).applyInPandasWithState(step, schema, ", ".join(f"s{i} string" for i, _ in enumerate(compared)), "append", GroupStateTimeout.NoTimeout)


def run_to_end(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there, into a written table, and return that table.

    In append mode windows and sessions that the watermark has not passed at the end are not in it; in complete mode
    all are, as they stand after the last batch.
    """
    import uuid

    spark = stream.sparkSession
    base = f"{shared_folder(spark)}/machiya/{label}-{uuid.uuid4().hex}"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/log").trigger(availableNow=True)
    if mode == "complete":
        query = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{base}/out")).start()
    else:
        query = writer.format("parquet").option("path", f"{base}/out").start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")
