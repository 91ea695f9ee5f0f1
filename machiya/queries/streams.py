"""Queries that run a stream to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from machiya.streaming.observations import changes, event_stream, run_to_end, sessions


def session_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Every session of the table, those that are open at its end included."""
    return run_to_end(sessions(event_stream(spark, folder, delay=None, files=None), "user_id", "ts", "12 hours"), "sessions", "complete")


def session_spans(spark: SparkSession, folder: str) -> DataFrame:
    """The sessions of ``session_stream``, their times as microseconds."""
    out = session_stream(spark, folder)
    return out.select("user_id", F.unix_micros("start").alias("startMicros"), F.unix_micros("end").alias("endMicros"), "events")


def change_stream(spark: SparkSession, folder: str) -> DataFrame:
    out = run_to_end(changes(event_stream(spark, folder), "user_id", "ts", ["event_type"]), "changes")
    return out.groupBy(F.col("user_id").cast("bigint").alias("user_id")).agg(F.count("*").alias("changes"))


QUERIES = {"session_stream": session_stream, "session_spans": session_spans, "change_stream": change_stream}
SQL = {
    "session_spans": """WITH l AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 12 HOUR THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM l)
        SELECT user_id, epoch_us(min(ts)) AS startMicros, epoch_us(max(ts) + INTERVAL 12 HOUR) AS endMicros, count(*) AS events FROM s GROUP BY user_id, n""",
    "change_stream": """WITH l AS (SELECT user_id, event_type, lag(event_type) OVER w AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type))
        SELECT user_id, count(*) FILTER (b IS NULL OR b <> event_type) AS changes FROM l GROUP BY user_id""",
}
