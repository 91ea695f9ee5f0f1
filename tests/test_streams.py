from datetime import datetime

import pytest
from pyspark.sql import functions as F

from machiya.functions import dates
from machiya.queries.streams import session_stream
from machiya.sources.documents import search_targets
from machiya.streaming.observations import changes, event_stream, run_to_end, sessions, tumbling


@pytest.fixture
def folder(spark, tmp_path):
    at = lambda d, h=0: datetime(2026, 1, d, h)
    batches = [
        [(1, at(1), "a", "x"), (2, at(1, 1), "a", "x"), (3, at(1, 2), "a", "y"), (4, at(1, 1), "b", None)],
        [(5, at(1, 5), "a", "y"), (6, at(2), "a", "x"), (7, at(2), "b", None), (8, at(2), "b", "x")],
        [(9, at(20), "c", "z")],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "event_id int, ts timestamp, user string, kind string").coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_changes_keep_state_over_batches(spark, folder):
    got = run_to_end(changes(event_stream(spark, folder), "user", "ts", ["kind"]), "changes").collect()
    seen = sorted((r["user"], r["kind"]) for r in got)
    assert seen.count(("c", "z")) == 1 and {s for s in seen if s[0] == "a"} == {("a", "x"), ("a", "y")}
    assert len([s for s in seen if s[0] == "a"]) == 3 and seen.count(("b", "x")) == 1


def test_sessions_and_windows(spark, folder):
    got = run_to_end(sessions(event_stream(spark, folder), "user", "ts", "3 hours"), "sessions").collect()
    assert sorted((r["user"], r["events"]) for r in got) == [("a", 1), ("a", 4), ("b", 1), ("b", 2)]
    days = run_to_end(tumbling(event_stream(spark, folder), "user", "ts", "1 day"), "days").collect()
    assert sorted((r["user"], r["start"].day, r["events"]) for r in days) == [("a", 1, 4), ("a", 2, 1), ("b", 1, 1), ("b", 2, 2)]


def test_session_stream_has_all_sessions_of_unordered_files(spark, tmp_path):
    at = lambda d, h=0: datetime(2026, 1, d, h)
    files = [[(1, at(20))], [(1, at(20, 11)), (2, at(19))], [(3, at(9))], [(3, at(18))], [(3, at(18, 6))], [(1, at(1)), (2, at(2))], [(1, at(1, 5))], [(3, at(9, 13))]]
    for rows in files:
        spark.createDataFrame(rows, "user_id bigint, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    got = sorted((r["user_id"], r["start"], r["end"], r["events"]) for r in session_stream(spark, str(tmp_path)).collect())
    assert got == [
        (1, at(1), at(1, 17), 2), (1, at(20), at(20, 23), 2), (2, at(2), at(2, 12), 1), (2, at(19), at(19, 12), 1),
        (3, at(9), at(9, 12), 1), (3, at(9, 13), at(10, 1), 1), (3, at(18), at(18, 18), 2),
    ]


def test_targets(spark):
    df = spark.createDataFrame([("one", "https://a.example/x", None), ("two", "https://a.example/x", True), ("off", "https://a.example/y", False), ("bad", "x", True), ("none", None, True)], "name string, url string, enabled boolean")
    assert [(r["url"], r["name"]) for r in search_targets(df).collect()] == [("https://a.example/x", "one")]


def test_iso_time(spark):
    df = spark.createDataFrame([("2026-01-02T03:04:05Z",), ("2026-01-02T12:04:05+09:00",), ("2026-01-02 03:04:05",), ("soon",), (None,)], "t string")
    got = [r[0] for r in df.select(F.date_format(dates.iso_time(F.col("t")), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2026-01-02 03:04:05"] * 3 + [None, None]
