"""Aggregates: market metrics, percentile by rank, coverage, duplicate keys, histograms, window metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def market_metrics(df: DataFrame, area: str, price: Column, size: Column, areas: DataFrame | None = None) -> DataFrame:
    """(area, count, medianPrice, medianUnitPrice, confidence): medians over positive prices, and over price per size.

    With ``areas`` (one column named like ``area``) every area has a row, empty ones with count 0.  Confidence is
    medium from 10 rows, low below 3, else limited.  Rows without a positive price are not counted.
    """
    rows = df.select(F.col(area), F.when(price > 0, price).alias("_p"), F.when(size > 0, size).alias("_s")).where("_p is not null")
    out = rows.groupBy(area).agg(F.count("*").alias("n"), F.median("_p").alias("medianPrice"), F.median(F.col("_p") / F.col("_s")).alias("medianUnitPrice"))
    if areas is not None:
        out = areas.join(out, area, "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    return out.select(area, n.alias("transactionCount"), "medianPrice", "medianUnitPrice", F.when(n >= 10, "medium").when(n < 3, "low").otherwise("limited").alias("confidence"))


def rank_percentiles(df: DataFrame, groups: Sequence[str], value: Column, shares: Mapping[str, float]) -> DataFrame:
    """(groups, names...): the value at sorted position ``int((n - 1) * share)`` of each group; nulls are left out.

    Equal values are counted first, so a group travels as its distinct values with their counts, and the position is
    found by a running count over them.
    """
    from pyspark.sql.window import Window

    counted = df.select(*groups, value.alias("_v")).where("_v is not null").groupBy(*groups, "_v").agg(F.count("*").alias("_n"))
    by = Window.partitionBy(*groups).orderBy("_v")
    run = counted.withColumn("_upto", F.sum("_n").over(by.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_all", F.sum("_n").over(Window.partitionBy(*groups)))
    at = lambda s: F.floor((F.col("_all") - 1) * F.lit(s))
    return run.groupBy(*groups).agg(*[F.min(F.when(F.col("_upto") > at(s), F.col("_v"))).alias(n) for n, s in shares.items()])


def field_coverage(df: DataFrame, present: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """(by..., field, present, missing, ratio): how many rows have each field; one pass over the data."""
    wide = df.groupBy(*by).agg(F.count("*").alias("_n"), *[F.count_if(c).alias(n) for n, c in present.items()])
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("present")) for n in present])).alias("c")
    return wide.select(*by, "_n", cells).select(*by, "c.field", "c.present", (F.col("_n") - F.col("c.present")).alias("missing"), F.try_divide(F.col("c.present"), F.col("_n")).alias("ratio"))


def duplicate_keys(df: DataFrame, key: Column, identity: str, state: str) -> DataFrame:
    """(key, rows, ids, states): keys of more than one row, with distinct ids and a histogram of states as text."""
    per_state = df.select(key.alias("key"), F.col(identity).alias("_id"), F.col(state).alias("_state")).where("key is not null")
    counts = per_state.groupBy("key", "_state").agg(F.count("*").alias("_n"))
    shape = counts.groupBy("key").agg(F.sum("_n").alias("rows"), F.concat_ws(",", F.array_sort(F.collect_list(F.concat(F.coalesce("_state", F.lit("null")), F.lit("="), F.col("_n"))))).alias("states")).where("rows > 1")
    ids = per_state.groupBy("key").agg(F.count_distinct("_id").alias("ids"))
    return shape.join(ids, "key").select("key", "rows", "ids", "states")


def counters(df: DataFrame, lists: Mapping[str, Column]) -> DataFrame:
    """(counter, name, n): how often each name occurs in each list column."""
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("counter"), c.alias("names")) for n, c in lists.items()])).alias("c")
    return df.select(cells).select("c.counter", F.explode("c.names").alias("name")).groupBy("counter", "name").agg(F.count("*").alias("n"))


def window_metrics(events: DataFrame, area: str, entity: str, time: str, price: str, now: Column, windows: Sequence[int]) -> DataFrame:
    """(area, days, ...): per look-back window the observed entities, and medians of their first and last prices.

    Events in the closed window count; of each entity the first and last priced events, by (time, price), give its
    start and end.  ``changePct`` compares the medians over entities with at least two prices.  ``coveragePct`` is the
    observed span in days as a share of the window, at most 100.
    """
    days = F.explode(F.array(*[F.lit(w) for w in windows])).alias("days")
    placed = events.select(F.col(area).alias("area"), F.col(entity).alias("entity"), F.col(time).alias("t"), F.col(price).alias("p"), days)
    inside = placed.where((F.col("t") <= now) & (F.col("t") >= F.timestamp_micros(F.unix_micros(now) - F.col("days").cast("bigint") * 86_400_000_000)))
    priced = F.when(F.col("p") > 0, F.struct("t", "p"))
    one = inside.groupBy("area", "days", "entity").agg(F.count("*").alias("events"), F.count(priced).alias("points"), F.min(priced).getField("p").alias("first"), F.max(priced).getField("p").alias("last"), F.min("t").alias("t0"), F.max("t").alias("t1"))
    two = F.col("points") >= 2
    out = one.groupBy("area", "days").agg(
        F.count("*").alias("entities"), F.sum("events").alias("events"), F.median("first").alias("startMedian"), F.median("last").alias("endMedian"),
        F.median(F.when(two, F.col("first"))).alias("_a"), F.median(F.when(two, F.col("last"))).alias("_b"), F.count_if(two & (F.col("last") < F.col("first"))).alias("reduced"),
        F.floor((F.unix_micros(F.max("t1")) - F.unix_micros(F.min("t0"))) / F.lit(86_400_000_000)).alias("spanDays"),
    )
    return out.withColumn("changePct", F.try_divide(F.col("_b") - F.col("_a"), F.col("_a")) * 100).withColumn("coveragePct", F.least(F.lit(100.0), F.col("spanDays") / F.col("days") * 100)).drop("_a", "_b")
