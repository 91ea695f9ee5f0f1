"""Histories: changes only, price series, bounded lists, presence over runs, earliest stamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def changed_rows(df: DataFrame, key: str, order: Sequence[str], compared: Sequence[str]) -> DataFrame:
    """Rows that differ in a compared column from the row before of their key; a key's first row is kept."""
    by = Window.partitionBy(key).orderBy(*order)
    now = F.struct(*compared)
    before, first = F.lag(now).over(by), F.row_number().over(by) == 1
    return df.withColumn("_keep", first | ~before.eqNullSafe(now)).where("_keep").drop("_keep")


def price_history(df: DataFrame, key: str, time: str, price: str, tie: str) -> DataFrame:
    """Price changes with first price, total reduction, its rate and the number of reductions so far.

    One row per change of a positive price; repeated equal prices are one point.
    """
    by = Window.partitionBy(key).orderBy(time, tie)
    points = changed_rows(df.where(F.col(price) > 0).select(key, time, tie, price), key, [time, tie], [price])
    before = F.lag(price).over(by)
    first = F.first(price).over(by.rowsBetween(Window.unboundedPreceding, 0))
    falls = F.sum("_fell").over(by.rowsBetween(Window.unboundedPreceding, 0))
    marked = points.withColumn("_fell", F.when(F.col(price) < before, 1).otherwise(0))
    return marked.select(key, time, tie, F.col(price).alias("price"), first.alias("firstPrice"), F.greatest(first - F.col(price), F.lit(0)).alias("totalReduction"), F.greatest(F.try_divide(first - F.col(price), first), F.lit(0.0)).alias("reductionRate"), falls.alias("reductions"))


def bounded_history(history: Column, most: int = 30) -> Column:
    """An array cut to its first element and the last ``most - 1``; shorter arrays stay."""
    return F.when(F.size(history) > most, F.concat(F.slice(history, 1, 1), F.slice(history, -(most - 1), most - 1))).otherwise(history)


def bounded_rows(df: DataFrame, key: str, order: Sequence[str], most: int = 30) -> DataFrame:
    """Rows of each key cut to the first and the last ``most - 1``, without gathering any key."""
    up = Window.partitionBy(key).orderBy(*order)
    down = Window.partitionBy(key).orderBy(*[F.desc(o) for o in order])
    ranked = df.withColumn("_up", F.row_number().over(up)).withColumn("_down", F.row_number().over(down))
    return ranked.where((F.col("_up") == 1) | (F.col("_down") <= most - 1)).drop("_up", "_down")


def presence(seen: DataFrame, runs: DataFrame, key: str, run: str, healthy: str) -> DataFrame:
    """(key, firstRun, lastRun, misses, relisted): presence of keys over a series of runs.

    ``seen`` has one row per key and run (repeats allowed), ``runs`` one per run with its health.  Misses are the
    healthy runs after the key was last seen; unhealthy runs prove nothing.  ``relisted`` is the number of times a key
    came back after at least one healthy run without it.  Runs are numbered by a small table, so no grid of keys and
    runs is built.
    """
    numbered = runs.groupBy(run).agg(F.min(healthy).alias("_ok"))
    ok = F.when(F.col("_ok"), 1).otherwise(0)
    upto = F.sum(ok).over(Window.orderBy(run).rowsBetween(Window.unboundedPreceding, 0))
    numbered = numbered.withColumn("_healthy", upto)
    total = numbered.agg(F.max("_healthy").alias("_total"))
    rows = seen.select(key, run).distinct().join(F.broadcast(numbered), run)
    before = F.lag("_healthy").over(Window.partitionBy(key).orderBy(run))
    # healthy runs strictly between two sightings
    gaps = rows.withColumn("_gap", F.col("_healthy") - F.when(F.col("_ok"), 1).otherwise(0) - before)
    out = gaps.groupBy(key).agg(F.min(run).alias("firstRun"), F.max(run).alias("lastRun"), F.max("_healthy").alias("_last"), F.count_if(F.col("_gap") > 0).alias("relisted"))
    return out.crossJoin(F.broadcast(total)).select(key, "firstRun", "lastRun", (F.col("_total") - F.col("_last")).alias("misses"), "relisted")


def presence_state(misses: Column, ended_after: int, explicit: Column | None = None) -> Column:
    """State by misses: active, then possibly_ended, then observed_ended; explicit evidence confirms the end."""
    state = F.when(misses == 0, "active").when(misses < ended_after, "possibly_ended").otherwise("observed_ended")
    return state if explicit is None else F.when(F.coalesce(explicit, F.lit(False)), "confirmed_ended").otherwise(state)


def earliest_stamp(current: DataFrame, prior: DataFrame, key: str, holds: Column, stamp: str, now: Column) -> DataFrame:
    """Set ``stamp`` on rows for which ``holds``: their own, else the earliest prior one of the key, else now; clear it elsewhere."""
    old = prior.where(F.col(stamp).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min(stamp).alias("_old"))
    joined = current.join(old, F.col(key) == F.col("_k"), "left")
    return joined.withColumn(stamp, F.when(holds, F.coalesce(F.least(stamp, "_old"), now))).drop("_k", "_old")
