"""Exact percentiles of very large groups by distributed multi-select over mergeable value counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from machiya.plans.durable import write_table

#: A group is hot, and its rounds are split by buckets of its values, when it holds more than this share of all values and
#: at least so many.
HOT_SHARE, HOT_VALUES = 1 / 200, 100_000
#: Levels of medians that a pass settles: each bucket proposes its median, those of its halves, and so on.
LEVELS = 3


def value_counts(df: DataFrame, groups: Sequence[str], value: str, relative_error: float = 0.0, weight: str | None = None) -> DataFrame:
    """The summary of one load: (groups, value, rows).  Summaries of any loads merge by ``merge_counts``.

    With ``relative_error`` 0 a summary is exact.  Otherwise positive values are replaced by the middle of logarithmic
    bins, so every percentile of any merged summaries is off by at most that share of its value, and a summary has
    about ``log(max / min) / (2 * relative_error)`` rows per group whatever the load's size.  Null and NaN values are
    left out; zero and negative values are kept as they are.  ``weight`` names a column of row counts, else each row is one.
    """
    x = F.col(value).cast("double")
    if relative_error > 0:
        step = math.log1p(relative_error) - math.log1p(-relative_error)
        middle = 2 * math.exp(step) / (1 + math.exp(step))  # equally far, relatively, from both ends of a bin
        x = F.when(x > 0, F.exp(F.floor(F.log(x) / step) * step) * middle).otherwise(x)
    kept = df.select(*groups, x.alias("value"), (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("rows")).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return kept.groupBy(*groups, "value").agg(F.sum("rows").alias("rows"))


def merge_counts(*summaries: DataFrame) -> DataFrame:
    """One summary of several: rows of equal group and value add up."""
    out = summaries[0]
    for s in summaries[1:]:
        out = out.unionByName(s)
    keys = [c for c in out.columns if c != "rows"]
    return out.groupBy(*keys).agg(F.sum("rows").alias("rows"))


def _inside(low: str = "low", high: str = "high", x: str = "x"):
    """True for values that may still hold a rank: those strictly between its bounds."""
    return (F.col(low).isNull() | (F.col(x) > F.col(low))) & (F.col(high).isNull() | (F.col(x) < F.col(high)))


def _weighted_median(proposals):
    """Median of an array of (at, weight) proposals, each counting with its weight; null without any."""
    half = F.aggregate(proposals, F.lit(0).cast("bigint"), lambda acc, m: acc + m["weight"]) / 2
    step = lambda acc, m: F.struct((acc["seen"] + m["weight"]).alias("seen"), F.when(acc["at"].isNull() & (acc["seen"] + m["weight"] >= half), m["at"]).otherwise(acc["at"]).alias("at"))
    return F.aggregate(F.array_sort(proposals), F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("double").alias("at")), step)["at"]


def _proposal():
    """What a bucket proposes: the medians of its values, of their halves and so on, and how many values it has."""
    parts = 1 << LEVELS
    return F.struct(F.percentile_approx("x", [i / parts for i in range(1, parts)], 200).alias("at"), F.count("*").alias("weight"))


def _pivots(proposals: str):
    """The weighted medians of the buckets' proposals of each level, in order."""
    each = lambda i: _weighted_median(F.transform(proposals, lambda m: F.struct(m["at"][i].alias("at"), m["weight"].alias("weight"))))
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[each(i) for i in range((1 << LEVELS) - 1)]))))


def percentiles(counts: DataFrame, groups: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """(groups, rows, share, percentile): linearly interpolated percentiles of each group of a summary.

    Multi-select: for every wanted rank of every group, each bucket of values proposes the median of its values that may
    still hold the rank (and, to settle ``LEVELS`` halvings at once, those of its halves and quarters); the medians of the
    proposals, weighted by the bucket's candidates, are the pivots; counting rows below, at and above them finds the rank
    at a pivot or rules out everything but the range between two of them for good.  Repeated for all groups and ranks at
    once until every rank is found at a pivot.  A round is one pass: while it counts, the buckets already propose for
    every range.  No group is ever gathered: a proposal is a bounded sketch, counts are partial sums, and the values of a
    hot group meet its ranks in as many tasks as there are buckets.  Every round is a written table; values that no open
    rank needs are left behind once they are the larger half.
    Groups may have null keys; an empty summary gives no rows.
    """
    groups, shares = list(groups), sorted(set(shares))
    spark = counts.sparkSession
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.struct(*[F.col(g) for g in groups])
    base = write_table(counts.select(key.alias("g"), F.col("value").alias("x"), "rows", F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int").alias("bucket")), "counts")
    sizes = write_table(base.df.groupBy("g").agg(F.sum("rows").alias("n"), F.count("*").alias("left")), "sizes")
    total = int(sizes.df.agg(F.sum("left")).first()[0] or 0)
    # at most 1 / HOT_SHARE groups
    hot = sizes.df.where(F.col("left") > max(HOT_VALUES, total * HOT_SHARE)).select("g", F.lit(True).alias("hot"))
    data = write_table(base.df.join(F.broadcast(hot), "g", "left").select("g", "x", "rows", "bucket", F.when(F.col("hot"), F.col("bucket")).otherwise(-1).alias("salt")), "values")
    base.drop()
    place = lambda s: (F.col("n") - 1) * F.lit(s)
    wanted = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(place(s)), F.ceil(place(s))) for s in shares])))
    local = data.df.groupBy("g", "bucket").agg(_proposal().alias("m"))
    first = local.groupBy("g").agg(F.collect_list("m").alias("p")).select("g", _pivots("p").alias("pivots"))
    empty = F.lit(None).cast("double")
    # a rank (from 0) among all rows of the group; its value lies strictly between low and high, `under` rows lie at or below
    # low.  Open ranges of a group are equal or apart, so `under` names them.
    started = sizes.df.join(hot, "g", "left").join(first, "g").select(
        "g", F.coalesce("hot", F.lit(False)).alias("hot"), F.explode(wanted).alias("rank"), empty.alias("low"), empty.alias("high"), F.lit(0).cast("bigint").alias("under"), "left", "pivots", empty.alias("value")
    )
    state = write_table(started, "ranks")
    salts = F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(-1)))).alias("salt")
    while True:
        ranges = state.df.where("value is null").groupBy("g", "under").agg(*[F.first(c).alias(c) for c in ("hot", "low", "high", "left", "pivots")])
        remaining = ranges.agg(F.count("*").alias("ranges"), F.sum("left").alias("left")).first()
        if not remaining["ranges"]:
            break
        if remaining["left"] * 2 <= total:
            need = ranges.select("g", "low", "high", salts)
            narrowed = write_table(data.df.alias("d").join(need.alias("q"), (F.col("d.g") == F.col("q.g")) & (F.col("d.salt") == F.col("q.salt")) & _inside("q.low", "q.high", "d.x"), "left_semi"), "values")
            data.drop()
            data, total = narrowed, int(remaining["left"])
        live = data.df.join(ranges.select("g", "under", "low", "high", "pivots", salts), ["g", "salt"]).where(_inside())
        # cells: even ones lie between two pivots, odd ones at a pivot
        cell = 2 * F.size(F.filter("pivots", lambda q: q < F.col("x"))) + F.array_contains("pivots", F.col("x")).cast("int")
        local = live.withColumn("cell", cell).groupBy("g", "under", "cell", "bucket").agg(F.sum("rows").alias("rows"), _proposal().alias("m"))
        # one row per bucket of a cell, and a few cells per range: bounded lists
        cells = local.groupBy("g", "under", "cell").agg(F.sum("rows").alias("rows"), F.sum("m.weight").alias("left"), F.collect_list("m").alias("p"))
        met = cells.select("g", "under", F.struct("cell", "rows", "left", F.when(F.col("cell") % 2 == 0, _pivots("p")).alias("next")).alias("c")).groupBy("g", "under").agg(F.array_sort(F.collect_list("c")).alias("cells"))
        walk = F.aggregate(
            "cells", F.struct(F.col("under").alias("seen"), F.lit(None).cast("struct<cell:int,rows:bigint,left:bigint,next:array<double>>").alias("c"), F.col("under").alias("before")),
            lambda acc, c: F.struct((acc["seen"] + c["rows"]).alias("seen"), F.when(acc["c"].isNull() & (F.col("rank") < acc["seen"] + c["rows"]), c).otherwise(acc["c"]).alias("c"), F.when(acc["c"].isNull(), acc["seen"]).otherwise(acc["before"]).alias("before")),
        )
        placed = state.df.where("value is null").join(met, ["g", "under"]).withColumn("w", walk)
        at = F.col("w.c.cell")
        pivot = lambda i: F.try_element_at("pivots", i.cast("int"))
        moved = placed.select(
            "g",
            "hot",
            "rank",
            F.when(at >= 2, pivot(F.floor(at / 2))).otherwise(F.col("low")).alias("low"),
            F.coalesce(pivot(F.floor(at / 2) + 1), F.col("high")).alias("high"),
            F.col("w.before").alias("under"),
            F.col("w.c.left").alias("left"),
            F.col("w.c.next").alias("pivots"),
            F.when(at % 2 == 1, pivot(F.floor(at / 2) + 1)).alias("value"),
        )
        nxt = write_table(state.df.where("value is not null").unionByName(moved), "ranks")
        state.drop()
        state = nxt
    data.drop()
    per_group = sizes.df.select("g", "n").join(state.df.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at")), "g")
    lower, upper = lambda s: F.element_at("at", F.floor(place(s))), lambda s: F.element_at("at", F.ceil(place(s)))
    cells = F.explode(F.array(*[F.struct(F.lit(s).alias("share"), (lower(s) + (upper(s) - lower(s)) * (place(s) - F.floor(place(s)))).alias("percentile")) for s in shares])).alias("c")
    return per_group.select(*[F.col(f"g.{g}").alias(g) for g in groups], F.col("n").alias("rows"), cells).select(*groups, "rows", "c.share", "c.percentile")
