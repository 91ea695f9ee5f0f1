"""Constraint checks that return what is broken, and the guard against writing a table that shrank."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, rules: Mapping[str, Column], key: Sequence[str]) -> DataFrame:
    """(rule, rows): how many rows break each rule, and how many repeat a key (``key_repeated``); kept rules have no row."""
    counts = df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("rows")) for n in rules])).alias("c")
    broken = counts.select(cells).select("c.*").where("rows > 0")
    repeated = df.groupBy(*key).agg((F.count("*") - 1).alias("more")).where("more > 0").agg(F.sum("more").alias("rows")).where("rows > 0")
    return broken.unionByName(repeated.select(F.lit("key_repeated").alias("rule"), "rows"))


def require(df: DataFrame, rules: Mapping[str, Column], key: Sequence[str]) -> DataFrame:
    """``df`` itself if no rule is broken; else an error that names the broken ones."""
    found = violations(df, rules, key).collect()  # at most one row per rule
    if found:
        raise ValueError("; ".join(f"{r['rule']}: {r['rows']} rows" for r in found))
    return df


def shrink_guard(before: DataFrame, after: DataFrame, most: float) -> DataFrame:
    """(before, after, refused): row counts, and whether the table shrank by more than the share ``most``."""
    a, b = before.agg(F.count("*").alias("before")), after.agg(F.count("*").alias("after"))
    return a.crossJoin(F.broadcast(b)).withColumn("refused", F.col("after") < F.col("before") * (1 - most))
