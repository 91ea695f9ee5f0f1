"""Union-find semantics as a distributed operator: components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from machiya.plans.durable import write_table
from machiya.plans.skew import lookup_join


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every node of an edge with the least node of its component.

    Each round links all greater neighbours of a node to its least one (large star), then all smaller neighbours
    likewise (small star); the star forest is reached when a round changes nothing.  A node with very many neighbours meets
    its least one by broadcast.  Null ends and loops are ignored.
    """
    both = lambda e: e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    state = write_table(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "stars")
    while True:
        around = both(state.df)
        least = around.groupBy(F.col("u").alias("k")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = lookup_join(around, least, "u", "k", "inner").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        half = write_table(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "stars")
        lower = half.df
        centre = lower.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = lookup_join(lower, centre, "u", "k", "inner").select("v", "m").where("v <> m").unionByName(centre.select(F.col("k").alias("v"), "m"))
        nxt = write_table(small.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "stars")
        half.drop()
        same = nxt.df.count() == state.df.count() and nxt.df.exceptAll(state.df).limit(1).count() == 0
        state.drop()
        state = nxt
        if same:
            roots = state.df.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return state.df.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def best_of_component(members: DataFrame, root: str, order: list, key: str) -> DataFrame:
    """(root, best, size): the least member of each component by ``order``, which should end with the key."""
    rank = F.struct(*order)
    return members.groupBy(root).agg(F.min_by(F.col(key), rank).alias("best"), F.count("*").alias("size"))
