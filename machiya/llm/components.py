"""Groups from pairwise links: minimum labels, pointer jumping, contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from machiya.plans.durable import Table, write_table
from machiya.plans.skew import lookup_join


def _jumped(parents: Table) -> Table:
    """Jump pointers until every node points at a root; a written table per jump."""
    while True:
        up = parents.df.select(F.col("node").alias("up_node"), F.col("label").alias("up_label"))
        moved = lookup_join(parents.df, up, "label", "up_node", "left")
        moved = moved.select("node", F.coalesce("up_label", "label").alias("label"), (F.coalesce("up_label", "label") != F.col("label")).alias("moved"))
        nxt = write_table(moved, "jump")
        changed = nxt.df.where("moved").limit(1).count() > 0
        parents.drop()
        parents = Table(nxt.df.select("node", "label"), nxt.path)
        if not changed:
            return parents


def connected_groups(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """(node, label) for every node of ``pairs``; label is the smallest node linked with it directly or indirectly.

    Rows with a null id or twice the same id link nothing and give no node; repeated and turned pairs count once; an
    empty table gives no rows; other columns are ignored.  Each round lets every node take the smallest neighbour's
    label (aggregated before the shuffle, so a node in very many pairs costs one row per task), jumps pointers until
    no label changes, and replaces the ends of every link by their labels.  Over two rounds at least half of the nodes
    that still have links lose them (a star whose centre is its largest id keeps its leaves for one round), so the rounds
    grow with the logarithm of the nodes.  All states are written tables.
    """
    a, b = F.col(left), F.col(right)
    links = pairs.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
    edges = write_table(links.distinct(), "links")
    labels: Table | None = None
    while edges.df.limit(1).count() > 0 or labels is None:
        ends = F.explode(F.array(F.struct(F.col("hi").alias("node"), F.col("lo").alias("label")), F.struct(F.col("lo").alias("node"), F.col("lo").alias("label")))).alias("e")
        hooked = edges.df.select(ends).select("e.*").groupBy("node").agg(F.min("label").alias("label"))
        found = _jumped(write_table(hooked, "hook"))
        side = lambda n: found.df.select(F.col("node").alias(f"{n}_node"), F.col("label").alias(f"{n}_label"))
        half = write_table(lookup_join(edges.df, side("lo"), "lo", "lo_node", "inner").select("lo_label", "hi"), "half")
        both = lookup_join(half.df, side("hi"), "hi", "hi_node", "inner").where("lo_label <> hi_label")
        fewer = write_table(both.select(F.least("lo_label", "hi_label").alias("lo"), F.greatest("lo_label", "hi_label").alias("hi")).distinct(), "links")
        edges.drop()
        half.drop()
        edges = fewer
        if labels is None:
            labels = found
        else:
            up = found.df.select(F.col("node").alias("up_node"), F.col("label").alias("up_label"))
            merged = lookup_join(labels.df, up, "label", "up_node", "left").select("node", F.coalesce("up_label", "label").alias("label"))
            wider = write_table(merged, "labels")
            labels.drop()
            found.drop()
            labels = wider
    edges.drop()
    return labels.df


def linking_rows(candidates: DataFrame, threshold: float = 0.72) -> DataFrame:
    """Rows of a pair table that link their two ids: score at least ``threshold`` (null and NaN do not), ids differ."""
    score = F.col("similarityScore")
    return candidates.where(score.isNotNull() & ~F.isnan(score) & (score >= threshold) & (F.col("propertyIdA") != F.col("propertyIdB")))


def listing_groups(candidates: DataFrame, threshold: float = 0.72) -> DataFrame:
    """(groupId, propertyId): one row per linked listing, by ``connected_groups`` over ``linking_rows``."""
    groups = connected_groups(linking_rows(candidates, threshold), "propertyIdA", "propertyIdB")
    return groups.select(F.col("label").alias("groupId"), F.col("node").alias("propertyId"))
