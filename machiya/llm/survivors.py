"""Best representative of each duplicate group, field by field, by currency reasoning.

Which of two values of a field is the later one is learned from the transitions of timestamped rows (precedence).  Within a
group, members form a partial order: by completeness, by known times, and by precedence where a time is missing.  Each
field survives from a member that nothing in the group comes after.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from machiya.plans.durable import write_table

#: Texts that stand for a missing value.
MISSING = ("", "-", "不明")
#: Transitions that a precedence needs, and their share among the transitions between its two values.
SUPPORT, MAJORITY = 3, 0.6


def stated(c: Column, kind: str) -> Column:
    """True when a value is not missing: null, NaN, zero, blank and the ``MISSING`` texts are."""
    if kind == "string":
        return c.isNotNull() & ~F.trim(c).isin(*MISSING, "0")
    if kind in ("double", "float"):
        return c.isNotNull() & ~F.isnan(c) & (c != 0)
    return c.isNotNull() & (c != 0)


def completeness(links: DataFrame) -> DataFrame:
    """(propertyId, completeness): the highest completeness that any linking row gives a listing; null counts as 0."""
    sides = F.explode(F.array(F.struct(F.col("propertyIdA").alias("propertyId"), F.col("detailCompletenessA").alias("c")), F.struct(F.col("propertyIdB").alias("propertyId"), F.col("detailCompletenessB").alias("c")))).alias("s")
    return links.select(sides).select("s.*").groupBy("propertyId").agg(F.max(F.coalesce("c", F.lit(0))).alias("completeness"))


def value_precedence(timed: DataFrame, key: str, fields: Sequence[str], time: str) -> DataFrame:
    """(field, before, after, n, reverse, verdict): which values of a field follow which, learned from timestamped rows.

    Consecutive different values of a key are transitions; ``n`` go from ``before`` to ``after`` and ``reverse`` the other
    way.  The verdict is ``kept``, or why no precedence is concluded: ``support`` (fewer than ``SUPPORT`` transitions),
    ``majority`` (a smaller share than ``MAJORITY`` of those between the two) or ``direction`` (against the overall
    direction, the share of a value's transitions that enter it; the kept ones therefore form no circle).  Rows without a
    key, value or time teach nothing; repeated rows count once.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("v")) for f in fields])).alias("c")
    long = timed.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(F.col(key).alias("k"), F.col(time).alias("t"), cells)
    rows = long.select("k", "t", "c.field", "c.v").where("v is not null").distinct()
    order = Window.partitionBy("field", "k").orderBy("t", "v")
    steps = rows.withColumn("before", F.lag("v").over(order)).where("before is not null and before <> v")
    counted = write_table(steps.groupBy("field", F.col("before").alias("a"), F.col("v").alias("b")).agg(F.count("*").alias("n")), "steps").df
    back = counted.select("field", F.col("a").alias("b"), F.col("b").alias("a"), F.col("n").alias("m"))
    ends = F.explode(F.array(F.struct(F.col("a").alias("v"), F.lit(0).alias("into")), F.struct(F.col("b").alias("v"), F.lit(1).alias("into")))).alias("e")
    flow = counted.select("field", "n", ends).groupBy("field", "e.v").agg((F.sum(F.col("n") * F.col("e.into")) / F.sum("n")).alias("late"))
    both = counted.join(back, ["field", "a", "b"], "left").withColumn("m", F.coalesce("m", F.lit(0)))
    both = both.join(flow.select("field", F.col("v").alias("a"), F.col("late").alias("late_a")), ["field", "a"]).join(flow.select("field", F.col("v").alias("b"), F.col("late").alias("late_b")), ["field", "b"])
    verdict = F.when(F.col("n") < SUPPORT, "support").when(F.col("n") < MAJORITY * (F.col("n") + F.col("m")), "majority").when(F.col("late_a") >= F.col("late_b"), "direction").otherwise("kept")
    return both.select("field", F.col("a").alias("before"), F.col("b").alias("after"), "n", F.col("m").alias("reverse"), verdict.alias("verdict"))


def value_levels(timed: DataFrame, key: str, fields: Sequence[str], time: str) -> DataFrame:
    """(field, value, level): how late a value of a field comes: the length of the longest chain of precedences up to it.

    Values without any precedence have level 0; values that never change are not listed.  Relaxed in rounds of written
    tables, as many as the longest chain has values.
    """
    known = write_table(value_precedence(timed, key, fields, time), "precedes").df
    edges = known.where("verdict = 'kept'").select("field", F.col("before").alias("a"), F.col("after").alias("b"))
    ends = F.explode(F.array("before", "after")).alias("v")
    levels = write_table(known.select("field", ends).distinct().withColumn("level", F.lit(0)), "levels")
    while True:
        up = edges.join(levels.df.select("field", F.col("v").alias("a"), "level"), ["field", "a"]).groupBy("field", F.col("b").alias("v")).agg((F.max("level") + 1).alias("up"))
        raised = levels.df.join(up, ["field", "v"], "left").select("field", "v", F.greatest("level", F.coalesce("up", F.lit(0))).alias("level"), (F.coalesce("up", F.lit(0)) > F.col("level")).alias("moved"))
        nxt = write_table(raised, "levels")
        changed = nxt.df.where("moved").limit(1).count() > 0
        levels.drop()
        levels = nxt
        if not changed:
            return levels.df.select("field", F.col("v").alias("value"), "level")


def with_levels(members: DataFrame, fields: Sequence[str], levels: DataFrame) -> DataFrame:
    """Add ``<field>_level`` to members: the level of the field's value; 0 for null and for values without precedence."""
    for f in fields:
        mine = levels.where(F.col("field") == f).select(F.col("value").alias("_v"), F.col("level").alias(f"{f}_level"))
        members = members.join(mine, F.col(f).cast("string") == F.col("_v"), "left").drop("_v").withColumn(f"{f}_level", F.coalesce(f"{f}_level", F.lit(0)))
    return members


def current_values(members: DataFrame, group: str, key: str, value: str, time: str, levels: DataFrame) -> DataFrame:
    """(group, key, value, basis): the topologically latest value of each group, and the member that has it.

    Timed members are ordered by time; a member without a time comes after another one if its value's level is higher.
    The group's latest timed value stands unless an untimed member's value comes after it.  Groups of untimed members
    take the highest level.  Equal ones go to the smallest key.  Members whose value is null take no part.  Only one
    candidate of each kind per group and task is shuffled.
    """
    rows = members.where(F.col(value).isNotNull() & F.col(group).isNotNull()).select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(value).cast("string").alias("v"), F.col(time).alias("t"))
    ranked = rows.join(levels.select(F.col("value").alias("_v"), "level"), F.col("v") == F.col("_v"), "left").withColumn("level", F.coalesce("level", F.lit(0)))
    timed, untimed = F.col("t").isNotNull(), F.col("t").isNull()
    late = F.struct((-F.unix_micros("t")).alias("o"), F.col("k"), F.col("v"), F.col("level"))
    high = F.struct((-F.col("level")).alias("o"), F.col("k"), F.col("v"), F.col("level"))
    best = ranked.groupBy("g").agg(F.min(F.when(timed, late)).alias("timed"), F.min(F.when(untimed, high)).alias("untimed"))
    after = F.col("timed").isNull() | (F.coalesce(F.col("untimed.level"), F.lit(-1)) > F.col("timed.level"))
    chosen = F.when(after, F.struct("untimed.k", "untimed.v")).otherwise(F.struct("timed.k", "timed.v"))
    return best.select(F.col("g").alias(group), chosen["k"].alias(key), chosen["v"].alias("value"), F.when(after, F.lit("precedence")).otherwise(F.lit("time")).alias("basis"))


def surviving_fields(members: DataFrame, group: str, key: str, fields: Sequence[str], complete: str, seen: str, levels: Sequence[str]) -> DataFrame:
    """(group, fieldName, stated, current, basis): the member that stands for the group (``record``) and the suppliers of each field.

    Every group is a partial order of its members: one comes after another if it is more complete (null as 0), or as
    complete and seen later, or as complete, without a time on either side, and of a later value in the columns ``levels``
    (as ``with_levels`` adds them).  Of the members that state a field, those that none comes after are candidates: the
    latest with a time, the latest without one by precedence, and the first without one by its key.  They are partial
    aggregates, so a group of any size is never gathered.  Two rules complete the order:

    * ``stated``: a missing time comes before all others, and among missing times the smallest key is taken.
    * ``current``: a member without a time comes after the timed one if its values' levels are higher; ``basis`` says
      whether completeness, time, precedence or (between equals) the key decided.

    A field that no member states has no row; null groups and keys are dropped; equal times go to the smallest key.
    """
    kinds = dict(members.dtypes)
    level = F.struct(*[(-F.col(c)).alias(c) for c in levels])
    c = (-F.coalesce(F.col(complete), F.lit(0))).alias("c")
    timed, untimed = F.col(seen).isNotNull(), F.col(seen).isNull()
    by_time = F.struct(c, (-F.unix_micros(seen)).alias("t"), F.col(key).alias("k"), level.alias("l"))
    by_level = F.struct(c, level.alias("l"), F.col(key).alias("k"))
    by_key = F.struct(c, F.col(key).alias("k"))
    rows = members.where(F.col(group).isNotNull() & F.col(key).isNotNull())
    has = {"record": F.lit(True)} | {f: stated(F.col(f), kinds[f]) for f in fields}
    ends = [F.struct(F.min(F.when(h & timed, by_time)).alias("timed"), F.min(F.when(h & untimed, by_level)).alias("late"), F.min(F.when(h & untimed, by_key)).alias("first"), F.count_if(h).alias("n")).alias(f) for f, h in has.items()]
    best = rows.groupBy(group).agg(*ends)
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("fieldName"), F.col(f).alias("m")) for f in has])).alias("x")
    long = best.select(group, cells).select(group, "x.fieldName", "x.m.*").where("n > 0")
    # costs are negated, so the smaller one comes later
    only_timed, only_untimed = F.col("late").isNull(), F.col("timed").isNull()
    less, more = F.col("late.c") > F.col("timed.c"), F.col("late.c") < F.col("timed.c")
    by_rule = F.when(only_untimed | (~only_timed & more), F.col("first.k")).otherwise(F.col("timed.k"))
    after = only_untimed | (~only_timed & (more | (~less & (F.col("late.l") < F.col("timed.l")))))
    by_order = F.when(after, F.col("late.k")).otherwise(F.col("timed.k"))
    basis = F.when(F.col("n") == 1, "only").when(~only_timed & ~only_untimed & (less | more), "completeness").when(only_timed, "time").when(only_untimed & (F.col("late.k") == F.col("first.k")), "key").when(after | only_untimed, "precedence").otherwise("time")
    return long.select(group, "fieldName", by_rule.alias("stated"), by_order.alias("current"), basis.alias("basis"))
