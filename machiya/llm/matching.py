"""Records of the same things in two tables without a key: noisy attributes, belief propagation, match probabilities.

Agreement of two records is a pattern of levels (place, areas, year).  What a level weighs is learned from the patterns of
all candidates by expectation maximization; candidates are binary variables between one-to-one factors, settled by loopy
belief propagation through joins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from machiya.plans.durable import write_table
from machiya.plans.skew import hot_keys, lookup_join

#: Agreement levels: (largest difference, log-likelihood ratio before learning); areas differ relatively, years absolutely.
AREA_LEVELS = ((0.002, 4.0), (0.012, 3.0), (0.022, 1.0), (0.035, -3.0))
YEAR_LEVELS = ((0.0, 2.5), (1.0, 1.2), (2.0, -1.5))
AREA_APART, YEAR_APART = -6.0, -4.0
#: Log odds of a candidate before its areas and year, before learning: one house number, one 丁目, one place without a
#: number on a side, different 丁目, no place on a side.
WHERE = (1.0, -4.5, -6.0, -14.0, -8.5)
NUMBER, DISTRICT, PLACE, OTHER_DISTRICT, UNPLACED = range(5)
#: Pseudo-candidates by which learned weights are held to the ones before learning, and rounds of learning.
HELD_BY, LEARN_ROUNDS = 50.0, 25
#: Width of the area classes by which records without a house number meet, as a relative step.
CLASS_STEP = 0.03
#: The change of log odds at which messages are settled, damping, rounds after which damping grows, the belief that matches.
SETTLED, DAMPING, PATIENCE, BELIEF = 1e-2, 0.1, 12, 0.5
#: Candidates weaker than this log score are dropped: messages only lower a belief, so none of them can reach ``BELIEF``.
FLOOR = -4.0
#: Evidence at which a record without a house number is a further record of a house of its own table: both areas agree.
SAME_HOUSE = 6.9

_FIELDS = {"land": (AREA_LEVELS, AREA_APART), "building": (AREA_LEVELS, AREA_APART), "year": (YEAR_LEVELS, YEAR_APART)}
#: Weights by field and level, and of the places, before learning.
TYPED = {f: [w for _, w in levels] + [apart] for f, (levels, apart) in _FIELDS.items()}


def _apart(x: Column, y: Column) -> Column:
    return F.abs(x - y) / F.greatest(x, y)


def _level(difference: Column, levels: Sequence[tuple[float, float]]) -> Column:
    """Number of the first level that a difference is within, their number if none is; -1 for an unknown one."""
    out = F.when(difference.isNull(), -1)
    for i, (most, _) in enumerate(levels):
        out = out.when(difference <= most, i)
    return out.otherwise(len(levels))


def _weighed(weights: dict[str, list[float]]) -> Column:
    """Summed weights of a candidate's levels; unknown ones say nothing."""
    total = F.lit(0.0)
    for f, ws in weights.items():
        total = total + F.coalesce(F.try_element_at(F.array(*[F.lit(float(w)) for w in ws]), F.when(F.col(f) >= 0, F.col(f) + 1)), F.lit(0.0))
    return total


def _classes(x: Column, around: bool) -> Column:
    at = F.floor(F.log(x) / math.log1p(CLASS_STEP))
    return F.when(x > 0, F.array(at - 1, at, at + 1) if around else F.array(at))


def _blocks(by: Sequence[str], right: bool) -> Column:
    """Keys on which a record meets candidates.

    ``n``: one place and number; ``a`` and ``b``: one place and near areas, where the left or the right record lacks a
    number; ``v`` and ``w``: near areas of both kinds, where the left or the right record has no place.
    """
    placed, numbered = F.col("place").isNotNull(), F.col("place").isNotNull() & F.col("number").isNotNull()
    key = lambda kind, *parts: F.concat_ws("\x1f", F.lit(kind), *[F.col(b) for b in by], *[p.cast("string") for p in parts])
    close = lambda name: F.transform(_classes(F.col(name[1:]), right), lambda c: key(name, F.col("place"), c))
    near = lambda kind: [close(kind + area) for area in ("land", "building")]
    both = lambda kind: F.flatten(F.transform(_classes(F.col("land"), right), lambda x: F.transform(_classes(F.col("building"), right), lambda y: key(kind, x, y))))
    none = F.array().cast("array<string>")
    lists = [F.when(numbered, F.array(key("n", F.col("place"), F.col("number"))))]
    lists += [F.when(placed if right else placed & ~numbered, x) for x in near("a")] + [F.when(placed & ~numbered if right else numbered, x) for x in near("b")]
    lists += [F.when(F.lit(True) if right else ~placed, both("v")), F.when(~placed if right else placed, both("w"))]
    return F.flatten(F.array(*[F.coalesce(x, none) for x in lists]))


def agreement(pairs: DataFrame) -> DataFrame:
    """Add where, land, building and year: the levels of agreement of pairs with ``l_`` and ``r_`` columns of both records."""
    unplaced = F.col("l_place").isNull() | F.col("r_place").isNull() | (F.col("l_place") != F.col("r_place"))
    where = (
        F.when(unplaced, UNPLACED).when(F.col("l_number") == F.col("r_number"), NUMBER).when(F.col("l_district") == F.col("r_district"), DISTRICT)
        .when(F.col("l_district") != F.col("r_district"), OTHER_DISTRICT).otherwise(PLACE)
    )
    levels = {f: _level(F.abs(F.col("l_year") - F.col("r_year")) if f == "year" else _apart(F.col(f"l_{f}"), F.col(f"r_{f}")), ls) for f, (ls, _) in _FIELDS.items()}
    return pairs.select("*", where.alias("where"), *[c.alias(f) for f, c in levels.items()])


def candidates(left: DataFrame, right: DataFrame, by: Sequence[str] = (), floor: float | None = FLOOR) -> DataFrame:
    """(lid, rid, where, land, building, year, score): candidate pairs with their levels of agreement and log score.

    Both sides have id, place, number, district, land, building, year (any but the id may be null; several rows per id give
    alternatives, of which a pair keeps the strongest); ``by`` are further columns that must be equal.  Records meet on
    equal keys only (``_blocks``), in one join; a key that holds very many rows is split by AQE's skew join.
    """
    names = ["id", "place", "number", "district", "land", "building", "year"]
    side = lambda df, n, right: df.withColumn("_key", F.explode(_blocks(by, right))).select("_key", *[F.col(c).alias(f"{n}_{c}") for c in names])
    met = side(left, "l", False).join(side(right, "r", True), "_key")
    pairs = agreement(met).select(F.col("l_id").alias("lid"), F.col("r_id").alias("rid"), "where", *_FIELDS)
    score = F.try_element_at(F.array(*[F.lit(w) for w in WHERE]), F.col("where") + 1) + _weighed(TYPED)
    best = pairs.groupBy("lid", "rid").agg(F.max(F.struct(score.alias("score"), F.col("where"), *[F.col(f) for f in _FIELDS])).alias("b"))
    out = best.select("lid", "rid", "b.where", *[f"b.{f}" for f in _FIELDS], "b.score")
    return out if floor is None else out.where(F.col("score") >= floor)


def learned_weights(pairs: DataFrame, houses: int | None = None) -> tuple[dict[str, list[float]], list[float]]:
    """(weights of the levels of one house number, log odds of the places), learned from the candidates.

    A record without a place may be any of the ``houses`` of the other table, so those are its odds before evidence.

    Expectation maximization over the counts of agreement patterns (at most some hundred, whatever the number of pairs):
    how often a level occurs among matches and among others, and how often pairs of one house number match.  All is learned
    from the pairs of one number: the others were brought together by their areas, so that their levels and odds would say
    that areas agree among non-matches too; they keep their weights and odds before learning.  Counts start from, and are held by
    ``HELD_BY`` pseudo-candidates to, the weights before learning; unknown levels take no part.
    """
    rows = pairs.where(F.col("where") == NUMBER).groupBy(*_FIELDS).count().collect()
    n = np.array([r["count"] for r in rows], dtype=float)
    level = {f: np.array([r[f] for r in rows], dtype=int) for f in _FIELDS}
    weights, places = {f: list(ws) for f, ws in TYPED.items()}, list(WHERE)
    if houses is not None:
        places[UNPLACED] = -math.log(houses + 1)
    for _ in range(LEARN_ROUNDS if rows else 0):
        score = places[NUMBER] + sum(np.where(level[f] >= 0, np.array(weights[f])[np.maximum(level[f], 0)], 0.0) for f in _FIELDS)
        match = 1 / (1 + np.exp(-np.clip(score, -40, 40)))
        for f in _FIELDS:
            at, size = level[f] >= 0, len(TYPED[f])
            seen = np.bincount(level[f][at], weights=n[at], minlength=size) + 1.0
            share, lean = seen / seen.sum(), np.exp(np.array(TYPED[f]) / 2)
            counts = []
            for r, held in ((match, share * lean), (1 - match, share / lean)):
                c = np.bincount(level[f][at], weights=(n * r)[at], minlength=size) + HELD_BY * held / held.sum()
                counts.append(c / c.sum())
            weights[f] = np.log(counts[0] / counts[1]).tolist()
        p = ((n * match).sum() + HELD_BY / (1 + math.exp(-WHERE[NUMBER]))) / (n.sum() + HELD_BY)
        places[NUMBER] = math.log(p) - math.log1p(-min(p, 1 - 1e-9))
    return weights, places


def rescored(pairs: DataFrame, weights: tuple, floor: float | None = FLOOR) -> DataFrame:
    """``pairs`` with the score by ``learned_weights``."""
    levels, places = weights
    score = F.try_element_at(F.array(*[F.lit(float(w)) for w in places]), F.col("where") + 1) + F.when(F.col("where") == NUMBER, _weighed(levels)).otherwise(_weighed(TYPED))
    out = pairs.withColumn("score", score)
    return out if floor is None else out.where(F.col("score") >= floor)


def _factor(state: DataFrame, side: str, message: Column, hot: list) -> DataFrame:
    """Add ``other``: log(1 + summed odds of the side's other candidates), the weight of matching elsewhere or nowhere.

    The sums are partial aggregates; a record in very many candidates meets its sum by broadcast.
    """
    sums = state.groupBy(F.col(side).alias("_id")).agg(F.sum(F.exp(message)).alias("_sum"))
    joined = lookup_join(state, sums, side, "_id", "inner", hot=hot)
    return joined.withColumn("other", F.log1p(F.greatest(F.col("_sum") - F.exp(message), F.lit(0.0)))).drop("_id", "_sum")


def match_probabilities(pairs: DataFrame) -> DataFrame:
    """(lid, rid, score, probability, message, settled): marginal probability that a pair is a match under one-to-one factors.

    Loopy belief propagation.  Every candidate is a binary variable with its log score as potential; every record of
    either side is a factor that admits at most one match.  The message of a factor to a candidate is minus the log of
    one plus the summed odds of its other candidates, each odds taken from the score and the other factor's message.
    A candidate whose two records have no other has no message and is left out of the rounds.  Messages are columns of the
    pair table, exchanged through a shuffle per side and round, and damped; rounds end when no message moves by more than
    ``SETTLED``.  After ``PATIENCE`` rounds the steps shrink, so that messages that would swing come to rest at their mean;
    ``settled`` is false for a pair whose undamped messages still differ there.  Each round is a written table.
    """
    base = write_table(pairs.select("lid", "rid", "score"), "candidates").df
    hot = {side: hot_keys(base, side) for side in ("lid", "rid")}
    counted = base
    for side in ("lid", "rid"):
        sizes = base.groupBy(F.col(side).alias("_id")).agg(F.count("*").alias(f"{side}_n"))
        counted = lookup_join(counted, sizes, side, "_id", "inner", hot=hot[side]).drop("_id")
    counted = write_table(counted, "candidates").df
    alone = (F.col("lid_n") == 1) & (F.col("rid_n") == 1)
    zero = F.lit(0.0)
    state = write_table(counted.where(~alone).select("lid", "rid", "score", zero.alias("from_l"), zero.alias("from_r"), zero.alias("change"), zero.alias("gap")), "messages")
    rounds = 0
    while True:
        step = (1 - DAMPING) / (1 + max(0, rounds - PATIENCE) / 4)
        moved = lambda old, step=step: F.col(old) + (-F.col("other") - F.col(old)) * step
        off = lambda old: F.abs(-F.col("other") - F.col(old))
        one = _factor(state.df, "lid", F.col("score") + F.col("from_r"), hot["lid"]).select("*", moved("from_l").alias("next_l"), off("from_l").alias("off_l")).drop("other")
        two = _factor(one, "rid", F.col("score") + F.col("next_l"), hot["rid"]).select("*", moved("from_r").alias("next_r"), off("from_r").alias("off_r"))
        change = F.greatest(F.abs(F.col("next_l") - F.col("from_l")), F.abs(F.col("next_r") - F.col("from_r")))
        nxt = write_table(two.select("lid", "rid", "score", F.col("next_l").alias("from_l"), F.col("next_r").alias("from_r"), change.alias("change"), F.greatest("off_l", "off_r").alias("gap")), "messages")
        state.drop()
        state = nxt
        rounds += 1
        if (state.df.agg(F.max("change")).first()[0] or 0.0) <= SETTLED:
            break
    met = state.df.select("lid", "rid", "score", (F.col("from_l") + F.col("from_r")).alias("message"), (F.col("gap") <= 10 * SETTLED).alias("settled"))
    out = counted.where(alone).select("lid", "rid", "score", zero.alias("message"), F.lit(True).alias("settled")).unionByName(met)
    return out.select("lid", "rid", "score", (1 / (1 + F.exp(-(F.col("score") + F.col("message"))))).alias("probability"), "message", "settled")


def house_clusters(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add ``house``: records of one table at one place and number whose areas and years go together are one house.

    Within a house number, records are ordered by land area and, for those without one, by building area; a gap of more
    than an area's usual spread begins another house.  Records without a number are houses of their own.  A record
    whose land is missing joins the house with the nearest building area.  ``by`` are columns that tell tables apart.
    """
    at = [*by, "place", "number"]
    keyed = records.where("number is not null and place is not null")
    spread = 0.035
    along = Window.partitionBy(*at).orderBy("land")
    # over the distinct areas of a house number, so that many records of one house count once
    areas = keyed.where("land is not null").select(*at, "land").distinct()
    before = F.lag("land").over(along)
    stepped = areas.withColumn("step", F.when(before.isNull() | ((F.col("land") - before) > spread * F.col("land")), 1).otherwise(0))
    steps = stepped.withColumn("no", F.sum("step").over(along.rowsBetween(Window.unboundedPreceding, 0))).drop("step")
    numbered = write_table(keyed.join(steps, [*at, "land"]), "numbered").df
    # houses with the middle of their building areas, for records without land
    known = numbered.groupBy(*at, "no").agg(F.percentile_approx("building", 0.5).alias("mid"), F.max("year").alias("mid_year"))
    lacking = keyed.where("land is null")
    joined = lacking.join(known, at, "left")
    gap = F.coalesce(_apart(F.col("building"), F.col("mid")), F.lit(0.03)) + F.coalesce(F.abs(F.col("year") - F.col("mid_year")) * 0.01, F.lit(0.005))
    best = joined.groupBy(*records.columns).agg(F.min(F.struct(gap.alias("gap"), F.col("no"))).alias("b"))
    fits = F.when(F.col("b.gap") <= 0.06, F.col("b.no"))
    # without a fit, nearly equal building areas are one house
    placed = best.select(*records.columns, F.coalesce(fits.cast("string"), F.concat(F.lit("b"), F.coalesce(F.round(F.col("building") / 4).cast("string"), F.lit("")))).alias("no"))
    members = write_table(numbered.select(*records.columns, F.col("no").cast("string").alias("no")).unionByName(placed), "members").df
    names = members.groupBy(*at, "no").agg(F.min("id").alias("house"))
    named = members.join(names, [*at, "no"]).select(*records.columns, "house")
    single = records.where("number is null or place is null").select(*records.columns, F.col("id").alias("house"))
    return named.unionByName(single)


def joined_houses(clustered: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``clustered`` with records that lack a house number put to the house of their own table that they describe.

    Such a record joins the numbered house with the strongest evidence if that reaches ``SAME_HOUSE``, ties going to the
    smallest id.  Without one, it takes the smallest id among itself and the other such records that reach it.  No two
    numbered houses are ever joined; ``by`` are columns that tell tables apart.
    """
    by = list(by)
    clustered = write_table(clustered, "clustered").df
    values = write_table(house_values(clustered, by).where("place is not null and land is not null and building is not null"), "values").df
    near = candidates(values, values.where("number is null"), by).where("lid <> rid")
    evidence = F.col("score") - F.try_element_at(F.array(*[F.lit(WHERE[PLACE] if w in (DISTRICT, OTHER_DISTRICT) else x) for w, x in enumerate(WHERE)]), F.col("where") + 1)
    numbered = values.groupBy(F.col("id").alias("lid")).agg(F.max(F.col("number").isNotNull().cast("int")).alias("has"))
    strong = near.where(F.col("where").isin(DISTRICT, PLACE, OTHER_DISTRICT) & (evidence >= SAME_HOUSE)).join(numbered, "lid")
    named = F.min_by("lid", F.when(F.col("has") == 1, F.struct((-F.col("score")).alias("s"), F.col("lid"))))
    target = strong.groupBy("rid").agg(F.coalesce(named, F.least("rid", F.min("lid"))).alias("target"))
    moved = clustered.join(target, F.col("house") == F.col("rid"), "left")
    return moved.select(*[c for c in clustered.columns if c != "house"], F.coalesce("target", "house").alias("house"))


def house_values(clustered: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per house and place (id, place, number, district, land, building, year): medians of the records' values."""
    return clustered.groupBy(*by, F.col("house").alias("id"), "place", "number").agg(F.max("district").alias("district"), *[F.percentile_approx(c, 0.5).alias(c) for c in ("land", "building", "year")])
