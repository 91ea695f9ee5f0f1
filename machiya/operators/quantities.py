"""Bringing recorded quantities to one unit: text with units, and numbers stored in another unit than their field's.

Units come from segmenting unit names (``functions.quantities``).  Which unit a bare number is in is judged by the field's
own amounts: a prior of their logarithm, learned from robust quartiles over all rows, and the odds of the unit.
"""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from machiya.functions.quantities import Field, read_statement

_PLAIN = r"^[0-9]{1,15}([.][0-9]{1,9})?$"
#: Deviations beyond which an amount's cost grows linearly: real amounts have longer tails than the normal law.
TAIL = 2.0
#: Cost of an amount that is no multiple of the field's grain.
GRAIN_COST = 3.0
#: Gain when two fields of a record then state the same amount, within this relative difference.
AGREE_GAIN, AGREE_WITHIN = 8.0, 0.10
#: Least lead of the chosen unit over the next one, as a log of odds, at which the choice is called certain.
CERTAIN = 1.0


def statement(text: Column, field: Field) -> Column:
    """Struct (amount, bare) of what a text states, in the field's base unit; null amounts where it states nothing.

    Plain ASCII numbers are read by built-in expressions; only other texts go to Python, in Arrow batches.
    """

    @F.pandas_udf("amount double, bare boolean")
    def parse(texts: pd.Series) -> pd.DataFrame:
        known: dict[str | None, tuple[float | None, bool]] = {}
        read = [known[t] if t in known else known.setdefault(t, read_statement(t, field)) for t in texts]
        return pd.DataFrame({"amount": pd.Series([a for a, _ in read], dtype="float64"), "bare": [b for _, b in read]})

    trimmed = F.trim(text)
    number = F.when(trimmed.rlike(_PLAIN), trimmed.try_cast("double"))
    plain = F.when(number > 0, F.struct((number * field.own).alias("amount"), F.lit(True).alias("bare")))
    return F.coalesce(plain, parse(F.when(plain.isNull(), text)))


def quantity(text: Column, field: Field) -> Column:
    """The quantity a text states in the field's base unit, as a column; null when it states none."""
    return statement(text, field)["amount"]


def amount_prior(df: DataFrame, amount: Column) -> DataFrame:
    """One row (center, spread): middle and deviation of the logarithm of amounts, from their quartiles.

    Quartiles are bounded sketches over all rows, and move little when some of the amounts are in another unit.  Without
    amounts both are null, which judges nothing; the spread is 0.1 at least.
    """
    q = F.percentile_approx(F.when(amount > 0, F.log(amount)), [0.25, 0.5, 0.75], 10_000)
    out = df.agg(q.alias("q"))
    return out.select(F.col("q")[1].alias("center"), F.greatest((F.col("q")[2] - F.col("q")[0]) / 1.349, F.lit(0.1)).alias("spread"))


def _cost(amount: Column, center: Column, spread: Column, grain: float) -> Column:
    z = F.abs(F.log(amount) - center) / spread
    cost = F.coalesce(F.when(z <= TAIL, z * z / 2).otherwise(TAIL * z - TAIL * TAIL / 2), F.lit(0.0))
    return cost + F.when(F.abs(amount / grain - F.round(amount / grain)) > 1e-6, GRAIN_COST).otherwise(0.0) if grain else cost


def _readings(x: Column, field: Field, center: Column, spread: Column) -> Column:
    """Array of (cost, amount, prior, odds, factor) of a number for each unit of its field; one null amount if it states nothing."""
    options = []
    for factor, odds in field.scales():
        prior = _cost(x * factor, center, spread, field.grain)
        options.append(F.struct((prior + odds).alias("cost"), (x * factor).alias("amount"), prior.alias("prior"), F.lit(odds).alias("odds"), F.lit(factor).alias("factor")))
    nothing = F.array(F.struct(F.lit(0.0).alias("cost"), F.lit(None).cast("double").alias("amount"), F.lit(0.0).alias("prior"), F.lit(0.0).alias("odds"), F.lit(None).cast("double").alias("factor")))
    return F.when((x > 0) & ~F.isnan(x), F.array(*options)).otherwise(nothing)


def common_units(df: DataFrame, key: str, texts: Mapping[str, Field]) -> DataFrame:
    """(key, fieldName, recorded, commonValue, plain, certain): each text column in its base unit, one row per distinct record.

    A unit in the text decides.  A bare number is in the field's own unit or one of its others, whichever costs least;
    ``certain`` is false if the next one costs hardly more.  Placeholders, words and zero state no quantity and give no
    row, as do null keys; repeated rows give one row; other columns are ignored.  ``plain`` is true for ASCII digits with at
    most one point in the field's own unit.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("fieldName"), F.col(n).alias("recorded")) for n in texts])).alias("c")
    long = df.where(F.col(key).isNotNull()).select(F.col(key), cells).select(key, "c.*").where(F.col("recorded").isNotNull()).distinct()
    out = None
    for name, field in texts.items():
        part = long.where(F.col("fieldName") == name).withColumn("s", statement(F.col("recorded"), field)).where("s.amount is not null")
        part = part.select(key, "fieldName", "recorded", F.col("s.amount").alias("amount"), F.col("s.bare").alias("bare"))
        if field.units:
            part = part.crossJoin(F.broadcast(amount_prior(part, F.col("amount"))))
            ranked = F.array_sort(_readings(F.col("amount") / field.own, field, F.col("center"), F.col("spread")))
            part = part.withColumn("r", F.when(F.col("bare"), ranked)).withColumn("commonValue", F.coalesce(F.col("r")[0]["amount"], "amount"))
            part = part.withColumn("certain", F.coalesce(F.try_element_at("r", F.lit(2))["cost"] - F.col("r")[0]["cost"] >= CERTAIN, F.lit(True)))
        else:
            part = part.withColumn("commonValue", F.col("amount")).withColumn("certain", F.lit(True))
        digits = F.col("recorded").rlike(r"^(?:[0-9]+[.]?[0-9]*|[.][0-9]+)$")
        part = part.select(key, "fieldName", "recorded", "commonValue", (digits & (F.abs(F.col("commonValue") - F.col("amount")) <= F.col("amount") * 1e-9)).alias("plain"), "certain")
        out = part if out is None else out.unionByName(part)
    return out


def common_scales(df: DataFrame, fields: Mapping[str, Field], center: Column, spread: Column) -> DataFrame:
    """Add ``<field>_common`` and ``<field>_certain``: number columns of one record in their base unit, units chosen jointly.

    Every assignment of units to the columns is scored: the prior of the amounts (``center`` and ``spread`` of their
    logarithm), whether they are multiples of the field's grain, the odds of the units, and the gain of agreement between
    two columns, whose common amount then counts once, as does a unit that both share.  A choice that leads the next other one by less than ``CERTAIN`` is
    not certain.  Null, NaN, zero and negative values give null.  Built-in expressions only, no shuffle.
    """
    names = list(fields)
    options = {n: _readings(F.col(n).cast("double"), fields[n], center, spread) for n in names}
    lead = lambda all_, best, at: F.coalesce(F.array_min(F.transform(F.filter(all_, lambda o: ~o[at].eqNullSafe(best[at])), lambda o: o["cost"])) - best["cost"] >= CERTAIN, F.lit(True))
    if len(names) == 1:
        n = names[0]
        picked = df.withColumn("_all", options[n]).withColumn("_pick", F.array_min("_all"))
        return picked.withColumn(f"{n}_common", F.col("_pick.amount")).withColumn(f"{n}_certain", lead(F.col("_all"), F.col("_pick"), "amount")).drop("_all", "_pick")
    a, b = names
    same = lambda x, y: F.coalesce(F.abs(x - y) <= F.greatest(x, y) * AGREE_WITHIN, F.lit(False))
    shared = lambda x, y: F.when(x["factor"] == y["factor"], F.least(x["odds"], y["odds"])).otherwise(0.0)
    joint = F.flatten(
        F.transform(
            options[a],
            lambda x: F.transform(
                options[b],
                lambda y: F.struct((x["cost"] + y["cost"] - shared(x, y) - F.when(same(x["amount"], y["amount"]), F.least(x["prior"], y["prior"]) + AGREE_GAIN).otherwise(0.0)).alias("cost"), x["amount"].alias("a"), y["amount"].alias("b")),
            ),
        )
    )
    picked = df.withColumn("_all", joint).withColumn("_pick", F.array_min("_all"))
    for n, at in ((a, "a"), (b, "b")):
        picked = picked.withColumn(f"{n}_common", F.col(f"_pick.{at}")).withColumn(f"{n}_certain", lead(F.col("_all"), F.col("_pick"), at))
    return picked.drop("_all", "_pick")
