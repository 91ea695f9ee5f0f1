"""Ladders, tri-state checks, labels and lists of what is missing, with the rules as arguments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(steps: Sequence[tuple[Column, Column]], otherwise: Column) -> Column:
    """The outcome of the first step whose condition is true; unknown conditions are passed over."""
    out = otherwise
    for condition, outcome in reversed(steps):
        out = F.when(condition, outcome).otherwise(out)
    return out


def at_most(x: Column, limit: float | None) -> Column:
    """Tri-state: true, false, or null when x is unknown; true without a limit."""
    return F.lit(True) if limit is None else x <= limit


def at_least(x: Column, limit: float | None) -> Column:
    """Tri-state: true, false, or null when x is unknown; true without a limit."""
    return F.lit(True) if limit is None else x >= limit


def one_of(x: Column, allowed: Sequence[str]) -> Column:
    """Tri-state membership; true without a list."""
    return x.isin(*allowed) if allowed else F.lit(True)


def verdict(flags: Mapping[str, Column]) -> Column:
    """Struct (status, failed, unknown): excluded if any flag is false, else pending if any is null, else matched."""
    names = [F.struct(F.lit(n).alias("name"), c.alias("flag")) for n, c in flags.items()]
    all_flags = F.array(*names)
    failed = F.transform(F.filter(all_flags, lambda x: ~x["flag"]), lambda x: x["name"])
    unknown = F.transform(F.filter(all_flags, lambda x: x["flag"].isNull()), lambda x: x["name"])
    status = F.when(F.size(failed) > 0, "excluded").when(F.size(unknown) > 0, "pending").otherwise("matched")
    return F.struct(status.alias("status"), failed.alias("failed"), unknown.alias("unknown"))


def labels(conditions: Mapping[str, Column]) -> Column:
    """Names of the conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]))


def missing_names(values: Mapping[str, Column]) -> Column:
    """Names of the values that are null, in order."""
    return labels({n: c.isNull() for n, c in values.items()})


def weighted_mean(parts: Sequence[tuple[Column, float]]) -> Column:
    """Mean of the parts that are not null, their weights renormalized; null if none is."""
    total = sum((F.when(c.isNotNull(), F.lit(w)).otherwise(0.0) for c, w in parts), F.lit(0.0))
    return F.try_divide(sum((F.coalesce(c * w, F.lit(0.0)) for c, w in parts), F.lit(0.0)), F.nullif(total, F.lit(0.0)))


def clamp(x: Column, low: float, high: float) -> Column:
    """x within [low, high]; null stays null."""
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(high)), F.lit(low)))


def term_points(text: Column, points: Mapping[str, float]) -> Column:
    """Sum of the points of the terms that occur in a text; 0 for null."""
    return sum((F.when(text.contains(t), F.lit(float(p))).otherwise(0.0) for t, p in points.items()), F.lit(0.0))


def tiered_key(tiers: Sequence[tuple[str, Sequence[Column]]], extra: Column, prefix: str = "property:", length: int = 24) -> Column:
    """Struct (key, tier) of the first tier whose parts are all non-empty; nulls if none is.

    The key hashes the tier's name, its parts and ``extra`` joined by bars, so equal parts of different tiers differ.
    """
    out = F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("tier"))
    for name, parts in reversed(tiers):
        full = F.lit(True)
        for p in parts:
            full = full & (F.coalesce(p, F.lit("")) != "")
        raw = F.concat_ws("|", F.lit(name), *[F.coalesce(p, F.lit("")) for p in parts], F.coalesce(extra, F.lit("")))
        out = F.when(full, F.struct(F.concat(F.lit(prefix), F.substring(F.sha2(raw, 256), 1, length)).alias("key"), F.lit(name).alias("tier"))).otherwise(out)
    return out


def identity_record(keys: Sequence[tuple[str, Column]], fallback: Column, aliases: Sequence[Column], prefix: str = "candidate:", length: int = 24) -> Column:
    """Struct (key, kind, aliases): the first key that is known and its kind, else a hash of ``fallback`` as ``candidate``.

    Aliases are the chosen key, all known keys and the given ones, each once in this order; null and blank ones are none.
    """
    named = [(kind, F.when(F.trim(c) != "", c)) for kind, c in keys] + [("candidate", F.concat(F.lit(prefix), F.substring(F.sha2(F.coalesce(fallback, F.lit("")), 256), 1, length)))]
    key = F.coalesce(*[c for _, c in named])
    kind = F.coalesce(*[F.when(c.isNotNull(), F.lit(k)) for k, c in named])
    others = [c for _, c in named[:-1]] + [F.when(F.trim(c) != "", c) for c in aliases]
    return F.struct(key.alias("key"), kind.alias("kind"), F.array_distinct(F.array_compact(F.array(key, *others))).alias("aliases"))
