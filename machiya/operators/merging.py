"""Folding several rows of one key into one, by a policy per field; representatives; distinct fingerprints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def merge_records(df: DataFrame, keys: Sequence[str], order: Sequence[Column], policy: Mapping[str, str], usable: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per key; each field by its rule: latest, earliest (usable value), newest (null included), max, min, count.

    ``order`` ranks the rows of a key from old to new and should be total.  All rules are partial aggregates.
    """
    usable = usable or {}
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    packed = df.withColumn("_rank", rank)

    def rule(field: str, kind: str) -> Column:
        ok, c = usable.get(field, F.col(field).isNotNull()), F.col(field)
        if kind == "latest":
            return F.max_by(F.when(ok, c), F.when(ok, F.col("_rank")))
        if kind == "earliest":
            return F.min_by(F.when(ok, c), F.when(ok, F.col("_rank")))
        if kind == "newest":
            return F.max_by(c, F.col("_rank"))
        return {"max": F.max, "min": F.min, "count": F.count}[kind](F.when(ok, c))

    return packed.groupBy(*keys).agg(*[rule(f, k).alias(f) for f, k in policy.items()])


def representatives(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """The best row of each key by ``order`` (greatest first) with ``members``, the number of rows."""
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*columns), rank).alias("_b"), F.count("*").alias("members"))
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in columns], "members")


def marked_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """All rows, with ``duplicateOfFirst`` true for those that do not lead their key; rows of null keys lead themselves."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return df.withColumn("duplicateOfFirst", known & (rank > 1))


def distinct_fingerprints(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row by ``order`` of each distinct combination of columns; nulls are equal."""
    first = F.min_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(F.xxhash64(F.to_json(F.struct(*columns))).alias("_f"), *columns).agg(first.alias("_r")).select("_r.*")


def latest_previous_union(previous: DataFrame, current: DataFrame, key: str, first_seen: str, last_seen: str, status: str, now: Column) -> DataFrame:
    """Upsert: matched rows keep their first time, new rows are inserted, previous rows not in ``current`` are missing."""
    p = previous.select(F.col(key).alias("_k"), F.col(first_seen).alias("_first"), *[F.col(c).alias(f"_p_{c}") for c in previous.columns if c not in (key, first_seen)])
    both = current.join(p, F.col(key) == F.col("_k"), "full_outer")
    fresh = F.col(key).isNotNull()
    out = [F.coalesce(key, "_k").alias(key), F.coalesce("_first", first_seen, now).alias(first_seen)]
    for c in current.columns:
        if c == status:
            out.append(F.when(fresh, F.col(c)).otherwise(F.lit("missing")).alias(c))
        elif c == last_seen:
            out.append(F.when(fresh, F.coalesce(F.col(c), now)).otherwise(F.col(f"_p_{c}")).alias(c))
        elif c not in (key, first_seen):
            out.append(F.coalesce(F.col(c), F.col(f"_p_{c}")).alias(c) if f"_p_{c}" in both.columns else F.col(c))
    return both.select(*out)
