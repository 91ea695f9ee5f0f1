"""Readings of full snapshots, and what changed between consecutive ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Field name of the cell that says a key is in the snapshot at all.
PRESENT = "\u0000present"


def latest_readings(df: DataFrame, keys: Sequence[str], seen: str, columns: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the columns of the row with the latest ``seen`` (null counts as earliest).

    Equal times are settled by the greatest column values, so the result does not depend on row order; rows that are
    equal throughout are one reading.  Null keys are keys like others.  Rows are pre-aggregated before the shuffle, so
    a key that holds a large share of the rows sends one row per task.
    """
    columns = [c for c in columns if c not in keys]
    packed = F.struct(F.col(seen).isNotNull(), F.col(seen), *[F.col(c) for c in columns])
    best = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    out = [F.col(k) for k in keys]
    return best.select(*out, *[F.col(f"_best.{c}").alias(c) for c in columns])


def snapshot_changes(
    readings: DataFrame, sequence: str, key: str, fields: Mapping[str, Column] | Sequence[str]
) -> DataFrame:
    """Compare each snapshot with the one before: (``sequence``, ``key``, changeKind, changedFields).

    ``readings`` has one row per snapshot and key; ``fields`` are the compared columns or name -> expression.  Every
    reading becomes signed cells (key, field, value): +1 for the snapshot it is in, -1 for the next one, with one more
    cell for the key's presence.  Cells whose signs cancel are equal on both sides; what is left says all.  Values
    compare as text, null is a value of its own.  The snapshot before is the next smaller number that occurs, so a
    missing delivery is bridged; the first one gives no rows.  An empty table gives no rows; null keys or numbers are
    dropped.
    """
    if not isinstance(fields, Mapping):
        fields = {f: F.col(f) for f in fields}
    readings = readings.where(F.col(sequence).isNotNull() & F.col(key).isNotNull())
    numbers = readings.select(F.col(sequence).alias("_n")).distinct()
    # one row per snapshot number: pairs of neighbours, from a single sorted array of numbers
    order = numbers.agg(F.sort_array(F.collect_list("_n")).alias("_all"))
    steps = order.select(
        F.explode(F.transform(F.col("_all"), lambda x, i: F.struct(x.alias("_this"), F.try_element_at(F.col("_all"), (i + 2).cast("int")).alias("_next"), (i > 0).alias("_later")))).alias("s")
    ).select("s.*")
    cells = F.array(
        F.struct(F.lit(PRESENT).alias("field"), F.lit(None).cast("string").alias("value")),
        *[F.struct(F.lit(n).alias("field"), c.cast("string").alias("value")) for n, c in fields.items()],
    )
    signed = F.array(
        F.when(F.col("_later"), F.struct(F.col("_this").alias("at"), F.lit(1).alias("sign"))),
        F.when(F.col("_next").isNotNull(), F.struct(F.col("_next").alias("at"), F.lit(-1).alias("sign"))),
    )
    long = (
        readings.select(F.col(sequence).alias("_seq"), F.col(key).alias("_key"), cells.alias("_cells"))
        .join(F.broadcast(steps), F.col("_seq") == F.col("_this"))
        .select("_key", F.explode(F.array_compact(signed)).alias("_side"), "_cells")
        .select("_key", F.col("_side.at").alias("_at"), F.col("_side.sign").alias("_sign"), F.explode("_cells").alias("_cell"))
        .select("_key", "_at", "_sign", F.col("_cell.field").alias("_field"), F.col("_cell.value").alias("_value"))
    )
    left = long.groupBy("_at", "_key", "_field", "_value").agg(F.sum("_sign").alias("_sum")).where(F.col("_sum") != 0)
    per_key = left.groupBy("_at", "_key").agg(
        F.max(F.when(F.col("_field") == PRESENT, F.col("_sum"))).alias("_mark"),
        F.array_sort(F.collect_set(F.when(F.col("_field") != PRESENT, F.col("_field")))).alias("_fields"),
    )
    kind = F.when(F.col("_mark") > 0, F.lit("added")).when(F.col("_mark") < 0, F.lit("removed")).otherwise(F.lit("changed"))
    return per_key.select(
        F.col("_at").alias(sequence),
        F.col("_key").alias(key),
        kind.alias("changeKind"),
        F.when(F.col("_mark").isNull(), F.col("_fields")).otherwise(F.array().cast("array<string>")).alias("changedFields"),
    )
