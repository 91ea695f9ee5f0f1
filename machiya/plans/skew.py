"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more than this share of the left rows, and at least HOT_ROWS of them.
HOT_SHARE = 1 / 200
HOT_ROWS = 100_000


def hot_keys(df: DataFrame, key: str, hot_share: float = HOT_SHARE, hot_rows: int = HOT_ROWS) -> list:
    """Keys that hold more than ``hot_share`` of the rows of ``df``: at most ``1 / hot_share`` of them, by counting."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).count()
    total = df.count()
    limit = max(hot_rows, int(total * hot_share))
    if total <= limit:
        return []
    return [row[0] for row in counts.where(F.col("count") > limit).collect()]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "left",
    hot_share: float = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
    hot: list | None = None,
) -> DataFrame:
    """Join ``left`` to ``right``, in which ``right_key`` is unique, without sending a hot key to one task.

    Rows of a hot left key meet their single right row by a broadcast of at most ``1 / hot_share`` rows; all others go
    through an ordinary shuffled join.  ``left`` should be a written table, since its keys are counted first; a loop may
    count them once and pass them as ``hot``.  Column names of both sides must differ.  Null keys match nothing.
    """
    if hot is None:
        hot = hot_keys(left, left_key, hot_share, hot_rows)
    if not hot:
        return left.join(right, F.col(left_key) == F.col(right_key), how)
    is_hot = F.coalesce(F.col(left_key).isin(hot), F.lit(False))
    few = F.broadcast(right.where(F.col(right_key).isin(hot)))
    plain = left.where(~is_hot).join(right, F.col(left_key) == F.col(right_key), how)
    return plain.unionByName(left.where(is_hot).join(few, F.col(left_key) == F.col(right_key), how))
