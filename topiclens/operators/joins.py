"""Joins of many rows with a table of one row per key, when few keys may hold much of the rows.

A key with more than ``HOT_SHARE`` of the counted rows is hot; there are fewer than 1 / ``HOT_SHARE`` of
them, so their right rows are broadcast with that proven bound and the left rows stay where they are.
All other keys are joined by shuffle, where no key is large.  Keys are counted with partial sums, so a
hot key costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

HOT_SHARE = 1 / 1024


def key_counts(left: DataFrame, key: str) -> DataFrame:
    """``(key, _n)``: the rows of every key that is not null, a written table."""
    return materialize(left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "key_counts")


def hot_keys(left: DataFrame, key: str, share: float = HOT_SHARE, counts: DataFrame | None = None) -> DataFrame:
    """The keys with more than ``share`` of the rows (and more than one row); fewer than ``1 / share``.

    ``counts``: the rows per key, where :func:`key_counts` has been called already."""
    counts = key_counts(left, key) if counts is None else counts
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.filter(F.col("_n") > max(1.0, share * total)).select(key)


def split(left: DataFrame, right: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``(hot left, hot right, cold left, cold right)``."""
    few = F.broadcast(hot)
    return (left.join(few, key, "left_semi"), right.join(few, key, "left_semi"),
            left.join(few, key, "left_anti"), right.join(few, key, "left_anti"))


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", share: float = HOT_SHARE,
                counts: DataFrame | None = None) -> DataFrame:
    """``left`` joined with ``right`` (one row per key) by ``key``; ``how`` is ``inner`` or ``left``.

    Rows of ``left`` with a null key match nothing; a left join keeps them without shuffling them.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    hot_left, hot_right, cold_left, cold_right = split(left, right, key, materialize(hot_keys(left, key, share, counts), "hot_keys"))
    some = cold_left.filter(F.col(key).isNotNull())
    out = hot_left.join(F.broadcast(hot_right), key, how).unionByName(some.join(cold_right, key, how))
    if how == "left":
        none = left.filter(F.col(key).isNull())
        extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
        out = out.unionByName(none.select("*", *extra))
    return out
