"""Joins of many rows to one, where a few keys may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_to_one(many: DataFrame, one: DataFrame, key: str, one_key: str, *, how: str = "inner", sizes: DataFrame | None = None, most: int = 1 << 20) -> DataFrame:
    """``many`` joined to the row of ``one`` whose ``one_key`` equals its ``key``; ``how`` is inner or left.

    ``one_key`` is unique in ``one``, and no column's name is in both. Keys with more than ``most`` rows, counted first, meet their rows of ``one`` in a
    broadcast, so that they stay where they are; all others in a join that Spark plans. There are fewer such keys than rows /
    ``most``, and one row for each. ``sizes`` may be a cheaper table to count ``key`` in, if that gives no key fewer rows. NULL keys match
    nothing.
    """
    counted = (many if sizes is None else sizes).where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__h")).agg(F.count(F.lit(1)).alias("__n"))
    large = counted.where(F.col("__n") > most).select("__h")
    hot = large.collect()
    met = F.col(key) == F.col(one_key)
    if not hot:
        return many.join(one, met, how)
    named = F.broadcast(many.sparkSession.createDataFrame(hot, large.schema))
    few = F.broadcast(one.join(named, F.col(one_key) == F.col("__h"), "left_semi"))
    held = many.join(named, F.col(key) == F.col("__h"), "left_semi").join(few, met, how)
    rest = many.join(named, F.col(key) == F.col("__h"), "left_anti").join(one, met, how)
    return held.unionByName(rest)
