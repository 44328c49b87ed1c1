"""Places in a total order, over all partitions and within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylode.session import cut


def positions(df: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    """``df`` with ``out``: 1 for the first row in ``order``, and so on, over all partitions.

    ``order`` should be total. Rows are sorted by range, never in one task; ties go to one of the orders.
    """
    ordered = cut(df.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("__at", F.monotonically_increasing_id())
    part = F.shiftright("__at", 33).cast("int")
    sizes = ordered.groupBy(part.alias("part")).count().collect()
    before, starts = 0, {}
    for r in sorted(sizes, key=lambda r: r.part):
        starts[r.part] = before
        before += r["count"]
    table = F.array(*[F.lit(starts.get(p, 0)).cast("bigint") for p in range(max(starts, default=0) + 1)])
    place = table[part] + F.col("__at").bitwiseAND((1 << 33) - 1) + 1
    return ordered.select(*[F.col(f"`{c}`") for c in df.columns if c != out], place.alias(out))


def places_in_group(df: DataFrame, group: str, order: str, place: str, size: str, *, most: int = 1 << 20) -> DataFrame:
    """``df`` with ``place``, 0 for the first row of its ``group`` in ``order`` and so on, and ``size``, the group's number of rows.

    A window sorts each group in one task, which groups of up to ``most`` rows allow. Those with more, counted first, are sorted by
    range over all tasks instead, and a row's place is its position less that of its group's first row. There are fewer of
    them than rows / ``most``, so they may be broadcast. NULL is a group of its own.
    """
    w = Window.partitionBy(group)
    by_window = lambda rows: rows.withColumns({place: (F.row_number().over(w.orderBy(order)) - 1).cast("bigint"), size: F.count(F.lit(1)).over(w)})
    large = df.groupBy(F.col(group).alias("__g")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > most).select("__g")
    hot = large.collect()
    if not hot:
        return by_window(df)
    named = F.broadcast(df.sparkSession.createDataFrame(hot, large.schema))
    same = F.col(group).eqNullSafe(F.col("__g"))
    ranked = positions(df.join(named, same, "left_semi"), [F.col(group), F.col(order)], place)
    first = ranked.groupBy(F.col(group).alias("__g")).agg(F.min(place).alias("__first"), F.count(F.lit(1)).alias("__n"))
    placed = ranked.join(F.broadcast(first), same).withColumns({place: F.col(place) - F.col("__first"), size: F.col("__n")}).drop("__g", "__first", "__n")
    return by_window(df.join(named, same, "left_anti")).unionByName(placed)
