"""Places over all partitions and in groups, with groups too large for one task."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from skylode.operators.order import places_in_group, positions
from skylode.sources import store


def test_positions(spark):
    rows = list(range(5000))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(r, "x") for r in rows], "v int, w string")
    assert all(r.position == r.v + 1 and r.w == "x" for r in positions(df, [F.col("v")]).collect())
    assert positions(df.limit(0), [F.col("v")]).collect() == []


@pytest.mark.parametrize("most", [1 << 20, 300, 1])
def test_places_in_group(spark, most):
    """The same whether groups are sorted by a window or by range: a hot group, a NULL group, single rows."""
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), i, "p") for i in range(3000)] + [("one", 1, "p")]
    rng.shuffle(rows)
    want = {}
    for g in {r[0] for r in rows}:
        mine = sorted(r[1] for r in rows if r[0] == g)
        want |= {(g, v): (i, len(mine)) for i, v in enumerate(mine)}
    df = spark.createDataFrame(rows, "g string, v int, place string")
    got = places_in_group(df, "g", "v", "place", "size", most=most).collect()
    assert len(got) == len(rows) and {(r.g, r.v): (r.place, r.size) for r in got} == want
    assert places_in_group(df.limit(0), "g", "v", "place", "size", most=most).collect() == []


def test_numbered_segments_of_a_hot_source(spark):
    df = spark.createDataFrame([(1, i) for i in range(500)] + [(2, 7)], "source long, at int")
    for most in (10, 1 << 20):
        got = {(r.source, r["at"]): (r.shot_index, r.continuous_move) for r in store.number_segments(df, "source", "at", most=most).collect()}
        assert got == {(1, i): (i, 0) for i in range(500)} | {(2, 7): (0, 1)}
