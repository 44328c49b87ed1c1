"""Joins to one with keys that hold most rows."""

from __future__ import annotations

import random

import pytest

from skylode.operators.joins import join_to_one


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("most", [1 << 20, 100, 0])
def test_the_same_for_hot_keys(spark, how, most):
    rng = random.Random(4)
    many = [(rng.choice([1, 1, 1, 2, 3, 7, None]), i) for i in range(1000)]
    one = [(1, "a"), (2, "b"), (3, None), (4, "d"), (None, "e")]
    m, o = spark.createDataFrame(many, "k long, v int"), spark.createDataFrame(one, "id long, w string")
    named = {k: w for k, w in one if k is not None}
    want = sorted(((k, v, k if k in named else None, named.get(k)) for k, v in many if how == "left" or k in named), key=repr)
    assert sorted((tuple(r) for r in join_to_one(m, o, "k", "id", how=how, most=most).collect()), key=repr) == want
    assert sorted((tuple(r) for r in join_to_one(m, o, "k", "id", how=how, most=most, sizes=m.select("k")).collect()), key=repr) == want
    assert join_to_one(m.limit(0), o, "k", "id", how=how, most=most).collect() == []
    assert len(join_to_one(m, o.limit(0), "k", "id", how=how, most=most).collect()) == (1000 if how == "left" else 0)
