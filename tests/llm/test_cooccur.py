from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylode.llm import cooccur


def brute(baskets):
    sets = [sorted({x for x in b if x is not None}) for b in baskets if b is not None]
    one, two = Counter(x for s in sets for x in s), Counter(p for s in sets for p in itertools.combinations(s, 2))
    n = sum(bool(s) for s in sets)
    return {(a, b): (k, one[a], one[b], n) for (a, b), k in two.items()}


@pytest.fixture(scope="module")
def baskets():
    rng = random.Random(4)
    common, rare = [f"c{i}" for i in range(300)], [f"r{i}" for i in range(2000)]
    out = [[rng.choice(common if rng.random() < 0.8 else rare) for _ in range(rng.randint(0, 12))] for _ in range(3000)]
    return [*out, None, [], [None], ["only"], [None, "a", "a", "b"], [f"c{i}" for i in range(300)], *[["hot", "hot2"]] * 1500]


@pytest.mark.parametrize(("least", "most"), [(1, 10), (5, 200_000), (5, 3)])
def test_against_brute_force(spark, baskets, least, most):
    df = spark.createDataFrame([(b, 7, "x") for b in baskets], "items array<string>, n int, item string")
    got = {(r.item_a, r.item_b): (r.n_ab, r.n_a, r.n_b, r.n) for r in cooccur.cooccurrence(df, min_pairs=least, most_items=most).collect()}
    assert got == {p: v for p, v in brute(baskets).items() if v[0] >= least}


@pytest.mark.parametrize("least", [1, 4, 10**9])
def test_gram(least):
    rng = np.random.default_rng(1)
    m = rng.random((400, 700)) < rng.random(700) * 0.1
    row, item = np.nonzero(m)
    code, n = cooccur.gram(row, item, 700, least)
    want = m.T.astype(int) @ m.astype(int)
    a, b = np.nonzero(np.triu(want, 1))
    assert dict(zip(code.tolist(), n.tolist(), strict=True)) == dict(zip((a * 700 + b).tolist(), want[a, b].tolist(), strict=True))


def test_tags(spark):
    cases = {
        '["a", "B c", null, " ", "d_e "]': ["a", "b-c", "d-e"],
        '["a"] tail': [], '["a"]]': [], '["a"],["b"]': [], '["a': [], "[": [], "['a']": [], '["a",]': [], "[]": [], "": [], "[NaN]": [],
        "One, two words ,,x_y": ["one", "two-words", "x-y"],
        "[1, true]": ["1", "true"],
        None: [],
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r.t: r.x for r in df.select("t", cooccur.tag_list(F.col("t")).alias("x")).collect()}
    assert got == cases


def test_empty_table(spark):
    df = spark.createDataFrame([], "items array<string>")
    assert cooccur.cooccurrence(df, min_pairs=10).collect() == []
