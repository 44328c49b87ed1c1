from __future__ import annotations

import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylode.llm import ranking


def test_normal_quantile():
    p = np.concatenate([np.linspace(1e-12, 1 - 1e-12, 5001), [1e-300, 1e-20, 0.5]])
    want = np.array([NormalDist().inv_cdf(x) for x in p])
    assert np.allclose(ranking.normal_quantile(p), want, rtol=1e-12, atol=1e-13)
    assert (np.diff(ranking.normal_quantile(np.sort(p))) >= 0).all()


def brute(rows, weights):
    n = len(weights)
    z = []
    for i in range(n):
        v = [r[i + 1] for r in rows if r[i + 1] is not None and r[i + 1] == r[i + 1]]
        z.append({x: NormalDist().inv_cdf((sum(y < x for y in v) + v.count(x) / 2) / len(v)) for x in set(v)})
    out = {}
    for r in rows:
        have = [i for i in range(n) if r[i + 1] is not None and r[i + 1] == r[i + 1]]
        out[r[0]] = sum(weights[i] * z[i][r[i + 1]] for i in have) / sum(weights[i] for i in have) if have else None
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    some = lambda x: rng.choice([x, x, x, x, None, 0.5])
    return [(i, some(rng.lognormvariate(0, 3)), some(rng.random()), some(float(rng.randint(0, 3)))) for i in range(500)] + [(900, None, None, None), (901, float("nan"), None, None), (902, 1.0, 0.2, 3.0), (903, 1.0, 0.2, 3.0)]


@pytest.mark.parametrize(("most", "hot"), [(1 << 18, 1 << 12), (10, 1 << 12), (10, 20), (0, 1)])
def test_against_brute_force(spark, rows, most, hot):
    """The same whether values are looked up, joined, or frequent ones looked up and the others joined."""
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "id long, a double, b double, c double, metric string, value int")
    got = ranking.combined(df, "id", {"a": "a", "b": "b", "c": "c"}, {"a": 1.0, "b": 2.0, "c": 0.5}, carry=["metric"], most_values=most, hot_share=hot).collect()
    want = brute(rows, [1.0, 2.0, 0.5])
    assert len(got) == len(rows) and {r.metric for r in got} == {"x"}
    for r in got:
        assert (r.rating is None) == (want[r.id] is None)
        assert r.rating is None or abs(r.rating - want[r.id]) < 1e-9
    tied = [r.rating for r in got if r.id in (902, 903)]
    assert tied[0] == tied[1]


def test_scale_does_not_matter(spark, rows):
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    one = {r.id: r.rating for r in ranking.combined(df, "id", {"a": "a", "b": "b", "c": "c"}).collect()}
    two = {r.id: r.rating for r in ranking.combined(df, "id", {"a": "a * 1e6", "b": "exp(b)", "c": "c - 7"}).collect()}
    assert one == two


def test_positions(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, rng.random(), 0.5])) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, x double").repartition(5)
    got = {r.position: r.id for r in ranking.positions(df, [F.col("x").desc_nulls_last(), F.col("id")]).collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [got[i + 1] for i in range(1000)] == [r[0] for r in want]
    assert ranking.positions(df.limit(0), [F.col("id")]).collect() == []


def test_empty(spark):
    df = spark.createDataFrame([], "id long, a double")
    assert ranking.combined(df, "id", {"a": "a"}).collect() == []
