from __future__ import annotations

import numpy as np
import pytest

from skylode.llm import dyadic


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(0)
    rows = []
    for g, n in (("a", 5000), ("b", 300), ("c", 1), ("hot", 12_000)):
        for x, y in zip(rng.beta(2, 5, n), rng.random(n).round(2), strict=True):
            rows.append((g, "k", float(x), float(y)))
    return rows


def run(spark, rows, shape=dyadic.Dyadic(), parts=3):
    df = spark.createDataFrame(rows, "g string, h string, x double, y double").repartition(parts)
    return dyadic.build(df, ["g", "h"], {"one": "x", "two": "y"}, shape)


def exact(rows, g, i, p):
    v = [r[i] for r in rows if r[0] == g and r[i] is not None and 0 <= r[i] <= 1]
    return len(v), float(np.percentile(v, p))


@pytest.mark.parametrize("shape", [dyadic.Dyadic(), dyadic.Dyadic(bits=20, width=16, depth=7)])
def test_error_bound(spark, table, shape):
    got = dyadic.percentiles(dyadic.merge(run(spark, table, shape), ["g", "h"]), ["g", "h"], [0, 5, 50, 95, 100], shape).collect()
    assert len(got) == 4 * 2 * 5
    for r in got:
        n, want = exact(table, r.g, 2 if r.metric == "one" else 3, r.pct)
        assert r.n == n
        assert abs(r.value - want) <= r.error + 1e-12


@pytest.mark.parametrize("n", [50, 20_000])
def test_sketches_decide_inside_a_cell(spark, n):
    """All values lie in one cell of the finest level counted in full, so that only the sketches can tell them apart."""
    shape = dyadic.Dyadic()
    cell = 2.0**-shape.exact_bits
    rng = np.random.default_rng(3)
    x = 0.5 + cell * rng.beta(2, 5, n)
    got = dyadic.percentiles(dyadic.merge(run(spark, [("g", "k", float(v), None) for v in x], shape), ["g", "h"]), ["g", "h"], [5, 25, 50, 75, 95], shape).collect()
    assert len(got) == 5 and shape.bits - shape.exact_bits == 14
    for r in got:
        rank = float((np.sort(x) <= r.value).mean())
        assert 0 < r.rank_error < 0.5 and abs(rank - r.pct / 100) <= 3 * r.rank_error
        assert abs(r.value - np.percentile(x, r.pct)) < 0.2 * cell
    wide = dyadic.Dyadic(width=4096, depth=7)
    assert wide.exact_bits == 14
    fine = dyadic.percentiles(dyadic.merge(run(spark, [("g", "k", float(v), None) for v in x], wide), ["g", "h"]), ["g", "h"], [50], wide).first()
    assert fine.rank_error < got[0].rank_error and abs(fine.value - np.percentile(x, 50)) < 0.05 * cell


def test_levels(spark):
    assert dyadic.Dyadic().exact_bits == 10 and dyadic.Dyadic(bits=6).exact_bits == 6
    assert dyadic.Dyadic(bits=6).rank_error(np.ones(64, np.int64)) == 0.0


def test_parts_and_deletions_add_up(spark, table):
    shape = dyadic.Dyadic()
    keys = ["g", "h"]
    whole = {(r.g, r.metric): dyadic._unpacked(bytes(r.sketch)) for r in dyadic.merge(run(spark, table), keys).collect()}
    halves = dyadic.merge(run(spark, table[::2]), keys).unionByName(dyadic.merge(run(spark, table[1::2]), keys))
    for tasks in (2, 100):
        again = {(r.g, r.metric): dyadic._unpacked(bytes(r.sketch)) for r in dyadic.merge(halves, keys, tasks).collect()}
        assert whole.keys() == again.keys() and all((whole[k] == again[k]).all() for k in whole)
    more = [(*r, 1) for r in table + table[:400]] + [(*r, -1) for r in table[:400]] + [("gone", "k", 0.5, 0.5, 1), ("gone", "k", 0.5, 0.5, -1)]
    df = spark.createDataFrame(more, "g string, h string, x double, y double, w int")
    undone = dyadic.merge(dyadic.build(df, keys, {"one": "x", "two": "y"}, shape, "w"), keys)
    assert all((whole[r.g, r.metric] == dyadic._unpacked(bytes(r.sketch))).all() for r in undone.collect() if r.g != "gone")
    assert dyadic.percentiles(undone, keys, [50]).where("g = 'gone'").collect() == []


def test_odd_rows(spark):
    rows = [("a", "k", None, 0.5), ("a", "k", float("nan"), 0.5), ("a", "k", -1.0, 2.0), ("a", "k", 1.0, 0.0), (None, "k", 0.5, 0.5), ("a", None, 0.5, 0.5)]
    got = dyadic.percentiles(dyadic.merge(run(spark, rows), ["g", "h"]), ["g", "h"], [50]).collect()
    assert {(r.metric, r.n) for r in got} == {("one", 1), ("two", 3)}
    assert dyadic.percentiles(dyadic.merge(run(spark, []), ["g", "h"]), ["g", "h"], [50]).collect() == []
