from __future__ import annotations

import math
import random

import pytest

from skylode.llm import selection


def brute(rows, targets, low=0.0, high=1.0):
    keep = {}
    for g, p in targets:
        if g is not None and p is not None:
            keep[g] = max(p, keep.get(g, p))
    out, cut = set(), {}
    for g, p in keep.items():
        own = sorted((s for c, _, s in rows if c == g and s is not None and low <= s <= high), reverse=True)
        if not own:
            cut[g] = (0, None, 0)
            continue
        k = min(len(own), max(1, math.ceil(len(own) * p / 1000)))
        c = own[k - 1]
        cut[g] = (len(own), c, sum(s >= c for s in own))
        out |= {(g, i) for q, i, s in rows if q == g and s is not None and low <= s <= high and s >= c}
    return out, cut


@pytest.mark.parametrize(("run", "pivots"), [(1 << 16, 1 << 16), (7, 1), (64, 200)])
def test_against_brute_force(spark, monkeypatch, run, pivots):
    monkeypatch.setattr(selection, "_RUN", run)
    monkeypatch.setattr(selection.find_cutoffs, "__defaults__", (pivots,))
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", "ties", None, "untargeted"]), i, rng.choice([rng.random(), round(rng.random(), 2), None, float("nan"), -0.5, 2.0, 0.0, -0.0, 5e-324])) for i in range(4000)]
    rows = [(g, i, 0.25 if g == "ties" and s is not None else s) for g, i, s in rows]
    targets = [("hot", 333), ("a", 1000), ("b", 1), ("ties", 10), ("nothing", 500), ("a", 100), (None, 5), ("b", None), ("hot", 5)]
    df = spark.createDataFrame([(g, i, s, "x") for g, i, s in rows], "country string, id long, s double, grp string").repartition(3)
    kept = selection.Kept(df, spark.createDataFrame(targets, "country string, keep int"), group="country", key="id", score="s", permille="keep")
    want, cut = brute(rows, targets)
    assert {(r.grp, r.id) for r in kept.rows().collect()} == want
    assert {r.grp: (r.n, r.cutoff, r.kept) for r in kept.report().collect()} == cut


def test_extremes(spark):
    df = spark.createDataFrame([("g", i, float(i)) for i in range(10)], "g string, id long, s double")
    for p, n in ((0, 1), (-5, 1), (1000, 10), (5000, 10), (101, 2)):
        t = spark.createDataFrame([("g", p)], "g string, p int")
        assert selection.Kept(df, t, group="g", key="id", score="s", permille="p", high=100.0).rows().count() == n
    none = selection.Kept(df.limit(0), spark.createDataFrame([("g", 5)], "g string, p int"), group="g", key="id", score="s", permille="p")
    assert none.rows().collect() == [] and none.report().first().n == 0
    assert selection.Kept(df, spark.createDataFrame([], "g string, p int"), group="g", key="id", score="s", permille="p").report().collect() == []


@pytest.mark.parametrize("kind", ["cubes", "one value", "two values", "tiny", "sorted"])
def test_rounds_narrow_whatever_the_distribution(spark, kind):
    """Many rounds of few pivots end at the exact cutoff, however the scores are spread."""
    rng = random.Random(5)
    make = {"cubes": lambda i: rng.random() ** 9, "one value": lambda i: 0.5, "two values": lambda i: float(i % 2), "tiny": lambda i: i * 5e-324, "sorted": lambda i: i / 20_000}[kind]
    rows = [("g", i, make(i)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "g string, id long, s double").repartition(3)
    runs = selection.sorted_runs(df.selectExpr("g AS grp", "id", "s AS score")).checkpoint()
    ordered = sorted((s for _, _, s in rows), reverse=True)
    for p in (1, 333, 999, 1000):
        n, cutoff, kept = selection.find_cutoffs(runs, {"g": p}, most_pivots=16)["g"]
        want = ordered[max(1, math.ceil(20_000 * p / 1000)) - 1]
        assert (n, cutoff, kept) == (20_000, want, sum(x >= want for x in ordered))
