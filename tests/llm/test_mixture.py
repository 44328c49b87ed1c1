from __future__ import annotations

import random

import pytest

from skylode.llm.mixture import Mixture


@pytest.fixture(scope="module")
def sizes(spark):
    rng = random.Random(8)
    rows = [(i, s, max(1, int(rng.lognormvariate(m, 1)))) for i, (s, m) in enumerate([("big", 5)] * 3000 + [("small", 4)] * 400 + [("mid", 6)] * 900)]
    rows += [(9001, None, 50), (9002, "untargeted", 50), (9003, "big", 0), (9004, "big", None)]
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, n_tokens long, cap int"), rows


TARGETS = [("big", 50.0, 1), ("small", 20.0, 3), ("mid", 30.0, 2), ("absent", 10.0, 5), (None, 5.0, 1), ("bad", float("nan"), 1), ("zero", 0.0, 1), ("untargeted", None, 1)]


def targets(spark, rows=TARGETS):
    return spark.createDataFrame(rows, "source string, weight double, max_repeats int")


def test_shares_and_caps(spark, sizes):
    df, rows = sizes
    m = Mixture(df, targets(spark))
    got = m.rows().collect()
    caps = {"big": 1, "small": 3, "mid": 2}
    token = {r[0]: r[2] for r in rows}
    assert all(1 <= r.copies <= caps[r.src] and r["size"] == token[r.id] for r in got)
    assert len({r.id for r in got}) == len(got)
    by = {s: sum(r["size"] * r.copies for r in got if r.src == s) for s in caps}
    whole = sum(by.values())
    for s, share in (("big", 0.5), ("small", 0.2), ("mid", 0.3)):
        assert abs(by[s] / whole - share) < 0.003
    report = {r.source: r for r in m.report().collect()}
    assert set(report) == {"big", "small", "mid", "absent"}
    assert report["absent"].share == 0 and report["small"].mixture_size == by["small"]
    assert report["small"].most_repeats <= 3


def test_rates_are_tilted_and_solve_the_constraints(spark, sizes):
    m = Mixture(sizes[0], targets(spark))
    for s in m.active.values():
        assert s.done
    rate = m.rated.groupBy("src").agg({"*": "count"}).count()
    assert rate == 3
    got = m.rated.where("src = 'big'").selectExpr("sum(rate * t) as g", "max(rate) as hi", "min(rate) as lo").first()
    assert abs(got.g / m.sources["big"].goal - 1) < 1e-6 and got.hi <= 1 + 1e-9


def test_greater_total_uses_up_what_there_is(spark, sizes):
    m = Mixture(sizes[0], targets(spark), total=1e12)
    copies = {r.src: (r.lo, r.hi) for r in m.rows().groupBy("src").agg({"copies": "min"}).withColumnRenamed("min(copies)", "lo").join(m.rows().groupBy("src").agg({"copies": "max"}).withColumnRenamed("max(copies)", "hi"), "src").collect()}
    assert copies == {"big": (1, 1), "small": (3, 3), "mid": (2, 2)}


def test_small_total(spark, sizes):
    m = Mixture(sizes[0], targets(spark), total=20_000)
    r = {x.source: x for x in m.report().collect()}
    assert abs(sum(x.mixture_size for x in r.values()) - 20_000) < 3000


def test_same_again(spark, sizes):
    one, two = (sorted(map(tuple, Mixture(sizes[0], targets(spark)).rows().collect())) for _ in range(2))
    assert one == two


def test_unsolved_sources_are_an_error(spark, sizes):
    with pytest.raises(ArithmeticError, match="after 1 steps"):
        Mixture(sizes[0], targets(spark), most_steps=1)


def test_empty(spark, sizes):
    assert Mixture(sizes[0].limit(0), targets(spark)).rows().collect() == []
    assert Mixture(sizes[0], targets(spark, [])).rows().collect() == []
    assert Mixture(sizes[0].limit(0), targets(spark)).report().count() == 4
