from __future__ import annotations

import math
import random

import numpy as np
import pytest

from skylode.operators.neighbours import EARTH_M, KdTree, near_pairs, pairs_within, unit_vectors


def apart(a, b):
    la, lo, lb, lp = (math.radians(x) for x in (a[0], a[1], b[0], b[1]))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * EARTH_M * math.asin(min(1.0, math.sqrt(h)))


def brute(rows, r):
    ok = [(i, a, o) for i, a, o in rows if i is not None and a is not None and o is not None and -90 <= a <= 90 and -180 <= o <= 180 and (a, o) != (0, 0)]
    return sorted((min(p[0], q[0]), max(p[0], q[0])) for n, p in enumerate(ok) for q in ok[n + 1 :] if p[0] != q[0] and apart(p[1:], q[1:]) <= r)


def points(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.5:
            p = (60 + rng.gauss(0, 0.002), 10 + rng.gauss(0, 0.004))
        elif kind < 0.6:
            p = (89.9999 + rng.random() * 1e-4, rng.uniform(-180, 180))
        elif kind < 0.7:
            p = (rng.gauss(0, 0.001), rng.choice((-1, 1)) * (180 - rng.random() * 1e-3))
        elif kind < 0.85:
            p = (45.5, 7.25)  # many at one place
        else:
            p = (rng.uniform(-90, 90), rng.uniform(-180, 180))
        out.append((i, *p))
    return out


def run(spark, rows, r, **more):
    df = spark.createDataFrame(rows, "id long, gps_lat double, gps_lon double")
    return sorted(map(tuple, near_pairs(df, r, **more).collect()))


@pytest.mark.parametrize("cell_rows", [16_384, 40])
def test_against_brute_force(spark, cell_rows):
    rows = points(600, 5) + [(1000, 0.0, 0.0), (1001, 0.0, 0.0), (1002, None, 1.0), (1003, float("nan"), 1.0), (1004, 91.0, 1.0), (1005, 0.0, 5.0), (1006, 0.0, 5.0), (None, 60.0, 10.0)]
    assert run(spark, rows, 60.0, cell_rows=cell_rows) == brute(rows, 60.0)


def test_empty_single_and_extra_columns(spark):
    assert run(spark, [], 60.0) == []
    assert run(spark, [(1, 5.0, 5.0)], 60.0) == []
    df = spark.createDataFrame([(1, 5.0, 5.0, "a", 1), (2, 5.0, 5.0, "b", 2)], "id long, gps_lat double, gps_lon double, task string, home int")
    assert list(map(tuple, near_pairs(df, 60.0).collect())) == [(1, 2)]


@pytest.mark.parametrize("n", [0, 1, 2, 50, 1000])
def test_trees(n):
    rng = np.random.default_rng(n)
    v = unit_vectors(rng.uniform(-1, 1, n), rng.uniform(-1, 1, n))
    r = 2e-3
    got = sorted((min(a, b), max(a, b)) for p, q in pairs_within(KdTree(v), None, r) for a, b in zip(p.tolist(), q.tolist(), strict=True)) if n else []
    d = ((v[:, None] - v[None]) ** 2).sum(-1) if n else np.zeros((0, 0))
    want = sorted((i, j) for i, j in zip(*np.nonzero(d <= r * r), strict=True) if i < j)
    assert got == want
    if n > 10:
        half = n // 3
        two = sorted((a, b + half) for p, q in pairs_within(KdTree(v[:half]), KdTree(v[half:]), r) for a, b in zip(p.tolist(), q.tolist(), strict=True))
        assert two == [(i, j) for i, j in want if i < half <= j]
