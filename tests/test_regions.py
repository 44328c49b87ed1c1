"""Points in polygons, against a test of every point with every polygon."""

from __future__ import annotations

import random

import numpy as np
import pytest

from skylode.operators import regions

SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10)]
HOLE = [(4, 4), (6, 4), (6, 6), (4, 6)]
STAR = [(20, 0), (24, 9), (33, 10), (25, 14), (28, 24), (20, 17), (12, 24), (15, 14), (7, 10), (16, 9), (20, 0)]
ISLANDS = [(170, -10), (-170, -10), (-170, 10), (170, 10)]
BOW = [(40, 40), (50, 50), (50, 40), (40, 50)]
SHAPES = {1: [SQUARE, HOLE], 2: [STAR], 3: [ISLANDS], 4: [BOW], 5: [[(10, 0), (20, 0), (20, 10), (10, 10)]], 6: [[(1, 1), (2, 2)]], 7: [], 8: None, 9: [[(-180, -90), (180, -90), (180, -60), (-180, -60)]]}


def crossings(x, y, ring):
    """Whether a line to the north crosses a ring an odd number of times; the ring may go over the date line."""
    n = 0
    xs = [ring[0][0]]
    for a, b in zip(ring, ring[1:], strict=False):
        step = b[0] - a[0]
        xs.append(xs[-1] + (step - 360 * round(step / 360)))
    pts = list(zip(xs, [p[1] for p in ring], strict=True))
    for t in (-360, 0, 360):
        for (x1, y1), (x2, y2) in zip(pts, [*pts[1:], pts[0]], strict=True):
            if x1 > x2:
                x1, y1, x2, y2 = x2, y2, x1, y1
            n += x1 <= x + t < x2 and y < y1 + (x + t - x1) / (x2 - x1) * (y2 - y1)
    return n % 2 == 1


def brute(points):
    return sorted((i, r) for i, y, x in points for r, rings in SHAPES.items() if sum(crossings(x, y, ring) for ring in rings or [] if len(set(ring)) > 2) % 2)


def table(spark):
    rows = [(r, None if rings is None else [[{"lon": float(x), "lat": float(y)} for x, y in ring] for ring in rings]) for r, rings in SHAPES.items()]
    return spark.createDataFrame(rows, f"region long, rings {regions.RINGS}")


@pytest.mark.parametrize("cell", [16_384, 40])
def test_against_brute_force(spark, cell):
    rng = random.Random(3)
    points = [(i, rng.uniform(-20, 55), rng.uniform(-5, 55)) for i in range(1500)] + [(2000 + i, rng.uniform(-15, 15), rng.choice([rng.uniform(165, 180), rng.uniform(-180, -165), 180.0, -180.0])) for i in range(300)]
    points += [(3000 + i, 5.0, 5.0) for i in range(200)] + [(4000 + i, 2.0, 2.0) for i in range(300)] + [(5000, -75.0, 10.0), (5001, -89.0, 180.0)]
    df = spark.createDataFrame([*points, (6000, None, 1.0), (6001, 91.0, 1.0), (None, 2.0, 2.0)], "id long, gps_lat double, gps_lon double").repartition(3)
    got = sorted((r.id, r.region) for r in regions.containing_regions(df, table(spark), cell_rows=cell).collect())
    assert got == brute(points)


def test_shared_borders_belong_to_one(spark):
    points = [(i, y, x) for i, (x, y) in enumerate((x / 2, y / 2) for x in range(0, 41) for y in range(1, 20))]
    df = spark.createDataFrame(points, "id long, gps_lat double, gps_lon double")
    got = regions.containing_regions(df, table(spark).where("region IN (1, 5)")).collect()
    assert all(sum(r.id == i for r in got) == 1 for i, y, x in points if 6 < x < 20)


def test_empty(spark):
    points = spark.createDataFrame([(1, 5.0, 1.0)], "id long, gps_lat double, gps_lon double")
    assert regions.containing_regions(points.limit(0), table(spark)).collect() == []
    assert regions.containing_regions(points, table(spark).limit(0)).collect() == []
    assert [tuple(r) for r in regions.containing_regions(points.union(points), table(spark)).collect()] == [(1, 1), (1, 1)]


def test_edges():
    e, south = regions.edges_of([[{"lon": x, "lat": y} for x, y in ISLANDS]])
    assert south == -10 and (e[:, 0] < e[:, 2]).all() and len(e) == 4
    assert regions.edges_of(None)[0].shape == (0, 4) and regions.edges_of([[None, {"lon": 1.0, "lat": None}]])[0].shape == (0, 4)
    assert np.isinf(regions.edges_of([])[1])
