"""Movement and scores of made-up frames: a pan, a hold, a shaking camera."""

from __future__ import annotations

import numpy as np
import pytest

from skylode.operators import frames

W, H = 96, 64


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    world = rng.integers(30, 220, (H + 40, W + 400)).astype(np.float64)
    for axis in (0, 1):
        world = (world + np.roll(world, 1, axis) + np.roll(world, 2, axis)) / 3
    world = np.clip((world - world.mean()) * 3 + 125, 6, 249).astype(np.uint8)
    at = lambda x, y=20: world[y : y + H, x : x + W].tobytes()
    out = [("pan", i, i * 0.25, at(3 * i + 5), W) for i in range(40)]
    out += [("hold", i, i * 0.25, at(50), W) for i in range(40)]
    shake = rng.integers(-15, 16, (40, 2))
    out += [("shake", i, i * 0.25, at(100 + int(dx), 20 + int(dy)), W) for i, (dx, dy) in enumerate(shake)]
    out += [("bad", 0, 0.0, None, W), ("bad", 1, 0.25, b"", W), ("bad", 2, 0.5, at(5), W), ("bad", 3, 0.75, b"123", W), ("bad", 4, 1.0, at(8), W), ("bad", 5, 1.25, at(8)[: W * 32], W), ("bad", 6, 1.5, at(8), None)]
    return out


@pytest.fixture(scope="module")
def measured(spark, rows):
    return frames.measure(spark.createDataFrame(rows, "scene string, ord long, t double, pixels binary, width int").repartition(3), "scene", "ord").cache()


def test_movement(measured):
    pan = measured.where("scene = 'pan' AND dx IS NOT NULL").collect()
    assert len(pan) == 39 and all(abs(abs(r.dx) - 3) < 0.3 and abs(r.dy) < 0.3 and r.end - r.start == 0.25 for r in pan)
    hold = measured.where("scene = 'hold' AND dx IS NOT NULL").collect()
    assert all(abs(r.dx) < 0.01 and abs(r.dy) < 0.01 for r in hold)


def test_unreadable_frames(measured):
    got = {r.ord: (r.start, r.end, r.dx is None) for r in measured.where("scene = 'bad'").collect()}
    assert got == {2: (0.25, 0.5, True), 4: (0.75, 1.0, False), 5: (1.0, 1.25, True)}


def test_classes_and_scores(spark, measured):
    runs = {r.scene: [x.cls for x in r.runs] for r in frames.profile_motion(measured, "scene", "ord", W, 4.0).collect()}
    assert runs["pan"] == ["move"] and runs["hold"] == ["held"] and runs["shake"] == ["reposition"]
    s = {r.scene: r for r in frames.score_shots(measured, "scene").collect()}
    assert s["hold"].motion < s["pan"].motion and s["pan"].stability > 0.95 > s["shake"].stability and s["hold"].stability == 1.0
    assert all(0 <= r.technical <= 1 for r in s.values())


def test_empty(spark):
    df = spark.createDataFrame([], "scene string, ord long, t double, pixels binary, width int")
    m = frames.measure(df, "scene", "ord")
    assert m.collect() == [] and frames.profile_motion(m, "scene", "ord", W, 4.0).collect() == [] and frames.score_shots(m, "scene").collect() == []
