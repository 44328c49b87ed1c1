"""Folds against plain loops on random lists, and window operators on small cases."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from skylode.operators import sequences as seq

M = seq.Motion()


def turns(v):
    count, way, anchor = 0, 0, None
    for x in v:
        if anchor is None or max(anchor, x) < M.held_rate:
            anchor = x
        elif abs(x - anchor) / max(anchor, M.held_rate) >= M.min_change:
            new = 1 if x > anchor else -1
            count += way not in (0, new)
            way, anchor = new, x
    return count


def ratio(v):
    return max(v) / max(min(v), M.held_rate) if v and max(v) > 0 else 1.0


def short_merged(runs):
    runs = [list(r) for r in runs]
    if len(runs) < 2:
        return [tuple(r) for r in runs]
    while len(runs) > 1:
        at = [i for i, (a, b, c) in enumerate(runs) if b - a < (M.min_reposition if c == "reposition" else M.min_seconds)]
        if not at:
            break
        i = at[0]
        sides = [j for j in (i - 1, i + 1) if 0 <= j < len(runs)]
        j = max(sides, key=lambda k: (runs[k][1] - runs[k][0], -k))
        lo, hi = min(i, j), max(i, j)
        runs[lo : hi + 1] = [[runs[lo][0], runs[hi][1], runs[j][2]]]
    out = []
    for r in runs:
        if out and out[-1][2] == r[2]:
            out[-1][1] = r[1]
        else:
            out.append(r)
    return [tuple(r) for r in out]


def usable_merged(runs):
    out = []
    for a, b, c in runs:
        if out and c != "reposition" and out[-1][2] != "reposition":
            p = out[-1]
            out[-1] = (p[0], b, p[2] if p[1] - p[0] >= b - a else c)
        else:
            out.append((a, b, c))
    return out


def segments_merged(runs, least):
    out = []
    for a, b, _ in runs:
        if out and out[-1][1] - out[-1][0] < least:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    if len(out) > 1 and out[-1][1] - out[-1][0] < least:
        tail = out.pop()
        out[-1] = (out[-1][0], tail[1])
    return out


def windows(v, least, most):
    lo, hi = max(1, round(least)), max(max(1, round(least)), round(most))

    def search(eased):
        free, taken = [(0, len(v))], []
        while True:
            best = None
            for a, b in free:
                for n in range(lo, min(hi, b - a) + 1):
                    for o in range(a, b - n + 1):
                        part = v[o : o + n]
                        if turns(part) == 0 and (ratio(part) <= M.max_spread or eased and part[0] < M.held_rate):
                            best = min(best or (1,), (-n, ratio(part), o))
            if best is None:
                return taken
            n, s, o = -best[0], best[1], best[2]
            taken.append((float(o), float(o + n), int(s * 1000 + 0.5) / 1000))
            free = [x for a, b in free for x in (((a, o), (o + n, b)) if a <= o and o + n <= b else ((a, b),)) if x[1] - x[0] >= lo]

    return sorted(search(False) or search(True))


@pytest.fixture(scope="module")
def lists(spark):
    rng = random.Random(3)
    runs = []
    for _ in range(250):
        at, one = 0.0, []
        for _ in range(rng.randint(0, 9)):
            n = rng.choice((0.25, 0.5, 1.0, 2.0, 3.0, 4.0, 4.0))
            one.append((at, at + n, rng.choice(("held", "move", "reposition"))))
            at += n
        runs.append(one)
    curves = [[rng.choice((0.0, 0.005, 0.02, 0.05, 0.1, 0.11, 0.3, 0.9)) for _ in range(rng.randint(0, 14))] for _ in range(150)]
    return runs, curves, spark.createDataFrame([(i, r) for i, r in enumerate(runs)], f"i int, r {seq.RUN}").coalesce(4).cache(), spark.createDataFrame([(i, c) for i, c in enumerate(curves)], "i int, v array<double>").cache()


def test_short_runs(lists):
    runs, _, df, _ = lists
    got = df.select(seq.merge_short_runs(F.col("r")).alias("x")).collect()
    assert [[tuple(y) for y in g.x] for g in got] == [short_merged(r) for r in runs]


def test_usable_runs(lists):
    runs, _, df, _ = lists
    got = df.select(seq.merge_usable_runs(F.col("r")).alias("x")).collect()
    assert [[tuple(y) for y in g.x] for g in got] == [usable_merged(r) for r in runs]


def test_short_segments(lists):
    runs, _, df, _ = lists
    got = df.select(seq.merge_short_segments(F.col("r"), 3.0).alias("x")).collect()
    assert [[(y.start, y.end) for y in g.x] for g in got] == [segments_merged(r, 3.0) for r in runs]


def test_reversals_and_spread(lists):
    _, curves, _, df = lists
    got = df.select(seq.reversals(F.col("v")).alias("n"), seq.spread(F.col("v")).alias("s"), seq.eases_in(F.col("v")).alias("e")).collect()
    assert [(g.n, round(g.s, 9), g.e) for g in got] == [(turns(c), round(ratio(c), 9), bool(c) and c[0] < M.held_rate) for c in curves]


def test_known_curves(spark):
    steady = [0.2, 0.22, 0.21, 0.2, 0.23, 0.22]
    stop_and_go = [0.4, 0.05, 0.4, 0.05, 0.4]
    got = spark.createDataFrame([(steady,), (stop_and_go,), ([],)], "v array<double>").select(seq.reversals(F.col("v")).alias("n")).collect()
    assert [g.n for g in got] == [0, 3, 0]


def test_windows(lists):
    _, curves, _, df = lists
    got = df.select(seq.find_windows(F.col("v"), F.lit(0.0), 3.0, F.lit(6.0)).alias("w")).collect()
    assert [[tuple(x) for x in g.w] for g in got] == [windows(c, 3, 6) for c in curves]


def test_carving_covers_the_run(lists):
    _, curves, _, df = lists
    got = df.select((F.size("v") + 0.4).alias("n"), seq.carve_windows(F.lit(0.0), F.size("v") + 0.4, F.lit("move"), F.col("v"), 3.0, 6.0).alias("p")).collect()
    for g in got:
        assert g.p[0].start == 0 and abs(g.p[-1].end - g.n) <= 0.011
        assert all(abs(a.end - b.start) < 1e-9 for a, b in zip(g.p, g.p[1:], strict=False))
        assert all(turns(p.profile) == 0 for p in g.p if p.is_window)
    whole = df.select(seq.carve_windows(F.lit(0.0), F.lit(5.0), F.lit("move"), F.col("v")).alias("p")).collect()
    assert all(len(g.p) == 1 and g.p[0].is_window for g in whole)


def test_labels_and_splits(spark):
    rows = [(1, i, i * 0.25, (i + 1) * 0.25, 8.0 if i < 20 or i >= 32 else (200.0 if i % 2 else -200.0), 0.0, 0.9) for i in range(52)] + [(2, 0, 0.0, 0.25, None, None, None)]
    s = spark.createDataFrame(rows, "scene int, ord long, start double, end double, dx double, dy double, response double")
    runs = seq.segment(s, "scene", "ord", 512.0, 4.0).where("scene = 1").first().runs
    assert [r.cls for r in runs] == ["move", "reposition", "move"]
    scenes = spark.createDataFrame([(1, 0.0, 13.5), (3, 0.0, 4.0)], "scene int, start double, end double")
    pieces = seq.split_by_motion(scenes, s, "scene", "ord", 512.0, 4.0)
    assert seq.untiled(pieces, scenes, "scene").collect() == []
    assert [(p.cls, p.is_window, p.profile) for p in pieces.where("scene = 3").collect()] == [("move", True, [])]
    assert seq.label_samples(s.limit(0), "scene", "ord", 512.0, 4.0).collect() == []


def test_cut_list_and_times(spark):
    d = spark.createDataFrame([([(0.0, 5.0, None), (5.0, 9.0, None)], 10.0), (None, 7.0), ([], 2.0)], f"c {seq.RUN}, d double")
    got = d.select(seq.cut_list(F.col("c"), F.col("d"), 3.0).alias("x")).collect()
    assert [[(y.start, y.end) for y in g.x] for g in got] == [[(0, 5), (5, 10)], [(0, 7)], [(0, 2)]]
    t = spark.createDataFrame([(0.0, 4.0), (1.0, 1.0), (0.0, 0.5)], "a double, b double").select(seq.sample_times(F.col("a"), F.col("b"), 1.0).alias("t"), seq.dense_times(F.col("a"), F.col("b"), 2.0, 3).alias("u")).collect()
    assert [r.t for r in t] == [[0.5, 1.5, 2.5, 3.5], [], [0.25]]
    assert [r.u for r in t] == [[0.0, 0.5, 1.0], [], [0.0]]


def test_one_way(spark):
    rng = random.Random(11)
    rows = [([rng.choice([0.0, 0.005, 0.1, 0.2, 0.5, 1.0]) * rng.uniform(0.9, 1.1) for _ in range(rng.randint(0, 15))],) for _ in range(300)]
    got = [r[0] for r in spark.createDataFrame(rows, "v array<double>").select(seq.one_way(F.col("v"))).collect()]
    assert got == [max(k for k in range(len(v) + 1) if turns(v[:k]) == 0) for (v,) in rows]


def test_samples_in_runs(spark):
    """Abutting runs with gaps here and there: midpoints inside, on borders, before, between and behind them."""
    rng = random.Random(12)
    runs, samples = [], []
    for scene in range(20):
        t = 0.0
        for run in range(rng.randint(0, 6)):
            t += rng.choice([0.0, 0.0, 0.5])
            runs.append((scene, run, t, t + rng.choice([0.25, 0.5, 1.0])))
            t = runs[-1][3]
        samples += [(scene, i, i * 0.25 - 0.5, i * 0.25 - 0.25 if i % 2 else i * 0.25 - 0.5, 3.0, 4.0) for i in range(30)]
    r = spark.createDataFrame(runs, "scene int, run int, start double, end double")
    s = spark.createDataFrame(samples, "scene int, ord long, start double, end double, dx double, dy double")
    got = sorted((x.scene, x.run, x.ord, x.far) for x in seq.samples_in_runs(s, r, "scene", "ord").collect())
    assert got == sorted((c, run, o, 5.0) for c, o, a, b, _, _ in samples for c2, run, lo, hi in runs if c == c2 and lo <= (a + b) / 2 <= hi)
    assert seq.samples_in_runs(s, r.limit(0), "scene", "ord").collect() == [] and seq.samples_in_runs(s.limit(0), r, "scene", "ord").collect() == []
