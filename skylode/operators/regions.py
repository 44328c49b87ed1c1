"""The regions that contain each point.

Regions are polygons in degrees, given by their rings; a point is inside if a line to the north crosses their edges an odd number of
times, so holes are rings like others. k-d splits, fitted on a bounded sample of the points, cut them into cells. An edge
goes to the cells of its range of longitude that its region's box reaches and that don't lie north of it. A cell is
swept from west to east: its points are in order of longitude, an edge that is north of all of them flips the points in its range by its two
ends only, and just the edges that cross the cell are compared with the points in their range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylode.operators.neighbours import _groups, cells_of, fit_splits, valid_position
from skylode.session import cut

RINGS = "array<array<struct<lon: double, lat: double>>>"


def edges_of(rings: list) -> tuple[np.ndarray, float]:
    """(x1, y1, x2, y2; x1 < x2) of a region's edges within -180..180, and its southern end.

    A ring is closed if it isn't. Steps of more than 180 degrees go over the date line; the parts beyond it are
    moved round. Edges along a meridian cross no line to the north. Rings of fewer than three corners have no inside.
    """
    out, south = [], math.inf
    for ring in rings or []:
        xy = np.array([(p["lon"], p["lat"]) for p in ring if p is not None and p["lon"] is not None and p["lat"] is not None], np.float64).reshape(-1, 2)
        if len(xy) > 1 and (xy[0] == xy[-1]).all():
            xy = xy[:-1]
        if len(xy) < 3 or not np.isfinite(xy).all():
            continue
        south = min(south, float(xy[:, 1].min()))
        step = np.diff(xy[:, 0], append=xy[0, 0])
        step -= 360 * np.round(step / 360)
        x1 = xy[0, 0] + np.concatenate([[0.0], np.cumsum(step[:-1])])
        e = np.stack([x1, xy[:, 1], x1 + step, np.roll(xy[:, 1], -1)], axis=1)
        # corners keep their own longitudes where nothing was moved, so that neighbours share them to the last digit
        same = np.abs(x1 - xy[:, 0]) < 1e-9
        e[same, 0] = xy[same, 0]
        after = np.abs(e[:, 2] - np.roll(xy[:, 0], -1)) < 1e-9
        e[after, 2] = np.roll(xy[:, 0], -1)[after]
        out.append(e)
    if not out:
        return np.zeros((0, 4)), south
    e = np.concatenate(out)
    e = np.where((e[:, 0] > e[:, 2])[:, None], e[:, [2, 3, 0, 1]], e)
    moved = np.concatenate([e + np.array([t, 0, t, 0]) for t in (-360.0, 0.0, 360.0)])
    return moved[(moved[:, 0] < moved[:, 2]) & (moved[:, 0] <= 180) & (moved[:, 2] >= -180)], south


def cells_of_boxes(low: np.ndarray, high: np.ndarray, axis: np.ndarray, place: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of each box and each cell that it reaches into."""
    row, node = np.arange(len(low)), np.ones(len(low), np.int64)
    for _ in range(depth):
        k, at = axis[node], place[node]
        left, right = low[row, k] <= at, high[row, k] > at
        row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
    return row, node - (1 << depth)


def inside(x: np.ndarray, y: np.ndarray, region: np.ndarray, edges: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each region the points that it contains. An edge holds its western end and not its eastern one; points on an edge aren't south of it."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    top = y.max(initial=-np.inf)
    for r in np.unique(region).tolist():
        e = edges[region == r]
        i, j = np.searchsorted(x, e[:, 0], "left"), np.searchsorted(x, e[:, 2], "left")
        e, i, j = e[j > i], i[j > i], j[j > i]
        if not len(e):
            continue
        over = np.minimum(e[:, 1], e[:, 3]) > top
        flips = np.bincount(np.concatenate([i[over], j[over]]), minlength=len(x) + 1)[:-1]
        odd = np.cumsum(flips) % 2
        for (x1, y1, x2, y2), a, b in zip(e[~over].tolist(), i[~over].tolist(), j[~over].tolist(), strict=True):
            odd[a:b] ^= y[a:b] < y1 + (x[a:b] - x1) / (x2 - x1) * (y2 - y1)
        found = order[odd == 1]
        if len(found):
            yield r, found


def containing_regions(points: DataFrame, regions: DataFrame, *, key: str = "id", lat: str = "gps_lat", lon: str = "gps_lon", region: str = "region", rings: str = "rings", cell_rows: int = 16_384, sample_rows: int = 200_000) -> DataFrame:
    """(id, region): every point with every region that contains it.

    ``regions`` has a whole number ``region`` and ``rings`` (see ``RINGS``); edges are straight in degrees, and a region around a pole needs
    an edge along it. Points without a valid position or key, and regions that are NULL or have no area, are in no
    row. Repeated rows count each time. A point on a border that two regions share is in one of them. A cell with more
    than twice ``cell_rows`` points (many at one place) is swept in blocks of point subsets, each with the cell's edges.
    """
    at = cut(points.where(valid_position(lat, lon) & F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{lon}`").cast("double").alias("x"), F.col(f"`{lat}`").cast("double").alias("y")))
    n = at.count()
    every = max(1, n // sample_rows)
    depth = max(0, min(20, math.ceil(math.log2(max(1, n / cell_rows)))))
    axis, place = np.zeros(1, np.int8), np.zeros(1)
    blocks = np.ones(1 << depth, np.int64)
    if depth:
        got = at.where(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(every)) == 0).select("x", "y").toArrow()
        xy = np.stack([got.column(c).to_numpy() for c in ("x", "y")], axis=1)
        axis, place = fit_splits(xy, depth)
        size = np.bincount(cells_of(xy, axis, place, depth, 0.0)[1], minlength=1 << depth) * every
        blocks = np.where(size > 2 * cell_rows, -(-size // cell_rows), 1)
    first = np.concatenate([[0], np.cumsum(blocks)])
    names = ["task", "id", "x", "y", "x2", "y2"]
    kind = "task bigint, id bigint, x double, y double, x2 double, y2 double"

    def place_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, x, y = (b.column(i).to_numpy() for i in range(3))
            row, cell, _ = cells_of(np.stack([x, y], axis=1), axis, place, depth, 0.0)
            part = (ids[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks[cell]
            none = pa.nulls(len(row), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(first[cell] + part), pa.array(ids[row]), pa.array(x[row]), pa.array(y[row]), none, none], names)

    def place_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, shape in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                e, south = edges_of(shape)
                row, cell = cells_of_boxes(np.stack([e[:, 0], np.full(len(e), south)], axis=1), np.stack([e[:, 2], np.maximum(e[:, 1], e[:, 3])], axis=1), axis, place, depth)
                k = blocks[cell]
                again = np.repeat(np.arange(len(row)), k)
                task = first[cell[again]] + np.arange(len(again)) - np.repeat(np.cumsum(k) - k, k)
                e = e[row[again]]
                for i in range(0, len(e), 1 << 16):
                    p = slice(i, i + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(task[p]), pa.array(np.full(len(e[p]), r, np.int64)), *[pa.array(c) for c in e[p].T]], names)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, "task"):
            ids, x, y, x2, y2 = (t.column(c).to_numpy() for c in names[1:])
            point = np.isnan(x2)
            if point.all() or not point.any():
                continue
            own = ids[point]
            edge = ~point
            for r, found in inside(x[point], y[point], ids[edge], np.stack([x[edge], y[edge], x2[edge], y2[edge]], axis=1)):
                yield pa.RecordBatch.from_arrays([pa.array(own[found]), pa.array(np.full(len(found), r, np.int64))], ["id", "region"])

    shapes = regions.where(F.col(f"`{region}`").isNotNull() & F.col(f"`{rings}`").isNotNull()).select(F.col(f"`{region}`").cast("bigint").alias("region"), F.col(f"`{rings}`").cast(RINGS).alias("rings"))
    rows = at.mapInArrow(place_points, kind).unionByName(shapes.mapInArrow(place_edges, kind))
    return rows.repartition("task").sortWithinPartitions("task").mapInArrow(sweep, "id bigint, region bigint")
