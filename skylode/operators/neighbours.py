"""Points near other points on a sphere.

Positions become three-dimensional unit vectors, in which a great-circle radius is one chord length
everywhere, also over the poles and the date line. k-d splits, fitted on a bounded sample, cut the points
into cells; each point goes to its home cell and, as a halo copy, to every other cell within the chord.
A cell is then joined with itself through a local k-d tree. No pair can be missed and none comes twice:
a pair belongs to the home cell of its smaller id, and that cell holds the other point as home or halo.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylode.session import cut

#: Mean radius of the earth in metres.
EARTH_M = 6_371_008.8
_LEAF = 24


def valid_position(lat: str, lon: str):
    """Both values there, in range, not NaN, and not exactly (0, 0)."""
    a, o = F.col(f"`{lat}`").cast("double"), F.col(f"`{lon}`").cast("double")
    return F.coalesce(a.between(-90, 90) & o.between(-180, 180) & ~((a == 0) & (o == 0)), F.lit(False))


def chord(radius_m: float, sphere_m: float) -> float:
    """The straight line in unit vectors that spans ``radius_m`` on the sphere."""
    return 2 * math.sin(min(math.pi / 2, radius_m / sphere_m / 2))


def unit_vectors(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    a, o = np.radians(lat), np.radians(lon)
    c = np.cos(a)
    return np.stack([c * np.cos(o), c * np.sin(o), np.sin(a)], axis=1)


def fit_splits(xyz: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and place of the split of every inner node (heap order, root 1) of a tree ``depth`` deep."""
    axis, place = np.zeros(1 << depth, np.int8), np.zeros(1 << depth)
    groups = [xyz]
    for level in range(depth):
        after = []
        for i, g in enumerate(groups):
            node = (1 << level) + i
            if len(g):
                k = int(np.argmax(np.ptp(g, axis=0)))
                axis[node], place[node] = k, np.median(g[:, k])
            left = g[:, axis[node]] <= place[node]
            after += [g[left], g[~left]]
        groups = after
    return axis, place


def cells_of(xyz: np.ndarray, axis: np.ndarray, place: np.ndarray, depth: int, r: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, home?) of each point and each halo copy: cells that come within ``r`` of the point."""
    row, node, home = np.arange(len(xyz)), np.ones(len(xyz), np.int64), np.ones(len(xyz), bool)
    for _ in range(depth):
        gap = xyz[row, axis[node]] - place[node]
        left, right = gap <= r, gap > -r
        own = gap <= 0
        row = np.concatenate([row[left], row[right]])
        home = np.concatenate([(home & own)[left], (home & ~own)[right]])
        node = np.concatenate([2 * node[left], 2 * node[right] + 1])
    return row, node - (1 << depth), home


class KdTree:
    """A balanced k-d tree in arrays: leaves of about ``_LEAF`` points, a box for every node."""

    def __init__(self, xyz: np.ndarray):
        n = len(xyz)
        self.depth = max(0, math.ceil(math.log2(max(1, n / _LEAF))))
        order, starts = np.arange(n), np.array([0, n])
        for _ in range(self.depth):
            seg = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            here = xyz[order]
            lo, hi = np.minimum.reduceat(here, starts[:-1]), np.maximum.reduceat(here, starts[:-1])
            wide = np.argmax(hi - lo, axis=1)
            order = order[np.lexsort((here[np.arange(n), wide[seg]], seg))]
            mid = (starts[:-1] + starts[1:]) // 2
            starts = np.concatenate([np.stack([starts[:-1], mid], axis=1).ravel(), starts[-1:]])
        self.order, self.starts, self.xyz = order, starts, xyz
        here = xyz[order]
        lo, hi = np.minimum.reduceat(here, starts[:-1]), np.maximum.reduceat(here, starts[:-1])
        self.boxes = [(lo, hi)]
        for _ in range(self.depth):
            lo, hi = np.minimum(lo[::2], lo[1::2]), np.maximum(hi[::2], hi[1::2])
            self.boxes.append((lo, hi))
        self.boxes.reverse()

    def leaf_points(self) -> np.ndarray:
        """(leaves, widest, 3), filled up with NaN."""
        size = np.diff(self.starts)
        out = np.full((len(size), int(size.max(initial=1)), 3), np.nan)
        leaf = np.repeat(np.arange(len(size)), size)
        out[leaf, np.arange(len(self.order)) - self.starts[leaf]] = self.xyz[self.order]
        return out


def pairs_within(a: KdTree, b: KdTree | None, r: float, at_once: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs at most ``r`` apart: between two trees, or inside ``a`` (each pair once) without ``b``.

    Both trees are descended together, level by level, over all node pairs whose boxes come within ``r``;
    leaf pairs are then compared in blocks of about ``at_once`` distances, so memory stays bounded also where
    every point is near every other.
    """
    same, b = b is None, b or a
    if not len(a.order) or not len(b.order):
        return
    p, q = np.zeros(1, np.int64), np.zeros(1, np.int64)
    la = lb = 0
    while la < a.depth or lb < b.depth:
        if la < a.depth:
            p, q, la = np.concatenate([2 * p, 2 * p + 1]), np.concatenate([q, q]), la + 1
        if lb < b.depth:
            p, q, lb = np.concatenate([p, p]), np.concatenate([2 * q, 2 * q + 1]), lb + 1
        if same:
            keep = p <= q
            p, q = p[keep], q[keep]
        (alo, ahi), (blo, bhi) = a.boxes[la], b.boxes[lb]
        apart = np.maximum(0, np.maximum(blo[q] - ahi[p], alo[p] - bhi[q]))
        near = (apart * apart).sum(axis=1) <= r * r
        p, q = p[near], q[near]
    xa, xb = a.leaf_points(), b.leaf_points()
    step = max(1, at_once // (xa.shape[1] * xb.shape[1]))
    for i in range(0, len(p), step):
        pp, qq = p[i : i + step], q[i : i + step]
        d = np.zeros((len(pp), xa.shape[1], xb.shape[1]))
        for k in range(3):
            d += (xa[pp, :, None, k] - xb[qq, None, :, k]) ** 2
        hit = d <= r * r
        if same:
            hit &= (pp != qq)[:, None, None] | (np.arange(xa.shape[1])[:, None] < np.arange(xb.shape[1])[None, :])
        n, u, v = np.nonzero(hit)
        yield a.order[a.starts[pp[n]] + u], b.order[b.starts[qq[n]] + v]


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of equal ``key`` from batches in which equal keys follow each other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy(zero_copy_only=False)
        ends = [*(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), batch.num_rows]
        at = 0
        for end in ends:
            part = batch.slice(at, end - at)
            if held and held[-1].column(key)[-1].as_py() != part.column(key)[0].as_py():
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
            at = end
    if held:
        yield pa.Table.from_batches(held)


def near_pairs(df: DataFrame, radius_m: float, *, key: str = "id", lat: str = "gps_lat", lon: str = "gps_lon", sphere_m: float = EARTH_M, cell_rows: int = 16_384, sample_rows: int = 200_000) -> DataFrame:
    """(id_a, id_b; id_a < id_b): rows of ``df`` at most ``radius_m`` apart on the sphere.

    ``key`` is unique (see :func:`skylode.operators.versions.current_rows`); if it repeats, so do its
    pairs. Rows without a valid position or key give no pair; no rows give none. Equal positions are 0 m
    apart. The splits are fitted on about ``sample_rows`` rows chosen by a hash; every row is then placed. A cell
    that would hold more than twice ``cell_rows`` (many rows at one place) is joined in blocks of row
    subsets, each block pair in its own task, so no task grows with the hottest place. The result itself
    grows with the number of close pairs.
    """
    r = chord(radius_m, sphere_m) * (1 + 1e-12)
    at = cut(df.where(valid_position(lat, lon) & F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{lat}`").cast("double").alias("lat"), F.col(f"`{lon}`").cast("double").alias("lon")))
    n = at.count()
    every = max(1, n // sample_rows)
    depth = max(0, min(20, math.ceil(math.log2(max(1, n / cell_rows)))), 0)
    if depth:
        got = at.where(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(every)) == 0).select("lat", "lon").toArrow()
        xyz = unit_vectors(got.column("lat").to_numpy(), got.column("lon").to_numpy())
    else:
        xyz = np.zeros((0, 3))
    axis, place = fit_splits(xyz, depth)
    blocks = np.ones(1 << depth, np.int64)
    if len(xyz):
        _, cell, _ = cells_of(xyz, axis, place, depth, r)
        size = np.bincount(cell, minlength=1 << depth) * every
        blocks = np.where(size > 2 * cell_rows, -(-size // cell_rows), 1)
    first = np.concatenate([[0], np.cumsum(blocks * blocks)])

    def place_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            v = unit_vectors(b.column(1).to_numpy(), b.column(2).to_numpy())
            row, cell, home = cells_of(v, axis, place, depth, r)
            k = blocks[cell]
            part = (ids[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % k
            # block (i, j), i <= j, holds part i and part j
            again = np.repeat(np.arange(len(row)), k)
            other = np.arange(len(again)) - np.repeat(np.cumsum(k) - k, k)
            row, cell, home, part, k = row[again], cell[again], home[again], part[again], k[again]
            task = first[cell] + np.minimum(part, other) * k + np.maximum(part, other)
            second = part > other
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (task, second, home, ids[row], v[row, 0], v[row, 1], v[row, 2])], ["task", "second", "home", "id", "x", "y", "z"])

    def join_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, "task"):
            ids, home = t.column("id").to_numpy(), t.column("home").to_numpy()
            v = np.stack([t.column(c).to_numpy() for c in ("x", "y", "z")], axis=1)
            at = t.column("task")[0].as_py()
            cell = int(np.searchsorted(first, at, "right")) - 1
            i, j = divmod(at - int(first[cell]), int(blocks[cell]))
            if i == j:
                one = two = np.arange(len(ids))
                found = pairs_within(KdTree(v), None, r)
            else:
                second = t.column("second").to_numpy()
                one, two = np.flatnonzero(~second), np.flatnonzero(second)
                found = pairs_within(KdTree(v[one]), KdTree(v[two]), r)
            for p, q in found:
                p, q = one[p], two[q]
                low = np.where(ids[p] < ids[q], p, q)
                keep = (ids[p] != ids[q]) & home[low]
                a, b = ids[p][keep], ids[q][keep]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["id_a", "id_b"])

    placed = at.mapInArrow(place_rows, "task bigint, second boolean, home boolean, id bigint, x double, y double, z double")
    return placed.repartition("task").sortWithinPartitions("task").mapInArrow(join_rows, "id_a bigint, id_b bigint")
