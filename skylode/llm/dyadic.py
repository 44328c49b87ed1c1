"""Percentiles of groups from sketches that add up.

A value in a known range is encoded as a whole number of ``bits`` bits. For every binary resolution that has more cells than
a sketch has counters there is a signed count sketch of the encoded values at that resolution; the coarser ones are counted
in full, which takes less room. Sketches of parts merge by addition, and a row with a
negative weight takes back an earlier one. A percentile descends the resolutions, going left or right by
the estimated count of the left half.

Error: the cell at the finest resolution counted in full is certain, so no estimate is off by more than
``range / 2**exact_bits``. Inside the cell the sketches decide: a level with ``width`` counters a row adds a rank error of about
``sqrt(sum of its squared counts / width)``, which the sketch itself tells; it is reported beside the certain bound.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_ROWS_AT_ONCE = 1 << 17
_HELD_COUNTERS = 1 << 24


@dataclass(frozen=True)
class Dyadic:
    """Shape of a sketch; sketches merge if it is equal."""

    low: float = 0.0
    high: float = 1.0
    bits: int = 24
    width: int = 256
    depth: int = 5
    seed: int = 20_240_229

    @property
    def exact_bits(self) -> int:
        """The finest resolution that has no more cells than a sketch has counters."""
        return min(self.bits, (self.width * self.depth).bit_length() - 1)

    @property
    def counters(self) -> int:
        return (1 << self.exact_bits) + (self.bits - self.exact_bits) * self.depth * self.width

    @property
    def error(self) -> float:
        """What no estimate is off by more than."""
        return (self.high - self.low) / (1 << self.exact_bits)

    def encode(self, x: np.ndarray) -> np.ndarray:
        cell = np.floor((x - self.low) / (self.high - self.low) * (1 << self.bits)).astype(np.int64)
        return np.minimum(cell, (1 << self.bits) - 1)

    def hashed(self, level: int, row: int, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counter and sign of cells at a level."""
        x = cell.astype(np.uint64) + np.uint64((self.seed * 0x9E3779B97F4A7C15 + (level * 64 + row) * 0xD1B54A32D192ED03) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        base = (1 << self.exact_bits) + ((level - self.exact_bits - 1) * self.depth + row) * self.width
        return base + ((x >> np.uint64(1)) % np.uint64(self.width)).astype(np.int64), np.where(x & np.uint64(1), 1, -1)

    def add(self, counters: np.ndarray, group: np.ndarray, code: np.ndarray, weight: np.ndarray) -> None:
        """Adds codes to ``counters`` (groups x counters)."""
        pair, inverse = np.unique(group * (1 << self.bits) + code, return_inverse=True)
        weight = np.bincount(inverse, weights=weight, minlength=len(pair))
        group, code = pair >> self.bits, pair & ((1 << self.bits) - 1)
        at, by = [group * self.counters + (code >> (self.bits - self.exact_bits))], [weight]
        for level in range(self.exact_bits + 1, self.bits + 1):
            for row in range(self.depth):
                where, sign = self.hashed(level, row, code >> (self.bits - level))
                at.append(group * self.counters + where)
                by.append(weight * sign)
        flat = counters.reshape(-1)
        flat += np.bincount(np.concatenate(at), weights=np.concatenate(by), minlength=len(flat)).astype(np.int64)

    def at_rank(self, counters: np.ndarray, rank: int) -> float:
        """About the value that ``rank`` others precede."""
        exact = np.cumsum(counters[: 1 << self.exact_bits])
        cell = int(np.searchsorted(exact, rank, "right"))
        left_of = float(exact[cell - 1]) if cell else 0.0
        count, rest = float(exact[cell]) - left_of, rank - left_of
        for level in range(self.exact_bits + 1, self.bits + 1):
            cell *= 2
            one = np.array([cell])
            guesses = [float(sign[0] * counters[where[0]]) for where, sign in (self.hashed(level, row, one) for row in range(self.depth))]
            left = min(count, max(0.0, float(np.median(guesses))))
            if rest < left or count - left < 0.5:
                count = max(left, 1.0)
            else:
                cell, rest, count = cell + 1, rest - left, count - left
        inside = min(1.0, max(0.0, (rest + 0.5) / max(count, 1.0)))
        return self.low + (cell + inside) * (self.high - self.low) / (1 << self.bits)

    def rank_error(self, counters: np.ndarray) -> float:
        """About what ranks are off by, as a share of the values: the sketches' errors over the levels they stand for."""
        n = int(counters[: 1 << self.exact_bits].sum())
        rows = counters[1 << self.exact_bits :].astype(np.float64).reshape(-1, self.depth, self.width)
        squares = np.median((rows * rows).sum(axis=2), axis=1)
        return float(np.sqrt(squares.sum() / self.width) / n) if n else 0.0

    def percentile(self, counters: np.ndarray, pct: float) -> float:
        """Interpolated linearly between the two nearest ranks."""
        n = int(counters[: 1 << self.exact_bits].sum())
        place = pct / 100 * (n - 1)
        k = math.floor(place)
        a = self.at_rank(counters, k)
        return a if place == k else a + (place - k) * (self.at_rank(counters, k + 1) - a)


def _packed(counters: np.ndarray) -> bytes:
    small = counters.astype(np.int32)
    return b"4" + zlib.compress(small.tobytes(), 1) if (small == counters).all() else b"8" + zlib.compress(counters.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), np.int32 if data[:1] == b"4" else np.int64).astype(np.int64)


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    """Rows as a batch of exactly the declared types."""
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)


def _sketch_type(df: DataFrame, groups: Sequence[str]) -> T.StructType:
    return T.StructType([*[df.schema[g] for g in groups], T.StructField("metric", T.StringType()), T.StructField("sketch", T.BinaryType())])


def build(df: DataFrame, groups: Sequence[str], metrics: dict[str, str], shape: Dyadic = Dyadic(), weight: str | None = None) -> DataFrame:
    """(groups, metric, sketch): for each task a sketch of every group and metric, ready to merge.

    ``metrics`` names value columns. NULL, NaN and values outside the shape's range are left out, as are rows
    with a NULL group. ``weight`` is a column of whole numbers, negative for deletions; NULL weighs nothing.
    """
    names, columns = list(metrics), list(metrics.values())
    rows = df.where(" AND ".join(f"`{g}` IS NOT NULL" for g in groups) or "true").select(*groups, *[F.col(f"`{c}`").cast("double").alias(f"__m{i}") for i, c in enumerate(columns)], (F.col(f"`{weight}`").cast("bigint") if weight else F.lit(1).cast("bigint")).alias("__w"))
    schema = _sketch_type(rows, groups)
    kind = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[tuple, int] = {}
        counters = np.zeros((0, len(names), shape.counters), np.int64)
        held, n = [], 0

        def absorb() -> None:
            nonlocal counters
            t = pa.Table.from_batches(held)
            code, values = np.zeros(t.num_rows, np.int64), [()]
            for g in groups:
                d = t.column(g).combine_chunks().dictionary_encode()
                code = code * max(1, len(d.dictionary)) + d.indices.to_numpy(zero_copy_only=False)
                seen, code = np.unique(code, return_inverse=True)
                k = max(1, len(d.dictionary))
                values = [(*values[x // k], d.dictionary[x % k].as_py()) for x in seen.tolist()]
            here = np.array([ids.setdefault(v, len(ids)) for v in values], np.int64)
            if len(ids) > len(counters):
                counters = np.concatenate([counters, np.zeros((len(ids) - len(counters), len(names), shape.counters), np.int64)])
            group, w = here[code], t.column("__w").to_numpy(zero_copy_only=False).astype(np.float64)
            w = np.where(np.isnan(w), 0, w)
            for i in range(len(names)):
                x = t.column(f"__m{i}").to_numpy(zero_copy_only=False).astype(np.float64)
                good = (x >= shape.low) & (x <= shape.high)
                shape.add(counters, group[good] * len(names) + i, shape.encode(x[good]), w[good])

        def give() -> Iterator[pa.RecordBatch]:
            out = [(*v, names[i], _packed(counters[j, i])) for v, j in ids.items() for i in range(len(names)) if counters[j, i].any()]
            for s in range(0, len(out), 64):
                yield _batch(out[s : s + 64], kind)

        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= _ROWS_AT_ONCE:
                absorb()
                held, n = [], 0
                if counters.size > _HELD_COUNTERS:
                    yield from give()
                    ids.clear()
                    counters = counters[:0]
        if held:
            absorb()
        yield from give()

    return rows.mapInArrow(run, schema)


def _add_up(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of equal keys added up, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None

        def one() -> pa.RecordBatch:
            return _batch([(*key, _packed(total))], kind)

        for b in batches:
            at = list(zip(*[b.column(k).to_pylist() for k in keys], strict=True))
            for k, data in zip(at, b.column("sketch"), strict=True):
                more = _unpacked(data.as_py())
                if k == key:
                    total = total + more
                else:
                    if key is not None:
                        yield one()
                    key, total = k, more
        if key is not None:
            yield one()

    schema = T.StructType([*[parts.schema[k] for k in keys], parts.schema["sketch"]])
    kind = to_arrow_schema(schema)
    return parts.select(*keys, "sketch").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def merge(parts: DataFrame, groups: Sequence[str], tasks: int | None = None) -> DataFrame:
    """One sketch for each group and metric: the sum of those in ``parts``, from whatever rows, days or tasks.

    ``tasks`` says how many sketches a group may have (by default as many as a shuffle has partitions); if they are many,
    they are first added up in salted portions, so that no task reads all of them.
    """
    keys = [*groups, "metric"]
    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")) if tasks is None else tasks
    if tasks > 64:
        salt = F.pmod(F.spark_partition_id(), F.lit(math.isqrt(tasks)))
        parts = _add_up(parts.withColumn("__salt", salt), [*keys, "__salt"])
    return _add_up(parts, keys)


def percentiles(merged: DataFrame, groups: Sequence[str], pcts: Sequence[float], shape: Dyadic = Dyadic()) -> DataFrame:
    """(groups, metric, pct, n, value, error, rank_error): each percentile, what it is off by at most, and about what share of the
    values its rank is off by.

    Groups without a value (or with all taken back) have no row.
    """
    keys = [*groups, "metric"]
    more = [T.StructField("pct", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("value", T.DoubleType()), T.StructField("error", T.DoubleType()), T.StructField("rank_error", T.DoubleType())]
    schema = T.StructType([*[merged.schema[k] for k in keys], *more])
    kind = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for *key, data in zip(*[b.column(k).to_pylist() for k in keys], b.column("sketch").to_pylist(), strict=True):
                counters = _unpacked(data)
                n = int(counters[: 1 << shape.exact_bits].sum())
                if n > 0:
                    off = shape.rank_error(counters)
                    out += [(*key, float(p), n, shape.percentile(counters, p), shape.error, off) for p in pcts]
            if out:
                yield _batch(out, kind)

    return merged.mapInArrow(run, schema)
