"""From decoded frames to camera movement and scores: numpy kernels over rows, then window functions and aggregates.

A frame is a row of gray bytes. The frame before comes to it by a window that holds one frame, so a scene's pictures are never
together in memory; only numbers leave the kernels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylode.functions import scoring
from skylode.operators import sequences as seq
from skylode.plugins import clipped, sharpness, shift_between

_NUMBERS = ("dx", "dy", "response", "sharpness", "clipped")


def measure(frames: DataFrame, scene: str, order: str, *, time: str = "t", pixels: str = "pixels", width: str = "width") -> DataFrame:
    """(scene, order, start, end, width, dx, dy, response, sharpness, clipped) of each readable frame.

    ``pixels`` are gray bytes, ``width`` a row. Movement is that from the last readable frame, from the time of the frame just before; NULL for
    the first one, and where the picture's size changes. A frame that is NULL, empty, smaller than 3 x 3 or no whole number of rows is
    unreadable and has no row.
    """
    w = Window.partitionBy(scene).orderBy(order)
    p, k = F.col(pixels), F.col(width)
    readable = F.coalesce((k >= 3) & (F.length(p) >= 3 * k) & (F.length(p) % F.greatest(k, F.lit(1)) == 0), F.lit(False))
    seen = F.last(F.when(readable, F.struct(p.alias("p"), k.alias("k"))), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    pairs = frames.select(scene, order, F.lag(time).over(w).alias("start"), F.col(time).alias("end"), k.cast("int").alias("width"), p.alias("__now"), seen["p"].alias("__before"), (seen["k"] == k).alias("__same"), readable.alias("__r")).where("__r").drop("__r")
    kept = [scene, order, "start", "end", "width"]
    schema = T.StructType([*[pairs.schema[c] for c in kept], *[T.StructField(c, T.DoubleType()) for c in _NUMBERS]])

    def one(now: bytes, before: bytes | None, same: bool | None, columns: int) -> tuple[float | None, ...]:
        a = np.frombuffer(now, np.uint8).reshape(-1, columns)
        moved = shift_between(np.frombuffer(before, np.uint8).reshape(-1, columns).astype(np.float64), a.astype(np.float64)) if same and len(before) == len(now) else (None, None, None)
        return (*moved, sharpness(a), clipped(a))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                got = [one(*x) for x in zip(*[part.column(c).to_pylist() for c in ("__now", "__before", "__same", "width")], strict=True)]
                numbers = [pa.array(list(c), pa.float64()) for c in zip(*got, strict=True)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *numbers], schema.fieldNames())

    return pairs.mapInArrow(run, schema)


def profile_motion(measured: DataFrame, scene: str, order: str, width: float, fps: float, m: seq.Motion = seq.Motion()) -> DataFrame:
    """(scene, runs): what the camera does, from rows of :func:`measure`."""
    return seq.segment(measured.where("dx IS NOT NULL AND start IS NOT NULL"), scene, order, width, fps, m)


def score_shots(measured: DataFrame, scene: str) -> DataFrame:
    """(scene, motion, stability, technical) from rows of :func:`measure`; without movements the first two are NULL."""
    far = F.hypot("dx", "dy")
    g = measured.groupBy(scene).agg(F.avg(far).alias("m"), F.stddev_pop(far).alias("sd"), F.avg("dx").alias("x"), F.avg("dy").alias("y"), F.avg("sharpness").alias("sharp"), F.avg("clipped").alias("clip"), F.max("width").cast("double").alias("w"))
    moved = F.col("m").isNotNull()
    motion = F.when(moved, scoring.rounded(scoring.motion_score(F.col("m"), F.col("w")), 4))
    stability = F.when(moved, scoring.rounded(scoring.stability_score(F.col("m"), F.col("sd"), F.col("x"), F.col("y"), F.col("w")), 4))
    return g.select(scene, motion.alias("motion"), stability.alias("stability"), scoring.technical_score(F.col("sharp"), F.col("clip")).alias("technical"))
