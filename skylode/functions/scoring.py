"""Scores of shots as Column expressions: clamps, components, weighted means."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weights of the combined score, and the scales of its components.
WEIGHTS = {"aesthetic_score": 0.40, "stability_score": 0.30, "technical_score": 0.20, "motion_score": 0.10}
MOTION_SCALE = 0.04
STILL_RATE = 0.0003
STILL_PIXELS = 0.15
SHARP = 500.0
CLIP_ALLOWED, CLIP_RANGE = 0.02, 0.20


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """``x`` kept within bounds; NULL stays NULL (greatest and least alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def rounded(x: Column, digits: int) -> Column:
    """Rounded half up on the binary value, alike in every engine."""
    k = float(10**digits)
    return F.floor(x * k + 0.5) / k


def motion_score(mean_magnitude: Column, width: Column) -> Column:
    """How much the picture moves, saturating; NULL without flows or a width."""
    return F.when(width > 0, clamp(F.tanh(mean_magnitude / width / MOTION_SCALE)))


def stability_score(mean_magnitude: Column, spread: Column, mean_dx: Column, mean_dy: Column, width: Column) -> Column:
    """How coherent and even the movement is; a still picture is stable. ``spread``: population deviation."""
    still = mean_magnitude < F.when(width > 0, width * STILL_RATE).otherwise(STILL_PIXELS)
    coherence = clamp(F.hypot(mean_dx, mean_dy) / F.nullif(mean_magnitude, F.lit(0.0)))
    consistency = clamp(1.0 - spread / F.nullif(mean_magnitude, F.lit(0.0)))
    return F.when(mean_magnitude.isNotNull(), F.when(still, 1.0).otherwise(clamp(0.65 * coherence + 0.35 * consistency)))


def technical_score(mean_sharpness: Column, mean_clipped: Column) -> Column:
    """Focus and exposure; focus alone where clipping wasn't measured, NULL without sharpness."""
    focus = clamp(mean_sharpness / SHARP)
    exposure = clamp(1.0 - F.greatest(F.lit(0.0), mean_clipped - CLIP_ALLOWED) / CLIP_RANGE)
    return F.when(mean_clipped.isNull(), rounded(focus, 4)).otherwise(rounded(0.6 * focus + 0.4 * exposure, 4))


def combine(scores: Mapping[str, Column], weights: Mapping[str, float] = WEIGHTS) -> Column:
    """Weighted mean over the scores that are there, rounded to 4 digits; NULL if none is."""
    top, over = F.lit(0.0), F.lit(0.0)
    for name, w in weights.items():
        there = scores[name].isNotNull()
        top = top + F.when(there, scores[name] * w).otherwise(0.0)
        over = over + F.when(there, w).otherwise(0.0)
    return rounded(top / F.nullif(over, F.lit(0.0)), 4)


def fails_floor(scores: Mapping[str, Column], floors: Mapping[str, float]) -> Column:
    """Text that names the first score below its floor, or NULL; a missing score never fails."""
    cases = [F.when(scores[n] < f, F.format_string(f"{n.removesuffix('_score')} below floor (%.2f < {f:.2f})", rounded(scores[n], 2))) for n, f in floors.items()]
    return F.coalesce(*cases) if cases else F.lit(None).cast("string")


def brightness(luma: Column) -> Column:
    """The byte that four fifths of the sorted bytes precede, as a share of 255; NULL for none."""
    at = F.least(F.floor(F.size(luma) * 0.8), F.size(luma) - 1).cast("int") + 1
    return F.when(F.size(luma) > 0, F.element_at(F.array_sort(luma), at) / 255.0)


def brightness_of_counts(counts: Column) -> Column:
    """:func:`brightness` of bytes given as a map from byte to how often it occurs; NULL for none."""
    whole = F.aggregate(F.map_values(counts), F.lit(0).cast("bigint"), lambda s, n: s + n)
    place = F.least(F.floor(whole * 0.8), whole - 1)
    zero = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("byte"))

    def step(s: Column, e: Column) -> Column:
        seen = s["seen"] + e["value"]
        return F.struct(seen.alias("seen"), F.coalesce(s["byte"], F.when(seen > place, e["key"])).alias("byte"))

    return F.aggregate(F.array_sort(F.map_entries(counts)), zero, step, lambda s: s["byte"]) / 255.0


def spread(speeds: Column, floor: float = 0.01) -> Column:
    """Fastest over slowest; 1 for none or no movement."""
    top = F.array_max(speeds)
    return F.when(top > 0, top / F.greatest(F.array_min(speeds), F.lit(floor))).otherwise(1.0)


def linear_head(vector: Column, weights: list[float], bias: float = 0.0) -> Column:
    """Dot product of the unit vector in ``vector``'s direction with fixed weights."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    dot = F.aggregate(F.zip_with(as_double, F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate(as_double, F.lit(0.0), lambda s, x: s + x * x))
    return dot / F.nullif(norm, F.lit(0.0)) + bias
