"""Interfaces to what lies outside the data: models that see frames, services that publish.

Each has a stand-in that needs nothing. Kernels on decoded frames are plain numpy; an operator applies them
to Arrow batches, and a frame that can't be read gives NULL instead of ending the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


class AestheticScorer(Protocol):
    def __call__(self, frames: Sequence[bytes]) -> float | None: ...


class Tagger(Protocol):
    def __call__(self, frames: Sequence[bytes], facts: dict[str, Any]) -> dict[str, Any]: ...


class Publisher(Protocol):
    def publish(self, path: str, caption: str) -> str | None: ...


def no_score(frames: Sequence[bytes]) -> float | None:
    """A scorer without a model: nothing is known."""
    return None


class WordTagger:
    """A tagger that finds vocabulary words in a shot's own texts; for tests and dry runs."""

    def __init__(self, words: Sequence[str]):
        self.words = tuple(words)

    def __call__(self, frames: Sequence[bytes], facts: dict[str, Any]) -> dict[str, Any]:
        text = " ".join(str(v) for v in facts.values() if v).lower()
        return {"subject_tags": [w for w in self.words if w.replace("-", " ") in text]}


class DryRun:
    """A publisher that only notes what it would do."""

    def __init__(self) -> None:
        self.noted: list[tuple[str, str]] = []

    def publish(self, path: str, caption: str) -> str | None:
        self.noted.append((path, caption))
        return None


def sharpness(frame: np.ndarray) -> float:
    """Variance of the Laplacian of a gray frame."""
    g = frame.astype(np.float64)
    lap = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
    return float(lap.var())


def clipped(frame: np.ndarray) -> float:
    """Share of pixels that are nearly black or nearly white."""
    return float(((frame <= 4) | (frame >= 251)).mean())


def shift_between(a: np.ndarray, b: np.ndarray) -> tuple[float, float, float]:
    """(dx, dy, response) of the movement from gray frame ``a`` to ``b``: phase correlation under a Hann window.

    The response is the share of the correlation around its peak, near 1 for a clean shift.
    """
    w = np.outer(np.hanning(a.shape[0]), np.hanning(a.shape[1]))
    fa, fb = np.fft.rfft2(a * w), np.fft.rfft2(b * w)
    cross = fb * np.conj(fa)
    c = np.fft.irfft2(cross / np.maximum(np.abs(cross), 1e-12), s=a.shape)
    y, x = np.unravel_index(int(np.argmax(c)), c.shape)
    rows, cols = (np.arange(-2, 3) + y) % c.shape[0], (np.arange(-2, 3) + x) % c.shape[1]
    near = np.maximum(c[np.ix_(rows, cols)], 0)
    total = near.sum() or 1.0
    dy, dx = y + (near.sum(axis=1) * np.arange(-2, 3)).sum() / total, x + (near.sum(axis=0) * np.arange(-2, 3)).sum() / total
    dy, dx = (dy - c.shape[0] if dy > c.shape[0] / 2 else dy), (dx - c.shape[1] if dx > c.shape[1] / 2 else dx)
    return float(dx), float(dy), float(min(1.0, total))


def apply_kernel(df: DataFrame, pixels: str, width: str, kernel: Callable[[np.ndarray], float], out: str) -> DataFrame:
    """``df`` without ``pixels`` (gray bytes, ``width`` a row) but with ``out``; NULL where it isn't a picture."""
    schema = T.StructType([*[f for f in df.schema.fields if f.name not in (pixels, out)], T.StructField(out, T.DoubleType())])

    def one(data: bytes | None, columns: int | None) -> float | None:
        try:
            return kernel(np.frombuffer(data, np.uint8).reshape(-1, columns))
        except (TypeError, ValueError, IndexError):
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [one(d, w) for d, w in zip(b.column(pixels).to_pylist(), b.column(width).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in schema.fieldNames()[:-1]], pa.array(got, pa.float64())], schema.fieldNames())

    return df.mapInArrow(run, schema)
