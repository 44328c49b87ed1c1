"""The core's modules of queries."""

from __future__ import annotations

from types import ModuleType


def modules() -> tuple[ModuleType, ...]:
    from skylode.plans import publishing, sequences, shaping, streams, training

    return (training, sequences, shaping, publishing, streams)
