"""Parameters of the stages, with defaults that the environment may override."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

from skylode.operators.sequences import Motion


@dataclass(frozen=True)
class Config:
    """Read on the driver only: plans are given values, and no task looks at its environment."""

    archive_root: str = "./input"
    min_shot_seconds: float = 3.0
    motion_sample_fps: float = 4.0
    motion_max_frames: int = 600
    min_reposition_seconds: float = 1.0
    motion_max_rate: float = 1.0
    reject_percentile: float = 0.35
    sample_fps: float = 1.0
    min_render_seconds: float = 0.0
    max_render_seconds: float = 0.0
    window_selection: bool = True
    window_max_spread: float = 3.0

    def motion(self) -> Motion:
        return Motion(min_seconds=self.min_shot_seconds, min_reposition=self.min_reposition_seconds, max_rate=self.motion_max_rate, max_spread=self.window_max_spread)


def from_env(env: Mapping[str, str] | None = None) -> Config:
    """Defaults, with each field that the environment names in capitals; blank values count as unset, others must be of the field's type."""
    env = os.environ if env is None else env
    got = {}
    for f in fields(Config):
        text = env.get(f.name.upper(), "").strip()
        if not text:
            continue
        kind = type(f.default)
        if kind is bool:
            if text.lower() not in ("1", "true", "yes", "on", "0", "false", "no", "off"):
                raise ValueError(f"{f.name.upper()} isn't yes or no: {text}")
            got[f.name] = text.lower() in ("1", "true", "yes", "on")
        else:
            try:
                got[f.name] = kind(text)
            except ValueError:
                raise ValueError(f"{f.name.upper()} isn't a number: {text}") from None
    return Config(**got)
