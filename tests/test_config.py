from __future__ import annotations

import pytest

from skylode.config import Config, from_env


def test_defaults_and_overrides():
    assert from_env({}) == Config()
    got = from_env({"MIN_SHOT_SECONDS": "2.5", "WINDOW_SELECTION": "off", "MOTION_MAX_FRAMES": "10", "SAMPLE_FPS": " "})
    assert (got.min_shot_seconds, got.window_selection, got.motion_max_frames, got.sample_fps) == (2.5, False, 10, 1.0)
    assert got.motion().min_seconds == 2.5


@pytest.mark.parametrize("env", [{"SAMPLE_FPS": "fast"}, {"WINDOW_SELECTION": "maybe"}, {"MOTION_MAX_FRAMES": "1.5"}])
def test_wrong_types(env):
    with pytest.raises(ValueError, match="isn't"):
        from_env(env)
