"""Changes to the oldest versions of all sources lead to the current ones."""

from __future__ import annotations

import pytest
from conftest import DATA, same_rows

from skylode.plans import shaping


@pytest.mark.parametrize("name", ["s09_upserted", "s11_patched"])
def test_current_rows_come_out(spark, duck, name):
    same_rows(shaping.QUERIES[name](spark, DATA), duck.sql(f"SELECT id, captured_at, gps_lat, gps_lon, width FROM {shaping._SRC}"))


def test_there_are_changes(spark):
    base, changes = shaping._first_and_later(spark, DATA)
    assert 0 < changes.where("has_captured_at OR has_gps_lat OR has_gps_lon").count() < base.count()
