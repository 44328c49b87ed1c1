from __future__ import annotations

import datetime as dt
import zoneinfo

import pytest

from skylode.operators.timestamps import to_instants
from skylode.operators.versions import current_rows

ZONES = [("norway", "Europe/Oslo"), ("ireland", "Europe/Dublin"), ("ladakh", "Asia/Kolkata"), ("lord howe", "Australia/Lord_Howe"), ("newfoundland", "America/St_Johns"), ("nowhere", "Mars/Base"), ("none", None), (None, "Europe/Oslo")]


def us(*a, offset=0.0, micro=0):
    return int((dt.datetime(*a) - dt.datetime(1970, 1, 1)).total_seconds() - offset * 3600) * 1_000_000 + micro


CASES = [
    ("2020-04-25T11:01:58.288620Z", "norway", us(2020, 4, 25, 11, 1, 58, micro=288620)),
    ("2020-04-25t11:01:58.2886209z", None, us(2020, 4, 25, 11, 1, 58, micro=288620)),
    ("\t2024-08-24 17:42:51\n", "norway", us(2024, 8, 24, 17, 42, 51, offset=2)),
    ("2024-08-24 17:42:51", None, None),
    ("2024-08-24 17:42:51", "elsewhere", None),
    ("2024-08-24 17:42:51", "nowhere", None),
    ("2024-08-24 17:42:51", "none", None),
    ("2019:11:30 14:08:44", "norway", us(2019, 11, 30, 14, 8, 44, offset=1)),
    ("2025-09-18T08:09:19+05:45[Asia/Kathmandu]", None, us(2025, 9, 18, 8, 9, 19, offset=5.75)),
    ("2025-09-18T08:09:19[Asia/Kathmandu]", None, us(2025, 9, 18, 8, 9, 19, offset=5.75)),
    ("2025-09-18T08:09:19[Not/AZone]", "norway", None),
    ("2019-01-09T17:01:14−0330", None, us(2019, 1, 9, 17, 1, 14, offset=-3.5)),
    ("2016-07-20T08:05:05+12", None, us(2016, 7, 20, 8, 5, 5, offset=12)),
    ("2016-07-20T08:05:05+19:00", None, None),
    ("2016-07-17T10:07:55,069+06:00", None, us(2016, 7, 17, 10, 7, 55, offset=6, micro=69000)),
    ("20161107_154432", "norway", us(2016, 11, 7, 15, 44, 32, offset=1)),
    ("20220215T190427Z", None, us(2022, 2, 15, 19, 4, 27)),
    ("10.06.2019 13:51:11", "norway", us(2019, 6, 10, 13, 51, 11, offset=2)),
    ("05/21/2022 2:09 PM", "norway", us(2022, 5, 21, 14, 9, offset=2)),
    ("05/21/2022 12:09 AM", "norway", us(2022, 5, 21, 0, 9, offset=2)),
    ("05/21/2022 13:09 PM", "norway", None),
    ("21/05/2022 2:09 PM", "norway", None),
    ("1688832484", None, 1688832484_000000),
    ("1688832484.5", None, 1688832484_500000),
    ("1519880428232", None, 1519880428232_000),
    ("168883248", None, None),
    ("16888324841", None, None),
    ("Sun, 23 Feb 2025 17:15:08 +0100", None, us(2025, 2, 23, 17, 15, 8, offset=1)),
    ("Mon, 23 Feb 2025 17:15:08 +0100", None, None),
    ("14 Feb 2020 15:48:19 +1345", None, us(2020, 2, 14, 15, 48, 19, offset=13.75)),
    ("Dec 20, 2022 15:24:15", "norway", us(2022, 12, 20, 15, 24, 15, offset=1)),
    ("2018-09-25T07:40Z", None, us(2018, 9, 25, 7, 40)),
    ("2020-366T00:00:00Z", None, us(2020, 12, 31)),
    ("2021-366T00:00:00Z", None, None),
    ("2020-W53-7T10:00:00Z", None, us(2021, 1, 3, 10)),
    ("2021-W53-1T10:00:00Z", None, None),
    ("2021-W01-8T10:00:00Z", None, None),
    ("2024-02-21 09:01:22 CEST", "norway", us(2024, 2, 21, 9, 1, 22, offset=2)),
    ("2024-07-21 09:01:22 IST", "ireland", us(2024, 7, 21, 9, 1, 22, offset=1)),
    ("2024-07-21 09:01:22 IST", "ladakh", us(2024, 7, 21, 9, 1, 22, offset=5.5)),
    ("2024-07-21 09:01:22 IST", "norway", None),
    ("2024-07-21 09:01:22 UTC", None, us(2024, 7, 21, 9, 1, 22)),
    ("2021-02-29 10:00:00", "norway", None),
    ("2021-13-01 10:00:00", "norway", None),
    ("2021-12-01 24:00:00", "norway", None),
    ("2021-12-01 10:00:60", "norway", None),
    ("0000-00-00T00:00:00Z", None, None),
    ("1904-01-01T00:00:00.000000Z", None, us(1904, 1, 1)),
    ("2021-10-12", "norway", None),
    ("13:55:46", "norway", None),
    ("2021-03-28 02:30:00", "norway", us(2021, 3, 28, 1, 30)),  # skipped: an hour on
    ("2021-10-31 02:30:00", "norway", us(2021, 10, 31, 0, 30)),  # twice: the first
    ("2021-10-03 02:15:00", "lord howe", us(2021, 10, 2, 15, 45)),  # a gap of half an hour
    ("2021-04-04 01:45:00", "lord howe", us(2021, 4, 3, 14, 45)),
    ("", "norway", None),
    ("not set", "norway", None),
    (None, "norway", None),
    ("x" * 100_000, "norway", None),
    ("2020-01-01T00:00:00Z tail", "norway", None),
]


@pytest.fixture(scope="module")
def results(spark):
    rows = spark.createDataFrame([(i, t, c, "kept") for i, (t, c, _) in enumerate(CASES)], "id int, captured_at string, country string, captured_us string")
    zones = spark.createDataFrame(ZONES, "country string, tz_name string")
    return {r.id: r.captured_us for r in to_instants(rows, zones).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(results, i):
    assert results[i] == CASES[i][2], CASES[i]


def test_gaps_and_overlaps_match_the_tz_database(spark):
    rows, want = [], []
    for _, name in ZONES[:5]:
        zone = zoneinfo.ZoneInfo(name)
        for hour in range(0, 24 * 366, 7):
            t = dt.datetime(2021, 1, 1) + dt.timedelta(hours=hour, minutes=30)
            rows.append((len(rows), t.strftime("%Y-%m-%d %H:%M:%S"), name))
            want.append(int((t - dt.datetime(1970, 1, 1)).total_seconds() - t.replace(tzinfo=zone).utcoffset().total_seconds()) * 1_000_000)
    zones = spark.createDataFrame([(z, z) for _, z in ZONES[:5]], "country string, tz_name string")
    got = to_instants(spark.createDataFrame(rows, "id int, captured_at string, country string"), zones).orderBy("id").collect()
    assert [r.captured_us for r in got] == want


def test_session_zone_does_not_matter(spark, results):
    zones = spark.createDataFrame(ZONES, "country string, tz_name string")
    rows = spark.createDataFrame([(i, t, c) for i, (t, c, _) in enumerate(CASES)], "id int, captured_at string, country string")
    spark.conf.set("spark.sql.session.timeZone", "America/St_Johns")
    try:
        assert {r.id: r.captured_us for r in to_instants(rows, zones).collect()} == results
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty_tables_and_large_lookup(spark):
    rows = spark.createDataFrame([], "id int, captured_at string, country string, tz_name string")
    zones = spark.createDataFrame([], "country string, tz_name string")
    assert to_instants(rows, zones).collect() == []
    one = spark.createDataFrame([(1, "2020-01-01 00:00:00", "c3")], "id int, captured_at string, country string")
    many = spark.createDataFrame([(f"c{i}", "Europe/Oslo") for i in range(20)], "country string, tz_name string")
    from skylode.operators import timestamps as ts

    wide = ts.zone_lookup(spark, many, "country", "tz_name", at_most=5)
    assert wide.count() == 20
    assert to_instants(one, many).first().captured_us == us(2019, 12, 31, 23)


def test_current_rows(spark):
    rows = spark.createDataFrame([(1, 1, 0.5, "a"), (1, 2, None, None), (1, 2, None, None), (2, None, 0.1, "b"), (2, 1, 0.2, "c"), (None, 9, 1.0, "x")], "id long, v int, x double, s string").selectExpr("id", "timestamp_ntz'2020-01-01' + make_dt_interval(v) as loaded_at", "x", "s", "s AS c0")
    got = {r.id: (r.x, r.s, r.c0) for r in current_rows(rows, "id", "loaded_at", "x", "s", "c0").collect()}
    assert got == {1: (None, None, None), 2: (0.2, "c", "c")}
    assert {r.id: r.x for r in current_rows(rows, "id", "loaded_at", "x").collect()} == {1: None, 2: 0.2}
    assert current_rows(rows.limit(0), "id", "loaded_at", "x").collect() == []
