from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylode import plugins
from skylode.functions import scoring
from skylode.functions import text as tx
from skylode.sources import files, store
from skylode.streaming import streams


def values(spark, column, rows, kind="x string"):
    return [r.y for r in spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], kind).select(column.alias("y")).collect()]


def test_slugs(spark):
    got = values(spark, tx.slug(F.col("x"), "none"), ["  Lake Ohrid ", 'a<b>:"c"', "...", None, "CON", "com3", "x.", "ä" * 300, "a \t b", "-x-"])
    assert got == ["lake-ohrid", "abc", "none", "none", "con-", "com3-", "x", "ä" * 64, "a-b", "x"]


def test_titles(spark):
    assert values(spark, tx.title_case(F.col("x")), ["new-zealand o'neil", "ÉTÉ là", "", None]) == ["New-Zealand O'Neil", "Été Là", "", None]
    got = values(spark, tx.title(F.col("x"), F.lit("bay"), F.lit("peru")), ["A boat. Two", " , then", "", None, "x" * 200])
    assert got == ["A boat", "Bay · Peru", "Bay · Peru", "Bay · Peru", "x" * 120]


def test_names_and_numbers(spark):
    assert values(spark, tx.frame_rate(F.col("x")), ["30000/1001", "25", "0/0", "1/0", "x", "", None, "0/1"]) == [29.97, 25.0, None, None, None, None, None, None]
    assert values(spark, tx.year_of(F.col("x")), ["2020-01-01", "20", "x", "", None]) == ["2020", "20", "undated", "undated", "undated"]
    assert values(spark, tx.country_of(F.col("x")), ["New_Zealand/a.mp4", "a.mp4", None]) == ["new zealand", None, None]
    assert values(spark, tx.aspect_label(F.col("w"), F.col("h")), [(1920, 1080), (1080, 1920), (4096, 2160), (1000, 1000), (0, 5), (7, None)], "w int, h int") == ["16:9", "9:16", "55:29", "1:1", None, None]
    assert values(spark, tx.shot_stem(F.col("i"), F.lit("a/B c.MP4"), F.lit(None).cast("string")), [(7,), (12345678,)], "i long") == ["000007_b-c", "12345678_b-c"]
    assert values(spark, tx.last_wins(F.array(F.lit("a"), F.lit("b"), F.lit("a")), F.array(F.lit(1), F.lit(2), F.lit(3))), ["x"]) == [{"b": 2, "a": 3}]


def test_scores(spark):
    one = scoring.combine({"aesthetic_score": F.col("a"), "stability_score": F.col("b"), "technical_score": F.lit(None).cast("double"), "motion_score": F.lit(None).cast("double")})
    assert values(spark, one, [(1.0, 0.0), (None, 0.5), (None, None)], "a double, b double") == [0.5714, 0.5, None]
    assert values(spark, scoring.clamp(F.col("x")), [(2.0,), (-1.0,), (None,)], "x double") == [1.0, 0.0, None]
    assert values(spark, scoring.brightness(F.col("x")), [([20] * 12 + [230] * 4,), ([],), ([1, 2, 3, 4, 5],), (None,)], "x array<int>") == [230 / 255, None, 5 / 255, None]


def test_store(spark, tmp_path):
    s = store.SnapshotStore(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        s.read("t")
    s.write("t", spark.range(3))
    first = s.current("t")
    old = s.read("t")
    s.write("t", spark.range(5))
    assert s.current("t") != first and s.read("t").count() == 5 and old.count() == 3


def test_changes(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, x string, y int")
    up = store.upsert(base, spark.createDataFrame([(2, None), (3, "c")], "id int, x string"), "id")
    assert sorted(map(tuple, up.collect())) == [(1, "a", 1), (2, None, 2), (3, "c", None)]
    changes = spark.createDataFrame([(1, None, True), (2, "z", False), (9, "q", True)], "id int, x string, f boolean")
    assert sorted(map(tuple, store.patch(base, changes, "id", {"x": "f"}).collect())) == [(1, None, 1), (2, "b", 2)]
    assert store.upsert(base.limit(0), base, "id").count() == 2
    assert [tuple(r) for r in store.repeated(base.union(base), "id").orderBy("id").collect()] == [(1, 2), (2, 2)]


def test_files(spark, tmp_path):
    for n in ("a/DJI_1.MP4", ".hidden/x.mov", "a/.y.mp4", "a/z.txt"):
        p = tmp_path / n
        p.parent.mkdir(exist_ok=True)
        p.write_bytes(b"12345")
    got = files.scan_videos(spark, str(tmp_path)).collect()
    assert [os.path.basename(r.path) for r in got if "hidden" not in r.path] == ["DJI_1.MP4"]
    assert got[0].size_bytes == 5
    p = files.probe_fields(F.col("x"))
    bad = spark.createDataFrame([("not json",), (None,), ("{}",)], "x string").select(*[c.alias(n) for n, c in p.items()]).collect()
    assert all(r.width is None and r.captured_at is None for r in bad)
    assert files.write_manifest(spark.range(0), str(tmp_path / "m")) == 0 and not (tmp_path / "m").exists()
    assert files.write_manifest(spark.range(2), str(tmp_path / "m")) == 2


def test_streams(spark, tmp_path):
    source, target, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    make = lambda ids: spark.createDataFrame([(f"f{i}", i, 1.0, 0) for i in ids], "path string, size_bytes long, mtime double, s int").selectExpr("*", "timestamp_seconds(1700000000 + s) as seen")
    make([1, 2, 2]).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    run = lambda: streams.work_off(streams.changed_files(streams.file_stream(spark, source, schema), "seen"), target, state)
    run()
    assert spark.read.parquet(target).count() == 2
    make([2, 3]).write.mode("append").parquet(source)
    run()
    assert sorted(r.path for r in spark.read.parquet(target).collect()) == ["f1", "f2", "f3"]


def test_kernels(spark):
    rng = np.random.default_rng(0)
    big = rng.random((96, 96))
    for _ in range(2):
        big = (big + np.roll(big, 1, 0) + np.roll(big, 1, 1)) / 3
    dx, dy, response = plugins.shift_between(big[10:74, 10:74], big[13:77, 6:70])
    assert abs(dx - 4) < 0.6 and abs(dy + 3) < 0.6 and response > 0.1
    flat = np.full((8, 8), 100, np.uint8)
    assert plugins.sharpness(flat) == 0 and plugins.clipped(flat) == 0 and plugins.clipped(flat * 0) == 1
    df = spark.createDataFrame([(1, bytearray(flat.tobytes()), 8), (2, None, 8), (3, bytearray(b"123"), 8)], "id int, px binary, w int")
    assert {r.id: r.s for r in plugins.apply_kernel(df, "px", "w", plugins.sharpness, "s").collect()} == {1: 0.0, 2: None, 3: None}
    assert plugins.no_score([]) is None
    assert plugins.WordTagger(["golden-hour", "mist"])([], {"t": "Golden hour at sea"}) == {"subject_tags": ["golden-hour"]}
    d = plugins.DryRun()
    assert d.publish("a", "b") is None and d.noted == [("a", "b")]


def test_brightness_of_counts(spark):
    rows = [({20: 12, 230: 4},), ({},), ({1: 1, 2: 1, 3: 1, 4: 1, 5: 1},), (None,), ({0: 10**12},)]
    assert values(spark, scoring.brightness_of_counts(F.col("x")), rows, "x map<int, bigint>") == [230 / 255, None, 5 / 255, None, 0.0]
