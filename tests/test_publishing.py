"""Captions, crops, commands, answers and posts, value by value."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylode.functions import render, responses
from skylode.functions import text as tx
from skylode.sources import files, store


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_captions(spark):
    rows = [("new-zealand", "2021-05-01"), (None, None), ("iceland", None), ("", "1999")]
    got = values(spark, render.caption(F.lit("Up"), F.col("c"), F.col("t")), rows, "c string, t string")
    gap = "\n" + "⠀\n" * 10 + "\n"
    assert got == [f"Up{gap}New-Zealand · 2021", "Up", f"Up{gap}Iceland", f"Up{gap}1999"]


def test_overlays_and_palette(spark):
    rows = [("peru", "", "2020-1"), (None, None, None), ("a", "b", "")]
    assert values(spark, render.overlay_lines(F.lit("Up"), F.col("t"), F.col("c"), F.col("s")), rows, "c string, s string, t string") == [["Up", "2020 · peru"], ["Up"], ["Up", "b · a"]]
    got = values(spark, render.palette(F.col("x")), [(0.61,), (0.6,), (None,)], "x double")
    assert [tuple(r) for r in got] == [("black", "white@0.55"), ("white", "black@0.55"), ("white", "black@0.55")]


def test_crops(spark):
    rows = [(3840, 2160, None), (1920, 1080, 0.0), (1920, 1080, 1.0), (1920, 1080, 0.5), (1080, 1920, None), (1000, 3000, None), (0, 10, None), (None, 10, 0.5), (1280, 720, None)]
    got = values(spark, render.crop_filter(F.col("w"), F.col("h"), F.col("x")), rows, "w int, h int, x double")
    assert got == ["crop=1214:2160", "crop=608:1080:0:0", "crop=608:1080:1312:0", "crop=608:1080:656:0", None, "crop=1000:1778", None, None, "crop=404:720"]
    assert values(spark, F.array(*render.upright_size(F.col("h"))), [(1920,), (721,)], "h int") == [[1080, 1920], [406, 720]]


def test_escapes_and_ends(spark):
    assert values(spark, render.escaped(F.col("x")), [("Vlorë: old 'town' 5% a\\b",)], "x string") == ["Vlorë\\: old \\'town\\' 5\\% a\\\\b"]
    rows = [(1.0, 50.0), (1.0, 5.0), (1.0, None)]
    assert values(spark, render.clip_end(F.col("a"), F.col("b"), 20.0), rows, "a double, b double") == [21.0, 5.0, None]
    assert values(spark, render.clip_end(F.col("a"), F.col("b")), rows, "a double, b double") == [50.0, 5.0, None]


def test_commands(spark):
    df = spark.createDataFrame([("a b.mp4", 1.0, 2.5)], "s string, a double, b double")
    social = render.social_command(F.col("s"), F.lit("o.mp4"), F.col("a"), F.col("b"), F.lit(1080), F.lit(1920), F.lit(None).cast("double"), F.array(F.lit("One"), F.lit("two")), render.palette(F.lit(0.9)), font_file="C:/f.ttf")
    got = df.select(social, render.master_command(F.col("s"), F.lit("o.mov"), F.col("a"), F.col("b"), F.lit("prores_ks"))).first()
    assert got[0][:10] == ["ffmpeg", "-hide_banner", "-loglevel", "error", "-y", "-ss", "1.000", "-to", "2.500", "-i"] and got[0][-2:] == ["-an", "o.mp4"]
    chain = got[0][got[0].index("-vf") + 1]
    assert chain.startswith("scale=1080:1920,setsar=1,drawtext=text='One':fontfile='C\\:/f.ttf':fontcolor=black:fontsize=h/16:") and "y=h*0.780" in chain and chain.count("drawtext") == 2
    assert got[1][-6:] == ["prores_ks", "-profile:v", "3", "-c:a", "copy", "o.mov"]


def test_error_texts(spark):
    rows = [(400, json.dumps({"message": "Bad", "issues": [{"path": ["a", 1], "message": "no"}]})), (401, '{"error":"denied"}'), (500, "<html>\nx"), (503, None), (400, "null"), (400, '{"message":{"message":"deep"}}')]
    assert values(spark, responses.error_text(F.col("s"), F.col("b")), rows, "s int, b string") == ["Bad (a.1: no)", "denied — check the key", "invalid response (HTTP 500): <html> x", "{}", "null", "deep"]
    assert values(spark, responses.retryable(F.col("s")), [(429,), (400,), (None,)], "s int") == [True, False, False]


def test_deliveries(spark):
    kind = "p array<struct<platform: string, status: string, error: string>>"
    rows = [([("a", "DONE", None), ("b", "Failed", " why "), None, (None, None, "")],), ([],), (None,), ([("a", "x", None), ("a", "y", None)],)]
    got = values(spark, responses.delivery(F.col("p")), rows, kind)
    assert got == [{"a": "done", "b": "failed: why", "?": "unknown"}, {}, None, {"a": "y"}]
    assert values(spark, responses.failed_delivery(responses.delivery(F.col("p"))), rows, kind) == [True, False, None, False]


def test_answers(spark):
    rows = [('{"accounts":[{"platform":"a","_id":"1"},{"platform":"","_id":"2"},{"platform":"c"}]}',), ('[{"platform":"b","_id":"9"}]',), ("no",), (None,)]
    got = values(spark, responses.account_rows(F.col("x")), rows, "x string")
    assert [None if g is None else [tuple(r) for r in g] for g in got] == [[("a", "1")], [("b", "9")], None, None]
    r = spark.createDataFrame([('{"post":{"_id":"7","platforms":[{"platform":"a","accountId":"1","status":"OK"}]}}',), ("{}",)], "x string").select(responses.published(F.col("x")).alias("p")).select("p.*").collect()
    assert tuple(r[0]) == ("7", {"a": "1"}, {"a": "ok"}) and tuple(r[1]) == (None, None, None)


def test_posts(spark):
    rows = [({"instagram": "i"}, "u", 1500, " hi "), ({"instagram": "i", "tiktok": "t"}, None, None, "x"), ({}, "u", None, "x"), (None, "u", None, "x"), ({"youtube": "y"}, "", None, "  ")]
    df = spark.createDataFrame(rows, "a map<string, string>, u string, c int, t string")
    got = df.select(responses.post_body(F.col("t"), F.col("a"), F.col("u"), F.lit("video"), F.lit(None).cast("string"), F.col("c")), responses.post_problem(F.col("a"), F.col("u"))).collect()
    assert json.loads(got[0][0]) == {"content": "hi", "platforms": [{"platform": "instagram", "accountId": "i", "platformSpecificData": {"contentType": "reels", "shareToFeed": True, "thumbOffset": 1500000}}], "publishNow": True, "mediaItems": [{"url": "u", "type": "video"}]}
    assert [g[1] for g in got] == [None, "instagram, tiktok require media", "no connected accounts", "no connected accounts", None] and got[1][0] is None
    assert json.loads(got[4][0]) == {"content": " ", "platforms": [{"platform": "youtube", "accountId": "y"}], "publishNow": True}


def test_content_types(spark):
    names = [("A.MP4",), ("x.y/b",), ("a.webp",), (None,), ("a.b.MOV",)]
    assert values(spark, responses.content_type(F.col("n")), names, "n string") == ["video/mp4", None, "image/webp", None, "video/quicktime"]
    assert values(spark, responses.media_kind(F.col("n")), names, "n string") == ["video", None, "image", None, "video"]


@pytest.mark.parametrize(("x", "want"), [(3.0, "3"), (2.5, "2.5"), (0.125, "0.125"), (100.0, "100")])
def test_number_texts(spark, x, want):
    assert values(spark, tx.number_text(F.col("x")), [(x,)], "x double") == [want]


def test_stamps(spark):
    rows = [("2024-02-29 23:59:59",), ("2023-02-29 00:00:00",), ("2024-1-1 00:00:00",), ("2024-01-01T00:00:00",), (None,), ("2024-01-01 24:00:00",)]
    assert values(spark, tx.stamp(tx.parsed_stamp(F.col("x"))), rows, "x string") == ["2024-02-29 23:59:59", None, None, None, None, None]


def test_vendor_tags_go_first(spark):
    doc = {"format": {"duration": "42.5", "tags": {"com.apple.quicktime.location.ISO6709": "+41.3275+019.8187/", "location": "+1+1/", "com.apple.quicktime.make": "", "make": "M", "Com.Apple.QuickTime.Model": "X"}}, "streams": [{"codec_type": "video", "width": 3840, "height": 2160, "tags": {"model": "lens", "creation_time": "t"}}]}
    p = files.probe_fields(F.col("d"))
    r = spark.createDataFrame([(json.dumps(doc),), ("{}",), ("no",)], "d string").select(*[c.alias(n) for n, c in p.items()]).collect()
    assert (r[0].gps_lat, r[0].gps_lon, r[0].drone_model, r[0].captured_at, r[0].duration) == (41.3275, 19.8187, "M X", "t", 42.5)
    assert all(x is None for x in r[1]) and all(x is None for x in r[2])


def test_migration(spark, tmp_path):
    s = store.SnapshotStore(spark, str(tmp_path))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("purged_at", T.StringType())])
    assert s.version("sources") is None and not s.migrate("sources", schema)
    s.write("sources", spark.createDataFrame([(1,)], "id int"), version=1)
    assert s.version("sources") == 1 and s.migrate("sources", schema)
    assert s.version("sources") == store.SCHEMA_VERSION and not s.migrate("sources", schema)
    assert [tuple(r) for r in s.read("sources").collect()] == [(1, None)]
