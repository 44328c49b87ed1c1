"""All fields of manifests and side documents, against rows made in Python."""

from __future__ import annotations

import json
import math

from conftest import DATA
from test_tag_forms import elements

from skylode.plans import shaping

FIELDS = "shot_id file title description keywords country site captured_at gps_lat gps_lon drone_model width height fps duration_seconds license_tier aesthetic_score technical_score".split()
SQL = """SELECT c.*, coalesce(c.inferred_site, s.site) AS place, s.country, s.captured_at, s.gps_lat, s.gps_lon, s.drone_model, s.width, s.height, s.fps, s.aspect, s.relpath
    FROM {c} AS c JOIN {s} AS s ON s.id = c.source_id""".format(c=shaping._SHOT, s=shaping._SRC)


def current(duck):
    r = duck.sql(SQL)
    return {row["id"]: row for row in (dict(zip(r.columns, x, strict=True)) for x in r.fetchall())}


def title(r):
    return (" · ".join(x for x in (r["place"], r["country"]) if x) or "Aerial footage").title()


def words(r):
    raw = [*elements(r["subject_tags"]), *elements(r["mood_tags"]), r["country"], r["place"], *(["aerial", "drone"] if r["drone_model"] else []), *(["4k"] if (r["width"] or 0) >= 3840 else [])]
    return list(dict.fromkeys(t for x in raw if x and (t := x.replace("-", " ").strip().lower())))


def seconds(r):
    return math.floor((r["out_point"] - r["in_point"]) * 1000 + 0.5) / 1000


def number(x):
    """Comparable, whether text or number; NaN as text."""
    x = None if x in (None, "") else float(x)
    return "nan" if x is not None and x != x else x


def test_manifest_fields(spark, duck):
    want = current(duck)
    df = shaping.QUERIES["s13_manifest"](spark, DATA)
    assert df.columns == FIELDS
    got = df.collect()
    assert {r.shot_id for r in got} == set(want) and len(got) == len(want)
    for g in got:
        r = want[g.shot_id]
        assert (g.title, g.description, g.keywords) == (title(r), "", "; ".join(words(r)))
        assert (g.country, g.site, g.captured_at, g.drone_model, g.license_tier) == tuple(r[c] or "" for c in ("country", "place", "captured_at", "drone_model", "license_tier"))
        assert g.duration_seconds == seconds(r)
        assert g.file.startswith((r["country"] or "unknown-country").lower().replace(" ", "-")) and f"/{r['id']:06d}_" in g.file and g.file.endswith(".mp4")
        for c in ("gps_lat", "gps_lon", "aesthetic_score", "technical_score"):
            assert getattr(g, c) is not None and number(getattr(g, c)) == number(r[c])
        for c in ("width", "height", "fps"):
            assert getattr(g, c) != "0" and number(getattr(g, c)) == number(r[c] or None)


def test_side_document_fields(spark, duck):
    want = current(duck)
    got = {r.id: json.loads(r.document) for r in shaping.QUERIES["s14_side_documents"](spark, DATA).collect()}
    assert set(got) == set(want)
    for i, d in got.items():
        r = want[i]
        scores = [number(d["editorial"].pop(c)) for c in ("aesthetic_score", "technical_score")]
        assert scores == [number(r[c]) for c in ("aesthetic_score", "technical_score")]
        assert d == {
            "shot_id": i, "title": title(r), "description": None, "keywords": words(r),
            "location": {"country": r["country"], "site": r["place"], "latitude": r["gps_lat"], "longitude": r["gps_lon"]},
            "capture": {"captured_at": r["captured_at"], "drone_model": r["drone_model"]},
            "technical": {"width": r["width"], "height": r["height"], "fps": r["fps"], "duration_seconds": seconds(r), "aspect": r["aspect"]},
            "editorial": {"person_in_frame": bool(r["person_in_frame"]), "license_tier": r["license_tier"]},
            "provenance": {"source_file": r["relpath"], "in_point": r["in_point"], "out_point": r["out_point"]},
        }
