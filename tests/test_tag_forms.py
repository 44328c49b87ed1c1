"""Tags of comma-separated lists in keywords and in the check of the vocabulary."""

from __future__ import annotations

import json
from collections import Counter

from conftest import DATA

from skylode.functions import text as tx
from skylode.plans import shaping

CURRENT = "SELECT c.*, s.country AS s_country, s.site AS s_site, s.drone_model, s.width FROM {c} AS c LEFT JOIN {s} AS s ON s.id = c.source_id".format(c=shaping._SHOT, s=shaping._SRC)


def elements(text):
    """The elements of a list of tags, in either form; those of comma-separated lists without white space."""
    if text is None:
        return []
    if text.startswith("["):
        try:
            got = json.loads(text)
        except ValueError:
            return []
        return [x if isinstance(x, str) else json.dumps(x) for x in got if x is not None]
    return [x.strip() for x in text.split(",") if x.strip()]


def current(duck):
    r = duck.sql(CURRENT)
    return [dict(zip(r.columns, row, strict=True)) for row in r.fetchall()]


def test_keywords_of_both_forms(spark, duck):
    rows = current(duck)
    want = {}
    for r in rows:
        raw = [*elements(r["subject_tags"]), *elements(r["mood_tags"]), r["s_country"], r["s_site"], *(["aerial", "drone"] if r["drone_model"] else []), *(["4k"] if (r["width"] or 0) >= 3840 else [])]
        terms = [x.replace("-", " ").strip().lower() for x in raw if x]
        want[r["id"]] = "; ".join(dict.fromkeys(t for t in terms if t))
    assert {r.id: r.keywords for r in shaping.QUERIES["f13_keywords"](spark, DATA).collect()} == want
    assert any(not (r["subject_tags"] or "[").startswith("[") for r in rows)


def test_vocabulary_of_both_forms(spark, duck):
    moods = [r["mood_tags"] for r in current(duck)]
    want = Counter(t for m in moods for t in set(elements(m)) - set(tx.MOODS))
    assert {r.tag: r.n for r in shaping.QUERIES["f39_outside_vocabulary"](spark, DATA).where("list = 'mood_tags'").collect()} == want


def test_vocabulary_of_a_comma_list(spark, tmp_path):
    rows = [(1, "storm, Lens flare,, fog ", "shed", 1), (2, '["fog", "fog"]', '["moon", "lake"]', 1), (3, "[broken", None, 1), (4, None, "moon", 1), (5, " ", "", 1), (6, "fog,fog", "moon, moon", 1)]
    spark.createDataFrame(rows, "id bigint, mood_tags string, subject_tags string, loaded_at int").write.parquet(f"{tmp_path}/shots.parquet")
    got = {(r.list, r.tag): r.n for r in shaping.QUERIES["f39_outside_vocabulary"](spark, str(tmp_path)).collect()}
    assert got == {("mood_tags", "Lens flare"): 1, ("mood_tags", "fog"): 3, ("subject_tags", "shed"): 1, ("subject_tags", "moon"): 3}
