"""Pairs of tags that are too rare for p2_found."""

from __future__ import annotations

import itertools
from collections import Counter

from conftest import DATA
from pyspark.sql import functions as F

from skylode.llm import cooccur, queries
from skylode.operators.versions import current_rows
from skylode.sources.tables import read_table


def test_rare_pairs_come_out(spark):
    shots = current_rows(read_table(spark, DATA, "shots"), "id", "loaded_at", "subject_tags", "mood_tags")
    lists = shots.select(*[cooccur.tag_list(F.col(c)).alias(c) for c in ("subject_tags", "mood_tags")]).collect()
    sets = [sorted({*r.subject_tags, *r.mood_tags}) for r in lists]
    one, two = Counter(x for s in sets for x in s), Counter(p for s in sets for p in itertools.combinations(s, 2))
    n = sum(bool(s) for s in sets)
    got = {(r.tag_a, r.tag_b): (r.n_ab, r.n_a, r.n_b, r.n, r.lift) for r in queries.QUERIES["p2_all_pairs"](spark, DATA).collect()}
    assert {p: v[:4] for p, v in got.items()} == {(a, b): (k, one[a], one[b], n) for (a, b), k in two.items()}
    assert all(abs(lift - k / a * n / b) < 1e-5 for k, a, b, n, lift in got.values())
    assert min(v[0] for v in got.values()) == 1
