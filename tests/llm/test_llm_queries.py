"""The llm queries against their SQL, and the others for whole and plausible results."""

from __future__ import annotations

import pytest
from conftest import DATA, same_rows

from skylode.llm import bpe, queries

COLUMNS = {"p2_found": ["tag_a", "tag_b"], "p4_found": ["country", "shot_id"], "p5_found": ["country", "motion_class", "score", "pct"], "p6_found": ["source_id", "shot_id"], "p7_ids": ["doc_id", "ids"], "p9_found": ["doc_id"]}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, duck, name):
    same_rows(queries.QUERIES[name](spark, DATA), duck.sql(queries.SQL[name]))


def test_every_query_is_tested():
    assert set(queries.QUERIES) - set(queries.SQL) == {"p5_percentiles", "p7_ids", "p8_mixture", "p8_shares", "p9_found", "p9_scores", "p9_rates"}


def test_percentiles_within_their_error(spark, duck):
    """Every percentile against the exact one, which is interpolated alike."""
    exact = duck.sql(queries._P5.replace("quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.95) AS p95", "quantile_cont(x, [0.05, 0.25, 0.5, 0.75, 0.95]) AS p") + "SELECT country, motion_class, score, n, p FROM q").fetchall()
    want = {(c, m, s, p): (n, v) for c, m, s, n, vs in exact for p, v in zip((5, 25, 50, 75, 95), vs, strict=True)}
    got = {(r.country, r.motion_class, r.score, r.pct): r for r in queries.p5_percentiles(spark, DATA).collect()}
    assert got.keys() == want.keys() and want
    for k, r in got.items():
        assert r.n == want[k][0] and abs(r.value - want[k][1]) <= r.error + 1e-12 and r.rank_error >= 0


def test_ids_read_back(spark):
    """Every document has its ids, and they read back to its text."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = bpe.decode(queries.p7_ids(spark, DATA)).collect()
    assert len(got) == len(texts) and {r.doc_id: r.text or "" for r in got} == {k: v or "" for k, v in texts.items()}


def test_mixture_keeps_caps_and_shares(spark, duck):
    weights = {s: (w, k) for s, w, k in duck.sql("SELECT source, weight, max_repeats FROM mix_targets").fetchall()}
    source = dict(duck.sql("SELECT doc_id, source FROM documents").fetchall())
    rows = queries.p8_mixture(spark, DATA).collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows)
    size: dict[str, int] = {}
    for r in rows:
        assert source[r.doc_id] == r.source and 1 <= r.copies <= weights[r.source][1] and r.n_tokens > 0
        size[r.source] = size.get(r.source, 0) + r.copies * r.n_tokens
    shares = {r.source: r for r in queries.p8_shares(spark, DATA).collect()}
    assert set(shares) == set(weights)
    whole = sum(size.values())
    there = sum(weights[s][0] for s in size)
    every = bpe.count_tokens(spark.read.parquet(f"{DATA}/documents.parquet").select("source", "text")).collect()
    largest = {s: max(r.n_tokens for r in every if r.source == s) for s in size}
    for s, r in shares.items():
        assert r.mixture_size == size.get(s, 0) and abs(r.share - size.get(s, 0) / whole) < 1e-12 and r.most_repeats <= r.max_repeats
        if s in size:  # the goal is missed by less than one record
            assert abs(r.share - weights[s][0] / there) <= (largest[s] + sum(largest.values()) * weights[s][0] / there) / whole


def test_scores_and_rates_cover_all_documents(spark, duck):
    documents = dict(duck.sql("SELECT doc_id, source FROM documents").fetchall())
    scores = queries.p9_scores(spark, DATA).collect()
    assert {r.doc_id: r.source for r in scores} == documents and len(scores) == len(documents)
    assert all(0 <= r.score <= 1 for r in scores)
    found = {r.doc_id for r in queries.p9_found(spark, DATA).collect()}
    assert found == {r.doc_id for r in scores if r.abusive}
    rates = {r.source: r for r in queries.p9_rates(spark, DATA).collect()}
    assert {s: r.documents for s, r in rates.items()} == {s: list(documents.values()).count(s) for s in set(documents.values())}
    assert sum(r.abusive for r in rates.values()) == len(found)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert queries.QUERIES[name](spark, DATA).columns == COLUMNS[name]


def test_nothing_else_imports_llm():
    import pathlib
    import re

    root = pathlib.Path(queries.__file__).parent.parent
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"(from|import)\s+skylode\.llm", p.read_text()), p
