"""The encoder against a public library's, and against its own decoder."""

from __future__ import annotations

import base64
import random

import pytest
import tiktoken
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st

from skylode.llm import bpe


@pytest.fixture(scope="module")
def both():
    with open(f"{bpe.TOKENIZERS}/byte_bpe_50k.tiktoken", "rb") as f:
        raw = f.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return bpe.Bpe(raw), tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_text(both, text):
    ids = both[0].encode(text)
    assert ids == both[1].encode_ordinary(text)
    assert both[0].decode(ids).decode() == text


@given(st.text(alphabet="abthing é日\n\t 1😀", max_size=80))
@settings(max_examples=300, deadline=None)
def test_mergeable_text(both, text):
    assert both[0].encode(text) == both[1].encode_ordinary(text)


def test_every_token_is_itself(both):
    rng = random.Random(1)
    for i in rng.sample(range(len(both[0].tokens)), 3000):
        assert both[0].encode_bytes(both[0].tokens[i]) == [i]


def test_long_runs_are_linear(both):
    assert len(both[0].encode("ab" * 100_000)) > 0
    assert both[0].decode(both[0].encode("a" * 300_000)) == b"a" * 300_000


def test_multilingual_vocabulary():
    with open(f"{bpe.TOKENIZERS}/byte_bpe_multi_50k.tiktoken", "rb") as f:
        raw = f.read()
    b = bpe.Bpe(raw)
    for t in ("Πολύ όμορφο μέρος!", "風が強くて11分で着陸しました。", "ferme la porte"):
        assert b.decode(b.encode(t)).decode() == t


def test_operator(spark, both):
    rows = [(1, "hello world", "x"), (2, None, "y"), (3, "", None), (4, "  ", "z"), (1, "hello world", "x"), (5, "a" * 50_000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.encode(df)
    assert got.columns == ["doc_id", "text", "ids"]
    assert sorted((r.doc_id, tuple(r.ids)) for r in got.collect()) == sorted((i, tuple(both[1].encode_ordinary(t or ""))) for i, t, _ in rows)
    assert {r.doc_id: r.ids for r in bpe.encode(df, null_ids=(50256,), empty_ids=(0,)).collect()}[2] == [50256]
    assert {r.doc_id: r.n_tokens for r in bpe.count_tokens(df).collect()}[3] == 0
    assert bpe.encode(df.limit(0)).collect() == []
    back = bpe.decode(got.drop("text")).collect()
    assert {r.doc_id: r.text for r in back} == {i: t or "" for i, t, _ in rows}


def test_whole_table(spark, both):
    from skylode.llm.queries import p7_ids

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = p7_ids(spark, DATA).collect()
    assert len(got) == len(texts)
    assert all(r.ids == both[1].encode_ordinary(texts[r.doc_id] or "") for r in got)
