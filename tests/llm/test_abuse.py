from __future__ import annotations

import random

import numpy as np
import pytest

from skylode.llm import abuse

CALM = ["lovely light over the ridge this morning", "which drone do you use for the slide to the left", "landed with twenty percent and cold hands", "the horizon is crooked and it ruins it", "my stupid thumb covered the lens", "fuck yes adding this to my list", "please do the harbour next it is so peaceful", "we drove all day because of this clip"]
HARSH = ["go away you worthless pig", "shut up you filthy moron", "nobody asked you disgusting idiot", "i hope you fall off that cliff"]
#: Sentences with slots; the tests of unseen phrases hold back combinations of these.
FRAMES = ["what a {a} {n} you are", "tell the pilot he is a {a} {n}", "only a {a} {n} would post that", "get lost you {a} {n}"]
MEAN = ["worthless", "filthy", "disgusting", "pathetic", "rotten", "brainless"]
NAMES = ["pig", "moron", "idiot", "clown", "parasite", "loser"]


def made(n, seed, disguise=None, long=False):
    rng = random.Random(seed)
    texts, labels = [], []
    for _ in range(n):
        bad = rng.random() < 0.3
        parts = [rng.choice(CALM) for _ in range(rng.randint(1, 3) + 60 * long)]
        if bad:
            x = rng.choice(HARSH)
            parts.insert(rng.randint(0, len(parts)), disguise(x, rng) if disguise else x)
        texts.append(rng.choice((". ", " ", "\n")).join(parts))
        labels.append(1.0 if bad else -1.0)
    return texts, labels


@pytest.fixture(scope="module")
def model():
    texts, labels = made(900, 1)
    rng = random.Random(2)
    noisy = [-y if rng.random() < 0.05 else y for y in labels]
    return abuse.train(texts, noisy)


def f1(model, texts, labels):
    got, y = model.score(texts) >= model.threshold, np.array(labels) > 0
    return 2 * (got & y).sum() / max(1, got.sum() + y.sum())


def test_held_out(model):
    assert f1(model, *made(500, 3)) > 0.97
    assert f1(model, *made(100, 4, long=True)) > 0.95


@pytest.mark.parametrize(
    "disguise",
    [
        lambda x, r: x.upper(),
        lambda x, r: "".join(c + "​" if r.random() < 0.3 else c for c in x),
        lambda x, r: x.replace("o", "0").replace("e", "3").replace("i", "1"),
        lambda x, r: " ".join(w[0] + w[1] * 4 + w[2:] if len(w) > 2 else w for w in x.split()),
        lambda x, r: x.replace("a", "а").replace("o", "о"),
        lambda x, r: " ".join(w[0] + w[2] + w[1] + w[3:] if len(w) > 4 else w for w in x.split()),
    ],
    ids=["capitals", "invisible", "digits", "stretched", "look-alikes", "swapped"],
)
def test_disguises(model, disguise):
    assert f1(model, *made(300, 5, disguise)) > 0.9


def test_unseen_phrases():
    """Combinations that no labelled text holds: trained on two thirds of them, with mistaken labels."""
    rng = random.Random(7)
    every = [f.format(a=a, n=n) for f in FRAMES for a in MEAN for n in NAMES]
    rng.shuffle(every)
    known, unseen = every[:96], every[96:]
    texts, votes = [], []
    for _ in range(1500):
        bad = rng.random() < 0.15
        parts = [rng.choice(CALM) for _ in range(rng.randint(1, 4))] + ([rng.choice(known)] if bad else [])
        rng.shuffle(parts)
        texts.append(" ".join(parts))
        votes.append((1.0 if bad else -1.0) * (-1 if rng.random() < 0.05 else 1))
    m = abuse.train(texts, votes)
    got = m.score([f"{rng.choice(CALM)} {x} {rng.choice(CALM)}" for x in unseen]) >= m.threshold
    assert got.mean() >= 0.9  # recall on unseen combinations; 1.0 when written


def test_long_harmless_texts(model):
    """The number of passages alone makes no case."""
    rng = random.Random(8)
    long = [" ".join(rng.choice(CALM) for _ in range(n)) for n in (10, 100, 1000) for _ in range(30)]
    assert (model.score(long) >= model.threshold).sum() == 0


def test_repeated_harmless_words(model):
    """A feature counts once a passage, so repeating a word of an abusive phrase proves nothing more."""
    for word in ("go", "you", "that", "off", "asked", "pig"):
        once, often = model.score([word, " ".join([word] * 9)])
        assert often <= once + 1e-12
    for word in {w for text in CALM for w in text.split()}:
        assert model.score([" ".join([word] * n) for n in (1, 3, 9, 50)]).max() < model.threshold


def test_repeats_count_once():
    m = abuse.train(["go go stop", "go on"], [1.0, -1.0])
    weights = {w: 0.1 for w in range(1 << 20)}
    m.bucket, m.weight, m._words = np.arange(1 << 20), np.full(1 << 20, 0.1), None
    for text in ("a b c d e f g h i j", "a a a a a a", "a b a b a b a b a b a", "a", "a b", "x x y x x y x x z"):
        tokens = m.score([text]) is not None and m._words.tokens(text)
        best = -np.inf
        _, kinds = abuse.features([tokens], m.shape)
        for n, stride in m.shape.passages:
            if len(tokens) < n and n != 8:
                continue
            starts = sorted({min(i, max(0, len(tokens) - n)) for i in range(0, len(tokens), stride)})
            for s in starts:
                e = min(len(tokens), s + n)
                held = {int(k[i]) for o, k in zip(abuse._GRAMS, kinds, strict=True) for i in range(s, e) if i + o[-1] < e}
                best = max(best, m.bias + sum(weights[b] for b in held if b >= 0))
        assert np.isclose(m.score([text])[0], 1 / (1 + np.exp(-best)))


def test_mistaken_votes_about_common_texts():
    """Votes that many others contradict don't count, also where a text says nothing else."""
    votes = [1.0] * 12 + [-1.0] * 188
    m = abuse.train([CALM[0]] * 200 + HARSH * 5, votes + [1.0] * 20)
    assert m.score([CALM[0]])[0] < m.threshold <= m.score([HARSH[0]])[0]


def test_words():
    assert abuse.plain_word("fuuuck") == "fuck" and abuse.plain_word("f3cc14") == "fecia"
    assert abuse.plain_word("nd32") == "nd0" and abuse.plain_word("12") == "0"
    assert abuse.signature("naekd") == abuse.signature("naked")
    lexicon = abuse.Lexicon({"useles": (5, 2.0), "pauvre": (3, 0.0), "type": (3, 0.0), "uniform": (9, -1.0)})
    assert lexicon.unmask("u*eless") == "useles" and lexicon.unmask("q****") == "q****"
    assert lexicon.split("pauvretype") == ["pauvre", "type"]
    assert abuse.fold("a p.a.u.v.r.e t.y.p.e É") == "a \x00pauvre\x00 \x00type\x00 e"


def test_odd_texts(model):
    got = model.score([None, "", "   ", "!!!", "x" * 100_000, "​", "***", "*", "日本語"])
    assert got.shape == (9,) and np.isfinite(got).all() and (got[[0, 1, 2, 3, 5]] == 0).all()


def test_degenerate_training():
    for texts, labels in (([], []), (["a b c"], [0.0]), (["a b c"], [1.0]), (["a b c"], [-1.0]), ([""], [1.0]), (["", "a"], [1.0, -1.0])):
        assert np.isfinite(abuse.train(texts, labels).score(["a b c", ""])).all()


def test_ftrl_is_sparse(model):
    assert 0 < len(model.bucket) < 60_000


def test_operator(spark, model):
    docs = spark.createDataFrame([(1, "go away you worthless pig", "s", 9.0), (2, None, None, 1.0), (2, None, None, 1.0), (3, "", "s", 2.0), (4, CALM[0], "s", 2.0)], "doc_id long, text string, source string, score double")
    got = abuse.score(docs, model).collect()
    assert sorted((r.doc_id, r.score >= model.threshold) for r in got) == [(1, True), (2, False), (2, False), (3, False), (4, False)]
    assert abuse.score(docs.limit(0), model).collect() == []


def test_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, ""), (5, "e")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (1, None), (2, 1), (3, 1), (4, 0), (5, None), (9, 1), (None, 1)], "doc_id long, abusive int")
    assert abuse.labelled(docs, labels) == (["a", "b"], [0.0, 1.0])
    assert len(abuse.labelled(docs, labels, most=1)[0]) <= 1
    with pytest.raises(ValueError, match="characters"):
        abuse.labelled(docs, labels, most_chars=1)
    assert abuse.labelled(docs, labels.limit(0)) == ([], [])
