"""Abusive, hateful or sexually explicit passages in texts, by a trained linear model.

Texts are folded (compatibility forms, accents, invisible characters, letters of other alphabets that look
Latin, digits for letters, stretched, spaced, masked and swapped letters) into words. Each passage of a few words, of
several lengths, is a set of hashed word n-grams and skip-grams; a logistic regression trained by
FTRL-proximal scores it, and a text scores as its worst passage, so that one sentence counts the same in a comment and in
a long report. Per-coordinate rates suit features that differ in frequency by orders of magnitude, and the L1 term
leaves few weights, which are broadcast.

Raters make mistakes, and a long text has many passages that could look bad by chance. So a label counts as evidence of
known strength, not as truth: a passage's target is its own probability moved by the odds of its votes. Passages made of words
that many harmless texts share are pushed far below the prior, whatever a few mistaken votes say, and only unfamiliar ones
can rise, so length alone adds no false alarms.

Only the labelled passages decide what is abusive: no word list is given.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylode.llm.spread import spread
from skylode.session import cut

# Letters that look like Latin ones, and digits and signs that are written for letters.
_LOOK = str.maketrans("авеёіјкмнорсԁтухһԛѕνοαερικτυ", "abeeijkmhopcdtyxhqsvoaepiktu")
_CYRILLIC_LOOK = frozenset("авеёіјкмнорсԁтухһԛѕ")
_LEET = str.maketrans("013457@$!|", "oieastasii")

_DROPPED = regex.compile(r"[\p{Cf}\p{Mn}\p{Me}]+")
_WORD = regex.compile(r"[\p{L}\p{N}*@$]+(?:[!|][\p{L}\p{N}*@$]+)*")
_SPACED = regex.compile(r"(?<![\p{L}\p{N}*@$])([\p{L}\p{N}*@$])([ .\-_])(?:[\p{L}\p{N}*@$]\2)+[\p{L}\p{N}*@$](?![\p{L}\p{N}*@$])")
#: The same two for texts of ASCII only, which most are: several times faster.
_ASCII_WORD = re.compile(r"[a-z0-9*@$]+(?:[!|][a-z0-9*@$]+)*")
_ASCII_SPACED = re.compile(r"(?<![a-z0-9*@$])([a-z0-9*@$])([ .\-_])(?:[a-z0-9*@$]\2)+[a-z0-9*@$](?![a-z0-9*@$])")
_NUMBER = regex.compile(r"\p{L}*\d{2,}|\d+\p{L}{0,3}")
_RUN = regex.compile(r"(.)\1+")
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}]")
_FUSED = "\x00"

#: Span in words and offsets of the words that a feature combines.
_GRAMS: tuple[tuple[int, ...], ...] = ((0,), (0, 1), (0, 1, 2), (0, 2), (0, 3), (0, 1, 3), (0, 2, 3))


@dataclass(frozen=True)
class Shape:
    """Parameters of the features: bits of the hash, and (words, stride) of the passages of each length, longest first."""

    bits: int = 20
    passages: tuple[tuple[int, int], ...] = ((8, 2), (5, 1), (3, 1))


def fold(text: str) -> str:
    """Lower case without accents, invisible characters and compatibility forms; spaced words joined."""
    t = text.lower() if text.isascii() else _DROPPED.sub("", unicodedata.normalize("NFKD", text)).casefold()
    return (_ASCII_SPACED if t.isascii() else _SPACED).sub(lambda m: _FUSED + m[0].replace(m[2], "") + _FUSED, t)


def _parts(text: str) -> Iterator[tuple[bool, list[str]]]:
    """Whether they were spaced out, and the raw words, of each part of a text."""
    t = fold(text)
    words = (_ASCII_WORD if t.isascii() else _WORD).findall
    for i, part in enumerate(t.split(_FUSED)):
        yield i % 2 == 1, words(part)


@lru_cache(maxsize=1 << 16)
def plain_word(word: str) -> str:
    """A word without disguises that need no lexicon."""
    if not word.isascii():
        letters = [c for c in word if c.isalpha()]
        if any(c.isascii() for c in letters) or all(c in _CYRILLIC_LOOK for c in letters):
            word = word.translate(_LOOK)
    if _NUMBER.fullmatch(word):
        return regex.sub(r"\d+", "0", word)
    if any(c in "013457@$!|" for c in word):
        word = word.translate(_LEET)
    if word[0] == "*":
        word = word.strip("*")
    return word if "*" in word else _RUN.sub(r"\1", word)


def signature(word: str) -> str:
    """What stays equal when inner letters are swapped."""
    return word if len(word) < 4 else word[0] + "".join(sorted(set(word[1:-1]))) + word[-1]


def _hash(word: str) -> int:
    h = 0xCBF29CE484222325
    for b in word.encode("utf-8", "replace"):
        h = (h ^ b) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return h


class Lexicon:
    """Words of the labelled texts, to read masked and spaced words with."""

    def __init__(self, counts: dict[str, tuple[int, float]]):
        #: word: how often, and how much more often in abusive texts (log odds)
        self.counts = counts
        self.total = sum(n for n, _ in counts.values()) or 1
        self.by_shape: dict[tuple[str, int], list[str]] = {}
        for w in counts:
            self.by_shape.setdefault((w[0], len(w)), []).append(w)
        self.longest = max(map(len, counts), default=1)
        self._known: dict[str, tuple[int, ...]] = {}

    def unmask(self, word: str) -> str:
        """The most telling word that a masked one may stand for; the mask itself if there is none."""
        best, odds = word, -math.inf
        # a mask has the length of the word as written, a lexicon word lost its doubled letters
        for n in range(max(1, len(word) - 2), len(word) + 1):
            for w in self.by_shape.get((word[0], n), ()):
                if self.counts[w][1] > odds and _masks(word, w):
                    best, odds = w, self.counts[w][1]
        return best

    def split(self, fused: str) -> list[str]:
        """The likeliest words that were spaced out together."""
        n = len(fused)
        cost, back = [0.0] + [math.inf] * n, [0] * (n + 1)
        for i in range(n):
            for j in range(i + 1, min(n, i + self.longest) + 1):
                known = self.counts.get(fused[i:j])
                c = cost[i] + (math.log(self.total / known[0]) if known else 12.0 + 6.0 * (j - i))
                if c < cost[j]:
                    cost[j], back[j] = c, i
        out = []
        while n:
            out.append(fused[back[n] : n])
            n = back[n]
        return out[::-1]

    def hashes(self, raw: str, fused: bool) -> tuple[int, ...]:
        """Hashes of the words that a token stands for."""
        key = _FUSED + raw if fused else raw
        got = self._known.get(key)
        if got is None:
            if _CJK.search(raw):
                got = tuple(_hash(c) for c in raw)
            else:
                word = plain_word(raw)
                words = self.split(word) if fused and "*" not in word and len(word) > 3 else [word]
                got = tuple(_hash(signature(self.unmask(w) if "*" in w else w)) for w in words if w)
            if len(self._known) > 500_000:
                self._known.clear()
            if len(raw) <= 64:
                self._known[key] = got
        return got

    def tokens(self, text: str) -> list[int]:
        out: list[int] = []
        known = self._known
        for fused, part in _parts(text):
            for raw in part:
                out += (None if fused else known.get(raw)) or self.hashes(raw, fused)
        return out


def _masks(mask: str, word: str) -> bool:
    """Whether the mask's letters are those of the word; doubled letters may have been lost in the word."""
    pattern = "".join("." if c == "*" else regex.escape(c) for c in mask)
    if len(mask) == len(word):
        return regex.fullmatch(pattern, word) is not None
    # letters at both ends must agree
    head, tail = mask[: mask.index("*")], mask[mask.rindex("*") + 1 :]
    return word.startswith(_RUN.sub(r"\1", head)) and word.endswith(_RUN.sub(r"\1", tail))


def words_of(text: str) -> list[str]:
    """Plain words of a text, without masked and spaced ones: what a lexicon is made of."""
    out = []
    for fused, part in _parts(text):
        if not fused:
            out += [w for raw in part if (raw.isascii() or not _CJK.search(raw)) and (w := plain_word(raw)) and "*" not in w]
    return out


def features(tokens: Sequence[Sequence[int]], shape: Shape) -> tuple[np.ndarray, list[np.ndarray]]:
    """Text of each word, and for each kind of feature the bucket at each word (-1 where it would leave the text)."""
    size = np.array([len(t) for t in tokens], np.int64)
    text = np.repeat(np.arange(len(tokens)), size)
    h = np.array([x for t in tokens for x in t], np.uint64)
    out = []
    for kind, offsets in enumerate(_GRAMS):
        n = max(0, len(h) - offsets[-1])
        x = np.full(n, 0x9E3779B97F4A7C15 * (kind + 1) & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for o in offsets:
            x = (x ^ h[o : o + n]) * np.uint64(0xFF51AFD7ED558CCD)
            x ^= x >> np.uint64(32)
        bucket = np.full(len(h), -1, np.int64)
        bucket[:n] = np.where(text[:n] == text[offsets[-1] : offsets[-1] + n], (x >> np.uint64(64 - shape.bits)).astype(np.int64), -1)
        out.append(bucket)
    return text, out


def passages(size: np.ndarray, words: int, stride: int, longest: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end) of each passage of a length, in order; the last one ends with its text.

    A text of fewer words is one passage if the length is the longest, else it has none.
    """
    n = np.where(size >= words, 1 - (-np.maximum(0, size - words) // stride), np.where(longest & (size > 0), 1, 0))
    text = np.repeat(np.arange(len(size)), n)
    base = np.cumsum(size) - size
    start = (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * stride
    start = base[text] + np.minimum(start, np.maximum(0, size[text] - words))
    return text, start, np.minimum(start + words, base[text] + size[text])


def repeats(text: np.ndarray, bucket: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, earlier position) of features that come again in the same text within ``words`` words."""
    at = np.flatnonzero(bucket >= 0)
    at = at[np.argsort(bucket[at], kind="stable")]
    now, before = at[1:], at[:-1]
    again = (bucket[now] == bucket[before]) & (now - before < words) & (text[now] == text[before])
    return now[again], before[again]


class Ftrl:
    """Logistic regression by FTRL-proximal over sets of features, a batch of sets at a time.

    The intercept stays at ``base``, the log odds of a passage of which nothing is known.
    """

    def __init__(self, n: int, alpha: float = 0.7, beta: float = 1.0, l1: float = 0.2, l2: float = 1.0, base: float = -3.0):
        self.alpha, self.beta, self.l1, self.l2, self.base = alpha, beta, l1, l2, base
        self.z, self.n = np.zeros(n), np.zeros(n)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, size: np.ndarray, evidence: np.ndarray, importance: np.ndarray) -> None:
        """One step over sets of ``size`` features each (``at`` holds them end to end).

        ``evidence`` is the log likelihood ratio of a set's votes; the target is what the model and the votes together say.
        """
        row = np.repeat(np.arange(len(size)), size)
        f, place = np.unique(at, return_inverse=True)
        w = self.weights(f)
        odds = np.bincount(row, weights=w[place], minlength=len(size)) + self.base
        g = (_probability(odds) - _probability(odds + evidence)) * importance
        first = np.bincount(place, weights=g[row], minlength=len(f))
        second = np.bincount(place, weights=(g * g)[row], minlength=len(f))
        n = self.n[f]
        self.z[f] += first - (np.sqrt(n + second) - np.sqrt(n)) / self.alpha * w
        self.n[f] = n + second


def _probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -35, 35)))


@dataclass
class Model:
    """What scoring needs: a few weights, and the lexicon of the labelled texts."""

    shape: Shape
    bucket: np.ndarray
    weight: np.ndarray
    bias: float
    lexicon: dict[str, tuple[int, float]]
    threshold: float = 0.18
    _table: np.ndarray | None = field(default=None, repr=False)
    _words: Lexicon | None = field(default=None, repr=False)

    def score(self, texts: Sequence[str | None]) -> np.ndarray:
        """Probability that the worst passage of each text is abusive; 0 for texts without words.

        A feature counts once a passage, however often the passage repeats it.
        """
        if self._words is None:
            self._words = Lexicon(self.lexicon)
            self._table = np.zeros((1 << self.shape.bits) + 1)
            self._table[self.bucket] = self.weight
        tokens = [self._words.tokens(t) if t else [] for t in texts]
        owner, kinds = features(tokens, self.shape)
        size = np.array([len(t) for t in tokens], np.int64)
        base = np.cumsum(size) - size
        longest = self.shape.passages[0][0]
        found = []
        for offsets, bucket in zip(_GRAMS, kinds, strict=True):
            w = self._table[bucket]  # -1 is the last entry, which weighs 0
            now, before = repeats(owner, np.where(w != 0, bucket, -1), longest)
            found.append((offsets[-1], w, np.concatenate([[0.0], np.cumsum(w)]), now, before))
        worst = np.full(len(texts), -np.inf)
        for words, stride in self.shape.passages:
            text, start, end = passages(size, words, stride, words == longest)
            total = np.full(len(text), self.bias)
            for reach, w, sums, now, before in found:
                total += sums[np.maximum(start, end - reach)] - sums[start]
                if len(now):  # take repeats out of the passages that hold the earlier one too
                    low = np.searchsorted(start, np.maximum(now + reach + 1 - words, base[owner[now]]), "left")
                    n = np.maximum(0, np.searchsorted(start, before, "right") - low)
                    at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                    np.subtract.at(total, at, np.repeat(w[now], n))
            np.maximum.at(worst, text, total)
        return np.where(np.isneginf(worst), 0.0, _probability(worst))


def _passage_sets(tokens: Sequence[Sequence[int]], shape: Shape, chunk: int = 512) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text and set of each passage, features of the distinct sets end to end, size of each set)."""
    known: dict[int, int] = {}
    texts, which, at, sizes = [], [], [], []
    for i in range(0, len(tokens), chunk):
        part = tokens[i : i + chunk]
        _, kinds = features(part, shape)
        size = np.array([len(t) for t in part], np.int64)
        for words, stride in shape.passages:
            text, start, end = passages(size, words, stride, words == shape.passages[0][0])
            columns = []
            for offsets, bucket in zip(_GRAMS, kinds, strict=True):
                for j in range(words - offsets[-1]):
                    columns.append(np.where(start + j + offsets[-1] < end, bucket[np.minimum(start + j, len(bucket) - 1)], -1))
            if not len(text):
                continue
            rows = np.sort(np.stack(columns, 1), 1)
            rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = -1
            kept = rows >= 0
            mixed = (rows.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            name = np.where(kept, mixed ^ (mixed >> np.uint64(32)), np.uint64(0)).sum(1, dtype=np.uint64)
            name, first, place = np.unique(name, return_index=True, return_inverse=True)
            number = np.empty(len(name), np.int64)
            for j, (h, r) in enumerate(zip(name.tolist(), first.tolist(), strict=True)):
                number[j] = known.setdefault(h, len(known))
                if number[j] == len(sizes):
                    at.append(rows[r][kept[r]])
                    sizes.append(len(at[-1]))
            texts.append(text + i)
            which.append(number[place])
    if not sizes:
        return (np.zeros(0, np.int64),) * 4
    return np.concatenate(texts), np.concatenate(which), np.concatenate(at), np.array(sizes, np.int64)


def train(texts: Sequence[str], votes: Sequence[float], shape: Shape = Shape(), *, mistakes: float = 0.08, warm: int = 3, rounds: int = 10, averaged: int = 5, batch: int = 64, most_weight: int = 1000, seed: int = 11, threshold: float = 0.18, **rates: float) -> Model:
    """A model of labelled texts.

    ``votes`` is a text's number of votes for abusive less those against it; each is a mistake with the chance
    ``mistakes``, so that it moves the log odds by a known step. The text is abusive if any of its passages is: votes against it
    speak against each passage, votes for it speak for the one that the model finds worst at the time, and
    a draw says nothing. The first ``warm`` of all passes see only texts voted harmless, so that the words of such
    texts are familiar before any passage has to be blamed; ``rounds`` more see both, and the
    weights are the mean of those after the last ``averaged`` ones. Equal passages of harmless texts are
    learnt as one, with the weight of up to ``most_weight`` of them. Without votes for or against, every text scores
    as the prior.
    """
    votes = np.asarray(votes, float)
    lexicon = _lexicon(texts, votes)
    words = Lexicon(lexicon)
    text, which, at, size = _passage_sets([words.tokens(t) for t in texts], shape)
    n = 1 << shape.bits
    model = Ftrl(n, **rates)
    evidence = votes[text] * math.log((1 - mistakes) / mistakes)
    offset = np.cumsum(size) - size
    good = evidence < 0
    count = np.bincount(which[good], minlength=len(size))
    mean = np.bincount(which[good], weights=evidence[good], minlength=len(size)) / np.maximum(1, count)
    harmless = np.flatnonzero(count)
    accused = np.flatnonzero(evidence > 0)
    w = np.zeros(n)
    rng = np.random.default_rng(seed)
    for i in range(warm + rounds):
        sets, moved, weight = harmless, mean[harmless], np.minimum(most_weight, count[harmless]).astype(float)
        if i >= warm and len(accused):
            odds = np.add.reduceat(np.append(model.weights(at), 0.0), offset) * (size > 0)
            order = accused[np.lexsort((-odds[which[accused]], text[accused]))]
            worst = order[np.append(True, text[order][1:] != text[order][:-1])]
            sets, moved, weight = np.append(sets, which[worst]), np.append(moved, evidence[worst]), np.append(weight, np.ones(len(worst)))
        order = rng.permutation(len(sets))
        for j in range(0, len(order), batch):
            now = order[j : j + batch]
            k = size[sets[now]]
            where = np.repeat(offset[sets[now]] - np.cumsum(k) + k, k) + np.arange(k.sum())
            model.learn(at[where], k, moved[now], weight[now])
        if i >= warm + rounds - averaged:
            w += model.weights() / averaged
    kept = np.flatnonzero(w)
    return Model(shape, kept, w[kept], model.base, lexicon, threshold)


def _lexicon(texts: Sequence[str], votes: np.ndarray) -> dict[str, tuple[int, float]]:
    """Words of two texts or more: how many, and the log odds of being in texts voted abusive."""
    seen, bad = Counter(), Counter()
    for t, y in zip(texts, votes, strict=True):
        w = set(words_of(t))
        seen.update(w)
        if y > 0:
            bad.update(w)
    share = float((votes > 0).mean()) if len(votes) else 0.0
    return {w: (n, math.log((bad[w] + share + 1e-9) / (n - bad[w] + 1 - share + 1e-9))) for w, n in seen.items() if n >= 2}


def labelled(documents: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "abusive", most: int = 20_000, most_chars: int = 60_000_000) -> tuple[list[str], list[float]]:
    """Labelled texts for training, at most ``most`` documents (the lowest by a hash of the id), with their votes.

    A text's votes are those for abusive (1) less those against (0); undecided ones don't count, nor do NULL or empty
    texts. The rows come to the driver: a bounded sample, and an error beyond ``most_chars`` characters. The
    chosen ids, at most ``most``, are broadcast, so that the texts of all documents are read once and none is shuffled.
    """
    votes = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("__k")).agg(F.sum(F.when(F.col(label) > 0, 1.0).otherwise(-1.0)).alias("y"))
    chosen = F.broadcast(votes.orderBy(F.xxhash64("__k"), "__k").limit(most))
    rows = cut(documents.select(F.col(key).alias("__d"), F.col(text).alias("t")).where(F.length("t") > 0).join(chosen, F.col("__d") == F.col("__k")).select("__k", "t", "y"))
    size = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    if size > most_chars:
        raise ValueError(f"{size} characters of labelled texts; lower most or raise most_chars")
    got = sorted(rows.collect())
    return [r.t for r in got], [r.y for r in got]


def score(documents: DataFrame, model: Model, *, text: str = "text", out: str = "score") -> DataFrame:
    """``documents`` without ``text`` but with ``out``: the probability that its worst passage is abusive.

    Every row stays; NULL, empty and wordless texts score 0; whole texts are read.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*[f for f in documents.schema.fields if f.name not in (text, out)], T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                b = batch.slice(i, 512)
                p = pa.array(sent.value.score(b.column(text).to_pylist()))
                yield pa.RecordBatch.from_arrays([*[b.column(n) for n in schema.fieldNames()[:-1]], p], schema.fieldNames())

    return spread(documents).mapInArrow(run, schema)
