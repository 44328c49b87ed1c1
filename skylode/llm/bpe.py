"""Byte-pair encoding of whole texts, exact and in linear time.

The encoder walks over a piece of text and always tries the longest token that starts at the current byte
(found for all bytes by one Aho-Corasick pass). A token may follow another only if the merges would have
kept the two apart, which a table of pairs decides; if no token fits, the walk steps back. A bit for each byte
remembers dead ends, so that each place is tried at most once and no input is quadratic. The outcome is what
applying the merges in order of rank gives. Decoding copies bytes through a table of offsets.

Token ids must be the merge ranks, the single bytes first, as in rank files ("base64 rank" lines).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skylode.llm.spread import spread

#: Fixed value: the public pattern that splits texts before the merges of the 50k byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where the public vocabularies lie on this machine; a parameter of every operator.
TOKENIZERS = "/opt/tokenizers"
_CACHE_PIECES = 400_000
_MAX_FILE = 64 << 20


class Bpe:
    """Tables of one vocabulary, built from the bytes of its rank file."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        table = sorted((int(r), base64.b64decode(t)) for t, r in (line.split() for line in ranks.splitlines() if line.strip()))
        if [r for r, _ in table] != list(range(len(table))):
            raise ValueError("ranks must be 0, 1, 2, ... without gaps")
        self.tokens = [t for _, t in table]
        self.ids = {t: i for i, t in enumerate(self.tokens)}
        self.pattern = regex.compile(pattern)
        self.length = [len(t) for t in self.tokens]
        self._pieces: dict[str, list[int]] = {}
        self._build()

    def _build(self) -> None:
        self.left, self.right = list(range(len(self.tokens))), list(range(len(self.tokens)))
        self.pair: dict[tuple[int, int], int] = {}
        self.shorter = [-1] * len(self.tokens)
        trie = ahocorasick.Automaton()
        for i, t in enumerate(self.tokens):
            trie.add_word(t.decode("latin-1"), i)
            heads = [h for n in range(len(t) - 1, 0, -1) if (h := self.ids.get(t[:n])) is not None]
            if heads:
                self.shorter[i] = heads[0]
            for a in heads:
                b = self.ids.get(t[self.length[a] :])
                if a < i and b is not None and b < i and self.apart(a, b):
                    self.left[i], self.right[i] = a, b
                    self.pair[a, b] = i
                    break
        trie.make_automaton()
        self.trie = trie
        self.single = [self.ids[bytes([i])] for i in range(256)]
        self.buffer = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])

    def apart(self, a: int, b: int) -> bool:
        """Whether the merges leave token ``a`` followed by token ``b`` as they are.

        The later-formed of the two is undone step by step; at each step the tokens that face each other
        across the border must not merge earlier than what they become part of.
        """
        pair, left, right = self.pair, self.left, self.right
        before = 1 << 60
        while True:
            if pair.get((a, b), before) < before:
                return False
            if a > b:
                before, a = a, right[a]
                if a != before:
                    continue
                before, was = b + 1, b
                b = left[b]
                if b == was:
                    return True
            else:
                before, was = b + 1, b
                b = left[b]
                if b != was:
                    continue
                before, was = a, a
                a = right[a]
                if a == was:
                    return True

    def encode_bytes(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        one = self.ids.get(piece)
        if one is not None and (len(piece) == 1 or self.left[one] != one):
            return [one]
        single, length, shorter, apart = self.single, self.length, self.shorter, self.apart
        longest = [single[c] for c in piece]
        for end, token in self.trie.iter(piece.decode("latin-1")):
            start = end + 1 - length[token]
            if length[token] > length[longest[start]]:
                longest[start] = token
        n = len(piece)
        alive = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            while token >= 0:
                end = at + length[token]
                if alive[end] and (not out or apart(out[-1], token)):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                if at < n:
                    token = longest[at]
            else:
                alive[at] = 0
                token = out.pop()
                at -= length[token]
                token = shorter[token]
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without special tokens."""
        known, out = self._pieces, []
        for piece in self.pattern.findall(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.encode_bytes(piece.encode("utf-8"))
                if len(piece) <= 64:
                    if len(known) >= _CACHE_PIECES:
                        known.clear()
                    known[piece] = ids
            out += ids
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for."""
        ids = np.asarray(ids, np.int64)
        n = self.offset[ids + 1] - self.offset[ids]
        at = np.repeat(self.offset[ids] - (np.cumsum(n) - n), n)
        return self.buffer[at + np.arange(len(at))].tobytes()


_BUILT: dict[str, Bpe] = {}


def built(ranks: bytes) -> Bpe:
    """The tables of a rank file, built once in a process."""
    key = hashlib.sha256(ranks).hexdigest()
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Bpe(ranks)
    return _BUILT[key]


def _ranks(df: DataFrame, tokenizer: str, folder: str):
    with open(f"{folder}/{tokenizer}.tiktoken", "rb") as f:
        ranks = f.read(_MAX_FILE + 1)
    if len(ranks) > _MAX_FILE:
        raise ValueError(f"{tokenizer} is larger than {_MAX_FILE} bytes, too large to broadcast")
    return df.sparkSession.sparkContext.broadcast(ranks)


def _replaced(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], values], [*names, name])


def _schema(df: DataFrame, out: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*[f for f in df.schema.fields if f.name != out], T.StructField(out, kind)])


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def encode(df: DataFrame, *, text: str = "text", out: str = "ids", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, null_ids: tuple[int, ...] = (), empty_ids: tuple[int, ...] = ()) -> DataFrame:
    """``df`` with ``out``: the ids of each whole text, an array of int, without special tokens.

    A NULL text has ``null_ids`` and an empty one ``empty_ids`` (both no ids by default, never NULL). Every
    row stays, also repeated ones; ``out`` replaces a column of that name; other columns are passed on. The
    rank file is read on the driver and broadcast, as a vocabulary's size doesn't depend on the data.
    """
    ranks = _ranks(df, tokenizer, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = built(ranks.value)
        for batch in _slices(batches):
            ids = [list(null_ids) if t is None else bpe.encode(t) if t else list(empty_ids) for t in batch.column(text).to_pylist()]
            yield _replaced(batch, out, pa.array(ids, pa.list_(pa.int32())))

    return spread(df).mapInArrow(run, _schema(df, out, T.ArrayType(T.IntegerType())))


def count_tokens(df: DataFrame, *, text: str = "text", out: str = "n_tokens", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``df`` without ``text`` but with ``out``: the number of ids of each whole text; 0 for NULL and empty."""
    ranks = _ranks(df, tokenizer, folder)
    schema = T.StructType([f for f in _schema(df, out, T.LongType()).fields if f.name != text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = built(ranks.value)
        for batch in _slices(batches):
            n = pa.array([len(bpe.encode(t)) if t else 0 for t in batch.column(text).to_pylist()], pa.int64())
            yield _replaced(batch, out, n).select([f.name for f in schema.fields])

    return spread(df).mapInArrow(run, schema)


def decode(df: DataFrame, *, ids: str = "ids", out: str = "text", tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``df`` with ``out``: the text that ``ids`` stand for; NULL for NULL, empty for no ids.

    Ids outside the vocabulary stand for nothing. Bytes that aren't UTF-8 become the replacement character.
    """
    ranks = _ranks(df, tokenizer, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = built(ranks.value)
        for batch in _slices(batches):
            texts = []
            for x in batch.column(ids).to_pylist():
                if x is not None:
                    a = np.array([i for i in x if i is not None], np.int64)
                    x = bpe.decode(a[(a >= 0) & (a < len(bpe.tokens))]).decode("utf-8", "replace")
                texts.append(x)
            yield _replaced(batch, out, pa.array(texts, pa.string()))

    return spread(df).mapInArrow(run, _schema(df, out, T.StringType()))


__all__ = ["Bpe", "PATTERN", "TOKENIZERS", "built", "count_tokens", "decode", "encode"]
