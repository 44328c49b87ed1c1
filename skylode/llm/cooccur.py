"""Items that appear together: pair counts and how far they exceed chance.

The baskets are a binary matrix of records by items; its Gram matrix holds all pair counts. Every task takes
its records in blocks, turns a block into sparse blocks of items, multiplies each pair of item blocks
(transposed) over the records that have items in both, and adds the products up before anything is shuffled.
Items too rare in the block to fill a matrix are multiplied entry by entry. Counts are whole numbers, so the
sums are exact in any order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylode.functions import text as tx
from skylode.session import cut

_WIDTH = 256
_BLOCK_ROWS = 1 << 15
_HELD_PAIRS = 1 << 21


def tag_list(text: Column) -> Column:
    """The tags in a text: a JSON array, or a comma-separated list.

    Each is trimmed, in lower case, with inner spaces and underscores as hyphens; NULL and blank ones don't
    count. A text that starts with ``[`` but isn't a JSON array holds none, nor does NULL. Elements that
    aren't strings count as their JSON text.
    """
    tags = F.transform(tx.tag_elements(text), lambda x: F.translate(F.lower(F.btrim(x, F.lit(" \t\r\n\f\v "))), " _", "--"))
    return F.coalesce(F.filter(tags, lambda x: x != ""), F.array().cast("array<string>"))


def _sums(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal codes added up, in order."""
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    at = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
    return code[at], np.add.reduceat(n, at) if len(at) else n


def _dense(rows: np.ndarray, cols: np.ndarray, keep: np.ndarray, width: int) -> np.ndarray:
    """Rows ``keep`` of a sparse block as a matrix."""
    at = np.searchsorted(keep, rows)
    there = (at < len(keep)) & (keep[np.minimum(at, len(keep) - 1)] == rows)
    out = np.zeros((len(keep), width), np.float32)
    out[at[there], cols[there]] = 1
    return out


def gram(row: np.ndarray, item: np.ndarray, n_items: int, least: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (as ``low * n_items + high``) and their counts over distinct (row, item) entries in row order.

    At most 2**24 rows, as the products are made in single precision.
    """
    often = np.bincount(item, minlength=n_items)
    rank = np.empty(n_items, np.int64)
    rank[by := np.argsort(-often, kind="stable")] = np.arange(n_items)
    dense = int((often >= least).sum())
    codes, counts = [], []
    # blocks of frequent items, filled with the records that have items in both
    heavy = rank[item] < dense
    blocks = []
    for lo in range(0, dense, _WIDTH):
        mine = heavy & (rank[item] >= lo) & (rank[item] < lo + _WIDTH)
        r, c = row[mine], rank[item[mine]] - lo
        blocks.append((lo, r, c, np.unique(r)))
    for i, (lo, r, c, rows) in enumerate(blocks):
        for lo2, r2, c2, rows2 in blocks[i:]:
            both = rows if lo == lo2 else np.intersect1d(rows, rows2, assume_unique=True)
            if not len(both):
                continue
            x = _dense(r, c, both, min(_WIDTH, dense - lo))
            y = x if lo == lo2 else _dense(r2, c2, both, min(_WIDTH, dense - lo2))
            g = x.T @ y
            if lo == lo2:
                g = np.triu(g, 1)
            a, b = np.nonzero(g)
            p, q = by[a + lo], by[b + lo2]
            codes.append(np.minimum(p, q) * n_items + np.maximum(p, q))
            counts.append(g[a, b].astype(np.int64))
    # a rare item against each more frequent item of its records
    size = np.bincount(row, minlength=int(row[-1]) + 1 if len(row) else 0)
    order = np.lexsort((rank[item], row))
    row, item = row[order], item[order]
    start = np.cumsum(size) - size
    place = np.arange(len(row)) - start[row]
    n = np.where(rank[item] < dense, 0, place)
    ends = np.cumsum(n)
    lo = 0
    while lo < len(row):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _HELD_PAIRS, "right")))
        k = n[lo:hi]
        again = np.repeat(np.arange(lo, hi), k)
        other = start[row[again]] + np.arange(len(again)) - np.repeat(np.cumsum(k) - k, k)
        p, q = item[again], item[other]
        code, count = _sums(np.minimum(p, q) * n_items + np.maximum(p, q), np.ones(len(p), np.int64))
        codes.append(code)
        counts.append(count)
        lo = hi
    return _sums(np.concatenate(codes), np.concatenate(counts)) if codes else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class _Sums:
    """Pair counts of a task; handed on whenever too many are held."""

    def __init__(self) -> None:
        self.ids: dict[str, int] = {}
        self.names: list[str] = []
        self.code, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, names: list[str], code: np.ndarray, n: np.ndarray) -> None:
        here = np.array([self.ids.setdefault(x, len(self.ids)) for x in names], np.int64)
        self.names += [x for x in names if self.ids[x] >= len(self.names)]
        a, b = here[code // len(names)], here[code % len(names)]
        code = (np.minimum(a, b) << 32) | np.maximum(a, b)
        self.code, self.n = _sums(np.concatenate([self.code, code]), np.concatenate([self.n, n]))

    def take(self) -> Iterator[pa.RecordBatch]:
        names = pa.array(self.names, pa.string())
        for i in range(0, len(self.code), 1 << 16):
            code, n = self.code[i : i + (1 << 16)], self.n[i : i + (1 << 16)]
            a, b = names.take(pa.array(code >> 32)), names.take(pa.array(code & 0xFFFFFFFF))
            swap = pc.greater(a, b)
            yield pa.RecordBatch.from_arrays([pc.if_else(swap, b, a), pc.if_else(swap, a, b), pa.array(n)], ["item_a", "item_b", "n_ab"])
        self.__init__()


def _pairs_of(batches: Iterator[pa.RecordBatch], keep: frozenset[str] | None) -> Iterator[pa.RecordBatch]:
    sums = _Sums()
    held: list[pa.Array] = []
    rows = 0
    wanted = pa.array(sorted(keep), pa.string()) if keep is not None else None

    def block() -> None:
        lists = pa.concat_arrays(held)
        lists = lists.filter(pc.greater(pc.list_value_length(lists), 1))
        flat = lists.flatten().dictionary_encode()
        row = pc.list_parent_indices(lists).to_numpy()
        names = flat.dictionary
        item = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if wanted is not None and len(names):
            kept = pc.is_in(names, wanted).to_numpy(zero_copy_only=False)
            row, item = row[kept[item]], item[kept[item]]
        n = len(names)
        if n and len(row):
            entry = np.unique(row.astype(np.int64) * n + item)
            code, count = gram(entry // n, entry % n, n)
            sums.add(names.to_pylist(), code, count)

    for batch in batches:
        held.append(batch.column(0))
        rows += batch.num_rows
        if rows >= _BLOCK_ROWS:
            block()
            held, rows = [], 0
            if len(sums.code) > _HELD_PAIRS:
                yield from sums.take()
    if held:
        block()
    yield from sums.take()


def cooccurrence(baskets: DataFrame, items: str = "items", *, min_pairs: int = 1, most_items: int = 200_000) -> DataFrame:
    """(item_a, item_b, n_ab, n_a, n_b, n, lift, pmi; item_a < item_b) of pairs in ``min_pairs`` baskets or more.

    A basket is one row's array of strings; an item counts once in it, NULL items and NULL arrays don't
    count. ``n`` counts baskets with an item, ``lift`` is n_ab * n / (n_a * n_b) and ``pmi`` its logarithm.
    Repeated rows are baskets of their own; no rows give none. An item in fewer than ``min_pairs`` baskets is
    in no pair, so it is left out before the products, if the items that stay are at most ``most_items`` (their
    names then go to all tasks); beyond that all items are multiplied, and the result is the same.
    """
    # filtered after the cut: a filter on what is computed here would compute it twice
    clean = cut(baskets.select(F.array_distinct(F.array_compact(F.col(f"`{items}`"))).alias("items"))).where(F.size("items") > 0)
    n = clean.count()
    singles = clean.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n_item"))
    keep = None
    if min_pairs > 1:
        names = [r.item for r in singles.where(F.col("n_item") >= min_pairs).select("item").limit(most_items + 1).collect()]
        keep = frozenset(names) if len(names) <= most_items else None
    parts = clean.where(F.size("items") > 1).mapInArrow(lambda batches: _pairs_of(batches, keep), "item_a string, item_b string, n_ab bigint")
    pairs = parts.groupBy("item_a", "item_b").agg(F.sum("n_ab").alias("n_ab")).where(F.col("n_ab") >= min_pairs)
    a = singles.select(F.col("item").alias("item_a"), F.col("n_item").alias("n_a"))
    b = singles.select(F.col("item").alias("item_b"), F.col("n_item").alias("n_b"))
    lift = F.col("n_ab") / F.col("n_a") * n / F.col("n_b")
    return pairs.join(a, "item_a").join(b, "item_b").select("item_a", "item_b", "n_ab", "n_a", "n_b", F.lit(n).cast("bigint").alias("n"), lift.alias("lift"), F.log(lift).alias("pmi"))


def above_chance(pairs: DataFrame, times: int) -> Column:
    """Whether a pair is at least ``times`` as frequent as by chance, in whole numbers."""
    def wide(c: str) -> Column:
        return F.col(c).cast("decimal(19,0)")

    return wide("n_ab") * wide("n") >= wide("n_a") * wide("n_b") * times
