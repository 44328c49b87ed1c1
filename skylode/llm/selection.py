"""Score cutoffs that keep a target fraction of each group.

Multi-sequence selection: every task sorts its own scores, once, into runs per group, which are cached. The cutoff of a
group with n scores is its k-th greatest. Each round draws pivots from the runs, in proportion to what is left of them,
and every run ranks the pivots by binary search; only the ranks are added up. They narrow, for all groups at once, the
range of indices in each run that can still hold the cutoff, and the next round reads only these ranges. A group whose
range has no more scores than a round has pivots is done. No rows move, so a group that holds most rows is no heavier than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylode.session import cut

_RUN = 1 << 16
_SORTED_AT_ONCE = 1 << 20
_PIVOTS = 1 << 16
_MOST_GROUPS = 2_000_000


def sorted_runs(rows: DataFrame) -> DataFrame:
    """(grp, scores, ids): the rows (grp string, id bigint, score double) of each task, by group and score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            groups = t.column("grp").combine_chunks().dictionary_encode()
            code = groups.indices.to_numpy(zero_copy_only=False)
            score, ids = t.column("score").to_numpy() + 0.0, t.column("id").to_numpy()
            order = np.lexsort((score, code))
            code, score, ids = code[order], score[order], ids[order]
            size = np.bincount(code, minlength=len(groups.dictionary))
            cuts = np.concatenate([s + np.arange(0, k, _RUN) for s, k in zip(np.cumsum(size) - size, size, strict=True)] + [[len(code)]]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x)) for x in (score, ids)]
            yield pa.RecordBatch.from_arrays([groups.dictionary.take(pa.array(code[cuts[:-1]])), *lists], ["grp", "scores", "ids"])

        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= _SORTED_AT_ONCE:
                yield from flush()
                held, n = [], 0
        if held:
            yield from flush()

    return rows.mapInArrow(run, "grp string, scores array<double>, ids array<bigint>")


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for i, j in zip(at[:-1], at[1:], strict=True):
        yield flat[i:j]


def _pivots(runs: DataFrame, left: dict[str, int], each: int, seed: int) -> list[np.ndarray]:
    """Distinct scores of each group in order: about ``each`` of the ``left`` ones in its runs, all if they are no more.

    A run gives scores at even steps, as many as its part of the group; fractions are settled by a draw that depends on
    the run's place only, so a task that runs again gives the same.
    """
    sent = runs.sparkSession.sparkContext.broadcast({g: (i, n) for i, (g, n) in enumerate(left.items())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng((seed, TaskContext.get().partitionId()))
        for b in batches:
            for g, s in zip(b.column(0).to_pylist(), _lists(b.column(1)), strict=True):
                if g in sent.value:
                    i, n = sent.value[g]
                    share = min(float(len(s)), each * len(s) / n)
                    k = int(share + rng.random()) if share < len(s) else len(s)
                    if k:
                        x = s[((np.arange(k) + rng.random()) * (len(s) / k)).astype(np.int64).clip(0, len(s) - 1)] if k < len(s) else s
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), i, np.int64)), pa.array(x)], ["at", "score"])

    got = runs.mapInArrow(run, "at bigint, score double").toArrow()
    sent.destroy()
    at, score = got.column("at").to_numpy(), got.column("score").to_numpy()
    order = np.argsort(at, kind="stable")
    ends = np.searchsorted(at[order], np.arange(len(left) + 1))
    return [np.unique(score[order[i:j]]) for i, j in zip(ends[:-1], ends[1:], strict=True)]


def _ranks(runs: DataFrame, names: list[str], pivots: list[np.ndarray]) -> list[np.ndarray]:
    """For each group and pivot how many scores reach it, and how many exceed it."""
    ends = np.cumsum([0, *map(len, pivots)])
    sent = runs.sparkSession.sparkContext.broadcast({g: (int(e), p) for g, e, p in zip(names, ends[:-1], pivots, strict=True)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for b in batches:
            for g, s in zip(b.column(0).to_pylist(), _lists(b.column(1)), strict=True):
                if g in sent.value:
                    e, p = sent.value[g]
                    t = total.setdefault(e, [0, 0])
                    t[0] = t[0] + len(s) - np.searchsorted(s, p, "left")
                    t[1] = t[1] + len(s) - np.searchsorted(s, p, "right")
        for e, (reach, exceed) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(e, e + len(reach))), pa.array(reach), pa.array(exceed)], ["at", "reach", "exceed"])

    got = runs.mapInArrow(run, "at bigint, reach bigint, exceed bigint").groupBy("at").agg(F.sum("reach").alias("reach"), F.sum("exceed").alias("exceed")).toArrow()
    sent.destroy()
    out = np.zeros((2, int(ends[-1])), np.int64)
    out[:, got.column("at").to_numpy()] = got.column("reach").to_numpy(), got.column("exceed").to_numpy()
    return np.split(out, ends[1:-1], axis=1)


def _between(runs: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """What of each run lies strictly between its group's bounds; groups without bounds go."""
    sent = runs.sparkSession.sparkContext.broadcast(bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for g, s in zip(b.column(0).to_pylist(), _lists(b.column(1)), strict=True):
                if g in sent.value:
                    low, high = sent.value[g]
                    s = s[np.searchsorted(s, low, "right") : np.searchsorted(s, high, "left")]
                    if len(s):
                        yield pa.RecordBatch.from_arrays([pa.array([g], pa.string()), pa.ListArray.from_arrays(pa.array([0, len(s)], pa.int32()), pa.array(s))], ["grp", "scores"])

    return cut(runs.mapInArrow(run, "grp string, scores array<double>"))


def find_cutoffs(runs: DataFrame, permille: dict[str, int], most_pivots: int = _PIVOTS) -> dict[str, tuple[int, float, int]]:
    """Per group with scores: their number, the cutoff, and how many scores reach it."""
    sizes = {r.grp: r.n for r in runs.groupBy("grp").agg(F.sum(F.size("scores")).alias("n")).collect() if r.grp in permille}
    # ceil(n * permille / 1000), from 1 to n: the cutoff's place among the scores left, from the greatest
    place = {g: min(n, max(1, -(-n * permille[g] // 1000))) for g, n in sizes.items()}
    left, above = dict(sizes), dict.fromkeys(sizes, 0)
    rest = runs.select("grp", "scores")
    out: dict[str, tuple[int, float, int]] = {}
    seed = 0
    while left:
        names = list(left)
        pivots = _pivots(rest, left, int(np.clip(most_pivots // len(names), 16, 1024)), seed)
        seed += 1
        bounds: dict[str, tuple[float, float]] = {}
        for g, p, (reach, exceed) in zip(names, pivots, _ranks(rest, names, pivots), strict=True):
            k = place[g]
            hit = np.flatnonzero((reach >= k) & (exceed < k))
            if len(hit):
                out[g] = (sizes[g], float(p[hit[0]]), int(above[g] + reach[hit[0]]))
                del left[g]
                continue
            under = int((exceed >= k).sum())  # pivots below the cutoff come first
            low, high = (p[under - 1] if under else -np.inf), (p[under] if under < len(p) else np.inf)
            over = int(reach[under]) if under < len(p) else 0
            left[g] = int(exceed[under - 1]) - over if under else left[g] - over
            place[g], above[g] = k - over, above[g] + over
            bounds[g] = (float(low), float(high))
        if left:
            rest = _between(rest, bounds)
    return out


class Kept:
    """Cutoffs per group, and the rows that reach them."""

    def __init__(self, rows: DataFrame, targets: DataFrame, *, group: str, key: str, score: str, permille: str, low: float = 0.0, high: float = 1.0):
        """Finds the cutoffs of ``rows`` (unique ``key``) for ``targets`` (``group``, ``permille``).

        Scores outside ``low``..``high``, NULL and NaN don't count; rows whose group is NULL or has no target
        are in no result. A group named twice in ``targets`` takes the greatest target; a NULL target is none.
        Targets of 0 or less keep the rows with the greatest score, targets above 1000 all. Ties at the
        cutoff are all kept; repeated rows count each time. The targets come to the driver: one number for
        each group, and an error beyond two million groups.
        """
        self.spark: SparkSession = rows.sparkSession
        wanted = targets.where(F.col(group).isNotNull() & F.col(permille).isNotNull()).groupBy(F.col(group).cast("string").alias("grp")).agg(F.max(permille).cast("bigint").alias("keep"))
        listed = wanted.limit(_MOST_GROUPS + 1).collect()
        if len(listed) > _MOST_GROUPS:
            raise ValueError(f"more than {_MOST_GROUPS} groups have a target")
        self.permille = {r.grp: r.keep for r in listed}
        valid = rows.select(F.col(f"`{group}`").cast("string").alias("grp"), F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{score}`").cast("double").alias("score")).where(F.col("score").between(low, high))
        self.runs = cut(sorted_runs(valid.join(wanted.select("grp"), "grp", "left_semi")))
        self.cutoffs = find_cutoffs(self.runs, self.permille)

    def report(self) -> DataFrame:
        """(grp, permille, n, cutoff, kept) of each group with a target; without scores n and kept are 0."""
        none = (0, None, 0)
        return self.spark.createDataFrame([(g, p, *self.cutoffs.get(g, none)) for g, p in sorted(self.permille.items())], "grp string, permille bigint, n bigint, cutoff double, kept bigint")

    def rows(self) -> DataFrame:
        """(grp, id, score) of the rows that reach their group's cutoff."""
        sent = self.spark.sparkContext.broadcast({g: c for g, (_, c, _) in self.cutoffs.items()})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for g, s, i in zip(b.column(0).to_pylist(), _lists(b.column(1)), _lists(b.column(2)), strict=True):
                    if g in sent.value:
                        at = int(np.searchsorted(s, sent.value[g], "left"))
                        if at < len(s):
                            yield pa.RecordBatch.from_arrays([pa.array([g] * (len(s) - at), pa.string()), pa.array(i[at:]), pa.array(s[at:])], ["grp", "id", "score"])

        return self.runs.mapInArrow(run, "grp string, id bigint, score double")
