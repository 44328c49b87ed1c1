"""A mixture of sources whose sizes have target shares.

Entropy balancing: each record gets a rate, as close as possible (in relative entropy) to using it once, such
that the rates times the sizes of each source add up to its share and no rate exceeds what the source allows.
The solution tilts the rates exponentially by size, ``min(cap, exp(lambda * size))``, with one multiplier
per source; the multipliers solve the convex dual, by Newton steps whose sums are taken over the distributed
sizes. Rates then become whole copies: rounded at random by a hash of the id, with a threshold per source
that is moved until the source's total is met.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylode.session import cut

_MOST_SOURCES = 100_000
_BINS = 4096


@dataclass
class _Source:
    share: float
    cap: int
    docs: int = 0
    size: int = 0
    mean: float = 1.0
    goal: float = 0.0
    tilt: float = 0.0
    low: float = -math.inf
    high: float = math.inf
    done: bool = False
    threshold: float = 0.0


class Mixture:
    """Copies of records, and the shares they reach."""

    def __init__(self, sizes: DataFrame, targets: DataFrame, *, key: str = "doc_id", source: str = "source", size: str = "n_tokens", weight: str = "weight", repeats: str = "max_repeats", total: float | None = None, seed: int = 7, tolerance: float = 1e-9, most_steps: int = 80):
        """Solves for ``sizes`` (key, source, size) and ``targets`` (source, weight, repeats).

        ``total`` is the mixture's size. By default it is the greatest at which every source with a target and
        data can have its full share; with a greater one, sources that can't are used as often as they may be.
        A target that is NULL, NaN, infinite or not positive is none; NULL repeats mean once, less than once none. A
        source named twice in the targets takes the greatest weight and the greatest repeats. Sources without
        data get nothing and their share goes to the others in proportion; records whose source is NULL or
        has no target, and records of no (or NULL) size, are left out. Repeated rows are records of their
        own. Targets come to the driver: an error beyond 100,000 sources. So is a source whose size is still off
        by more than ``tolerance`` after ``most_steps`` steps.
        """
        self.spark = sizes.sparkSession
        good = F.col(weight).cast("double")
        listed = targets.where(F.col(source).isNotNull() & (good > 0) & (good < float("inf"))).groupBy(F.col(source).cast("string").alias("src"))
        listed = listed.agg(F.max(good).alias("w"), F.max(F.coalesce(F.col(repeats).cast("int"), F.lit(1))).alias("cap")).limit(_MOST_SOURCES + 1).collect()
        if len(listed) > _MOST_SOURCES:
            raise ValueError(f"more than {_MOST_SOURCES} sources have a target")
        self.sources = {r.src: _Source(r.w, max(0, r.cap)) for r in listed}
        whole = sum(s.share for s in self.sources.values())
        self.asked = {n: s.share / whole for n, s in self.sources.items()}
        rows = sizes.select(F.col(f"`{key}`").alias("id"), F.col(f"`{source}`").cast("string").alias("src"), F.col(f"`{size}`").cast("bigint").alias("t")).where(F.col("t") > 0)
        self.rows_in = cut(rows.join(self._table([(n,) for n, s in self.sources.items() if s.cap], "src string"), "src"))
        self.hist = cut(self.rows_in.groupBy("src", "t").agg(F.count(F.lit(1)).alias("c")))
        for r in self.hist.groupBy("src").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("t")).alias("t")).collect():
            s = self.sources[r.src]
            s.docs, s.size, s.mean = r.n, r.t, r.t / r.n
        self.active = {n: s for n, s in self.sources.items() if s.size}
        self._solve(total, tolerance, most_steps)
        self._round(seed)

    def _table(self, rows: list[tuple], schema: str) -> DataFrame:
        """A row per source: few, as checked on the way in."""
        return F.broadcast(self.spark.createDataFrame(rows, schema))

    def _solve(self, total: float | None, tolerance: float, most_steps: int) -> None:
        whole = sum(s.share for s in self.active.values())
        for s in self.active.values():
            s.share /= whole
        if total is None:
            total = min((s.cap * s.size / s.share for s in self.active.values()), default=0.0)
        for s in self.active.values():
            most = s.cap * s.size
            s.goal = min(total * s.share, most)
            if s.goal >= most * (1 - 1e-12):  # every record as often as it may be
                s.tilt, s.done = s.mean * math.log(s.cap) if s.cap > 1 else 0.0, True
            elif s.cap > 1 and s.goal > s.size:
                s.low, s.high = 0.0, s.mean * math.log(s.cap)
        for _ in range(most_steps):
            left = {n: s for n, s in self.active.items() if not s.done}
            if not left:
                return
            table = self._table([(n, s.tilt / s.mean, math.log(s.cap)) for n, s in left.items()], "src string, tilt double, most double")
            h = self.hist.join(table, "src")
            rate = F.exp(F.least(F.col("tilt") * F.col("t"), F.col("most")))
            free = F.col("tilt") * F.col("t") < F.col("most")
            mass = F.col("c") * F.col("t") * rate
            sums = h.groupBy("src").agg(F.sum(mass).alias("g"), F.sum(F.when(free | (F.col("most") == 0), mass * F.col("t")).otherwise(0.0)).alias("h")).collect()
            for r in sums:
                s = left[r.src]
                off = r.g - s.goal
                if abs(off) <= tolerance * s.goal:
                    s.done = True
                    continue
                if off > 0:
                    s.high = min(s.high, s.tilt)
                else:
                    s.low = max(s.low, s.tilt)
                step = s.tilt - off / (r.h / s.mean) if r.h else math.nan
                if s.low < step < s.high:
                    s.tilt = step
                elif math.isfinite(s.low) and math.isfinite(s.high):
                    s.tilt = (s.low + s.high) / 2
                    s.done = s.high - s.low <= 1e-13 * max(1.0, abs(s.high))
                else:
                    s.tilt = s.tilt - 1.0 if off > 0 else s.tilt + 1.0
        unsolved = sorted(n for n, s in self.active.items() if not s.done)
        if unsolved:
            raise ArithmeticError(f"{len(unsolved)} sources, such as {unsolved[0]}, miss their size after {most_steps} steps; raise most_steps or tolerance")

    def _round(self, seed: int) -> None:
        table = self._table([(n, s.tilt / s.mean, math.log(s.cap), s.cap) for n, s in self.active.items()], "src string, tilt double, most double, cap int")
        rate = F.exp(F.least(F.col("tilt") * F.col("t"), F.col("most")))
        even = F.shiftrightunsigned(F.xxhash64(F.col("id"), F.lit(seed)), 11).cast("double") / float(1 << 53)
        r = self.rows_in.join(table, "src").select("id", "src", "t", "cap", rate.alias("rate"), even.alias("even"))
        r = r.withColumn("whole", F.floor(F.col("rate") + 1e-9).cast("int"))
        part = F.greatest(F.lit(0.0), F.col("rate") - F.col("whole"))
        # lower is rounded up first; NULL where one more copy isn't allowed
        self.rated = r.withColumn("turn", F.when(F.col("whole") < F.col("cap"), F.col("even") - part)).select("id", "src", "t", "rate", "whole", "turn")
        base = {x.src: x.t for x in self.rated.groupBy("src").agg(F.sum(F.col("t") * F.col("whole")).alias("t")).collect()}
        reached = {n: float(base.get(n, 0)) for n in self.active}
        frm, width = {n: -1.0 for n in self.active}, 2.0
        for _ in range(2):
            # the first bin that would exceed the goal, and what those before it hold: one row per source comes back
            bins = self._table([(n, x, self.active[n].goal - reached[n]) for n, x in frm.items()], "src string, frm double, room double")
            b = self.rated.where("turn IS NOT NULL").join(bins, "src").select("src", "t", "room", F.floor((F.col("turn") - F.col("frm")) * (_BINS / width)).cast("int").alias("bin")).where(F.col("bin").between(0, _BINS - 1))
            held = b.groupBy("src", "bin").agg(F.sum("t").alias("t"), F.first("room").alias("room"))
            upto = F.sum("t").over(Window.partitionBy("src").orderBy("bin"))
            full = held.withColumn("upto", upto).groupBy("src").agg(F.min(F.when(F.col("upto") > F.col("room"), F.col("bin"))).alias("at"), F.max(F.when(F.col("upto") <= F.col("room"), F.col("upto"))).alias("t")).collect()
            at = dict.fromkeys(frm, _BINS)
            for x in full:
                at[x.src] = _BINS if x.at is None else x.at
                reached[x.src] += x.t or 0
            for n in frm:
                frm[n] += at[n] * width / _BINS
            width /= _BINS
        for n, s in self.active.items():
            s.threshold = frm[n]

    def rows(self) -> DataFrame:
        """(id, src, size, rate, copies) of each record used at least once."""
        table = self._table([(n, s.threshold) for n, s in self.active.items()], "src string, threshold double")
        copies = F.col("whole") + F.coalesce((F.col("turn") < F.col("threshold")).cast("int"), F.lit(0))
        return self.rated.join(table, "src").select("id", "src", F.col("t").alias("size"), "rate", copies.alias("copies")).where("copies > 0")

    def report(self) -> DataFrame:
        """A row per target: asked and reached share, sizes, and how often records are used."""
        used = self.rows().groupBy("src").agg(F.sum(F.col("size") * F.col("copies")).alias("t"), F.count(F.lit(1)).alias("n"), F.max("copies").alias("most"), F.sum("copies").alias("k")).collect()
        used = {r.src: r for r in used}
        whole = sum(r.t for r in used.values()) or 1
        out = []
        for n, s in sorted(self.sources.items()):
            u = used.get(n)
            out.append((n, self.asked[n], (u.t / whole) if u else 0.0, s.docs, s.size, u.t if u else 0, u.n if u else 0, s.cap, u.most if u else 0, (u.k / u.n) if u else 0.0))
        return self.spark.createDataFrame(out, "source string, target_share double, share double, docs bigint, size bigint, mixture_size bigint, docs_used bigint, max_repeats int, most_repeats int, mean_repeats double")
