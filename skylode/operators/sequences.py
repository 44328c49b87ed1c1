"""What a series of camera movements consists of: labels, runs, speed curves, steady windows.

Window functions do what is local to a few rows; what depends on all that went before (merging short runs,
counting reversals, choosing windows) is a fold over one scene's small array of runs or seconds, in Column
expressions, so that scenes are independent rows and one shuffle by scene serves a whole chain.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylode.functions.scoring import clamp, rounded, spread
from skylode.functions.text import let

RUN = "array<struct<start: double, end: double, cls: string>>"
SPAN = "array<struct<start: double, end: double, spread: double>>"
PIECE = "array<struct<start: double, end: double, cls: string, profile: array<double>, is_window: boolean>>"


@dataclass(frozen=True)
class Motion:
    """Fixed values and limits of the analysis."""

    held_rate: float = 0.01
    jitter: float = 0.25
    max_rate: float = 1.0
    min_response: float = 0.15
    min_change: float = 0.30
    around: int = 2
    min_seconds: float = 3.0
    min_reposition: float = 1.0
    bucket: float = 1.0
    max_spread: float = 3.0


def jitter_of(shift: Column, drift: Column) -> Column:
    """The share of movement that cancels itself out; 0 without movement."""
    return F.when(shift < 1e-9, 0.0).otherwise(clamp((shift - drift) / F.nullif(shift, F.lit(0.0))))


def classify(shift: Column, drift: Column, response: Column, width: float, fps: float, m: Motion = Motion()) -> Column:
    """held, move or reposition, in this order of tests."""
    if width <= 0 or fps <= 0:
        return F.lit("move")
    rate = shift * fps / width
    return (
        F.when(response < m.min_response, F.when(rate < m.held_rate, "held").otherwise("reposition"))
        .when(rate < m.held_rate, "held")
        .when(jitter_of(shift, drift) > m.jitter, "reposition")
        .when(rate > m.max_rate, "reposition")
        .otherwise("move")
    )


def label_samples(samples: DataFrame, scene: str, order: str, width: float, fps: float, m: Motion = Motion()) -> DataFrame:
    """``samples`` (dx, dy, response per scene in order) with shift, drift, resp and cls of the frame around each.

    The frame is cut at a scene's ends. NULL movements are left out of its means; a frame of only NULLs is
    labelled move. No samples give no rows.
    """
    w = Window.partitionBy(scene).orderBy(order).rowsBetween(-m.around, m.around)
    framed = samples.withColumns({
        "shift": F.coalesce(F.avg(F.hypot("dx", "dy")).over(w), F.lit(0.0)),
        "drift": F.coalesce(F.hypot(F.avg("dx").over(w), F.avg("dy").over(w)), F.lit(0.0)),
        "resp": F.coalesce(F.avg("response").over(w), F.lit(0.0)),
    })
    return framed.withColumn("cls", classify(F.col("shift"), F.col("drift"), F.col("resp"), width, fps, m))


def displacements(frames: DataFrame, scene: str, order: str) -> DataFrame:
    """(scene, start, end, dx, dy) from the last readable frame to each readable one (x, y at time t).

    A frame without x or y is unreadable and gives no row, but the row after it still starts at its time: times come
    from the frame just before, positions from the last readable one. The first readable frame has none before it.
    """
    w = Window.partitionBy(scene).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    readable = F.col("x").isNotNull() & F.col("y").isNotNull()
    seen = F.last(F.when(readable, F.struct("x", "y")), ignorenulls=True).over(before)
    moved = frames.select(scene, order, F.lag("t").over(w).alias("start"), F.col("t").alias("end"), (F.col("x") - seen["x"]).alias("dx"), (F.col("y") - seen["y"]).alias("dy"), readable.alias("__r"), seen.isNotNull().alias("__s"))
    return moved.where("__r AND __s").drop("__r", "__s")


def to_runs(labelled: DataFrame, scene: str, order: str, label: str = "cls") -> DataFrame:
    """(scene, run, cls, start, end, n): consecutive samples of equal label, from the first's start to the last's end."""
    w = Window.partitionBy(scene).orderBy(order)
    new = (~F.col(label).eqNullSafe(F.lag(label).over(w))) | (F.row_number().over(w) == 1)
    numbered = labelled.withColumn("run", F.sum(new.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return numbered.groupBy(scene, "run").agg(F.first(label).alias("cls"), F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n"))


def run_list(runs: DataFrame, scene: str) -> DataFrame:
    """(scene, runs): each scene's runs in order of start. As many as the scene has changes of label."""
    rows = F.array_sort(F.collect_list(F.struct("start", "end", "cls")))
    return runs.groupBy(scene).agg(rows.cast(RUN).alias("runs"))


def _length(r: Column) -> Column:
    return r["end"] - r["start"]


def _run(start: Column, end: Column, cls: Column) -> Column:
    return F.struct(start.alias("start"), end.alias("end"), cls.alias("cls"))


def usable(cls: Column) -> Column:
    return cls.isin("held", "move")


def merge_short_runs(runs: Column, m: Motion = Motion()) -> Column:
    """Runs shorter than their class may be, first to last, join their longer neighbour and take its class.

    Equal neighbours: the one before. Equal classes that then adjoin become one run. A single run stays.
    All before the first short run are long enough, and stay so when they grow; so one pass does, in which a short run waits for
    the one after it.
    """
    kind = f"struct<done: {RUN}, open: struct<start: double, end: double, cls: string>>"

    def short(r: Column) -> Column:
        return _length(r) < F.when(usable(r["cls"]), m.min_seconds).otherwise(m.min_reposition)

    def add(done: Column, r: Column) -> Column:
        nothing = F.lit(None).cast("struct<start: double, end: double, cls: string>")
        return F.when(short(r), F.struct(done.alias("done"), r.alias("open"))).otherwise(F.struct(F.concat(done, F.array(r)).alias("done"), nothing.alias("open"))).cast(kind)

    def grown(done: Column, last: Column, r: Column) -> Column:
        return F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(_run(last["start"], r["end"], last["cls"]))).cast(RUN)

    def step(s: Column, r: Column) -> Column:
        last, waiting = F.get(s["done"], F.size(s["done"]) - 1), s["open"]
        back = F.coalesce(_length(last) >= _length(r), F.lit(False))
        return F.when(waiting.isNull(), add(s["done"], r)).when(back, add(grown(s["done"], last, waiting), r)).otherwise(add(s["done"], _run(waiting["start"], r["end"], r["cls"]))).cast(kind)

    def end(s: Column) -> Column:
        last = F.get(s["done"], F.size(s["done"]) - 1)
        return F.when(s["open"].isNull(), s["done"]).when(last.isNull(), F.array(s["open"])).otherwise(grown(s["done"], last, s["open"])).cast(RUN)

    zero = F.struct(F.array().cast(RUN).alias("done"), F.lit(None).cast("struct<start: double, end: double, cls: string>").alias("open")).cast(kind)
    merged = F.aggregate(runs.cast(RUN), zero, step, end)
    return F.when(F.size(runs) < 2, runs).otherwise(_join_neighbours(merged, lambda a, b: a["cls"] == b["cls"], lambda a, b: a["cls"]))


def merge_usable_runs(runs: Column) -> Column:
    """Adjoining held and move runs become one, with the class of the longer (equal: the earlier)."""
    return _join_neighbours(runs, lambda a, b: usable(a["cls"]) & usable(b["cls"]), lambda a, b: F.when(_length(a) >= _length(b), a["cls"]).otherwise(b["cls"]))


def _join_neighbours(runs: Column, joined: Callable[[Column, Column], Column], cls: Callable[[Column, Column], Column]) -> Column:
    def step(acc: Column, r: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        one = F.concat(F.slice(acc, F.lit(1), F.greatest(F.lit(0), F.size(acc) - 1)), F.array(_run(last["start"], r["end"], cls(last, r))))
        return F.when((F.size(acc) > 0) & joined(last, r), one).otherwise(F.concat(acc, F.array(r))).cast(RUN)

    return F.aggregate(runs.cast(RUN), F.array().cast(RUN), step)


def merge_short_segments(cuts: Column, min_seconds: float) -> Column:
    """Segments (start, end, cls) swept left to right: a short one is extended by the next, a short tail folded back."""
    def step(acc: Column, r: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        longer = F.concat(F.slice(acc, F.lit(1), F.greatest(F.lit(0), F.size(acc) - 1)), F.array(_run(last["start"], r["end"], last["cls"])))
        return F.when((F.size(acc) > 0) & (_length(last) < min_seconds), longer).otherwise(F.concat(acc, F.array(r))).cast(RUN)

    def tail(acc: Column) -> Column:
        last, before = F.get(acc, F.size(acc) - 1), F.get(acc, F.size(acc) - 2)
        folded = F.concat(F.slice(acc, F.lit(1), F.greatest(F.lit(0), F.size(acc) - 2)), F.array(_run(before["start"], last["end"], before["cls"])))
        return F.when((F.size(acc) > 1) & (_length(last) < min_seconds), folded).otherwise(acc).cast(RUN)

    return F.aggregate(cuts.cast(RUN), F.array().cast(RUN), step, tail)


def cut_list(cuts: Column, duration: Column, min_seconds: float) -> Column:
    """Segments that cover a file: all of it without cuts; the last reaches an end more than half a second on."""
    none = F.array(_run(F.lit(0.0), duration, F.lit(None).cast("string"))).cast(RUN)
    last = F.get(cuts, F.size(cuts) - 1)
    reaching = F.concat(F.slice(cuts, F.lit(1), F.greatest(F.lit(0), F.size(cuts) - 1)), F.array(_run(last["start"], F.when(duration - last["end"] > 0.5, duration).otherwise(last["end"]), last["cls"])))
    return merge_short_segments(F.when(F.coalesce(F.size(cuts), F.lit(0)) <= 0, none).otherwise(reaching).cast(RUN), min_seconds)


def segment(samples: DataFrame, scene: str, order: str, width: float, fps: float, m: Motion = Motion()) -> DataFrame:
    """(scene, runs): labels, runs, short runs merged, usable runs joined."""
    runs = run_list(to_runs(label_samples(samples, scene, order, width, fps, m), scene, order), scene)
    return runs.select(scene, merge_usable_runs(merge_short_runs(F.col("runs"), m)).alias("runs"))


def speed_buckets(samples: DataFrame, scene: str, order: str, width: float, fps: float, m: Motion = Motion()) -> DataFrame:
    """(scene, second, speed): mean speed in frame widths a second of each whole bucket; an incomplete last one goes."""
    if width <= 0 or fps <= 0:
        return samples.select(scene, F.lit(0).cast("bigint").alias("second"), F.lit(0.0).alias("speed")).limit(0)
    per = max(1, round(fps * m.bucket))
    place = F.floor((F.row_number().over(Window.partitionBy(scene).orderBy(order)) - 1) / per)
    got = samples.select(scene, place.alias("second"), F.hypot("dx", "dy").alias("far")).groupBy(scene, "second").agg((F.avg("far") * (fps / width)).alias("speed"), F.count(F.lit(1)).alias("n"))
    return got.where(F.col("n") == per).drop("n")


def speed_profile(buckets: DataFrame, scene: str) -> DataFrame:
    """(scene, profile): the speeds in order."""
    pairs = F.array_sort(F.collect_list(F.struct("second", "speed")))
    return buckets.groupBy(scene).agg(F.transform(pairs, lambda p: p["speed"]).alias("profile"))


def _turn(s: Column, v: Column, m: Motion) -> Column:
    """State (count, way, anchor) of a speed curve after one more value."""
    change = (v - s["anchor"]) / F.greatest(s["anchor"], F.lit(m.held_rate))
    way = F.when(change > 0, 1).otherwise(-1)
    turned = F.struct((s["count"] + ((s["way"] != 0) & (s["way"] != way)).cast("int")).alias("count"), way.alias("way"), v.alias("anchor"))
    rest = F.struct(s["count"].alias("count"), s["way"].alias("way"), v.alias("anchor"))
    kept = F.struct(s["count"].alias("count"), s["way"].alias("way"), s["anchor"].alias("anchor"))
    return F.when(s["anchor"].isNull() | (F.greatest(s["anchor"], v) < m.held_rate), rest).when(F.abs(change) < m.min_change, kept).otherwise(turned)


def reversals(speeds: Column, m: Motion = Motion()) -> Column:
    """How often a speed curve turns round; changes below a share, and near-standstill, don't count."""
    zero = F.struct(F.lit(0).alias("count"), F.lit(0).alias("way"), F.lit(None).cast("double").alias("anchor"))
    return F.aggregate(speeds, zero, lambda s, v: _turn(s, v, m), lambda s: s["count"])


def one_way(speeds: Column, m: Motion = Motion()) -> Column:
    """How many speeds from the first on come before the curve turns round; all if it never does."""
    kind = "struct<n: int, count: int, way: int, anchor: double>"
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("count"), F.lit(0).alias("way"), F.lit(None).cast("double").alias("anchor")).cast(kind)

    def step(s: Column, v: Column) -> Column:
        after = lambda t: F.struct((s["n"] + (t["count"] == 0).cast("int")).alias("n"), t["count"], t["way"], t["anchor"]).cast(kind)
        return F.when(s["count"] > 0, s).otherwise(let(_turn(s, v, m), after)).cast(kind)

    return F.aggregate(speeds, zero, step, lambda s: s["n"])


def eases_in(speeds: Column, m: Motion = Motion()) -> Column:
    """Whether a curve starts from rest."""
    return F.coalesce(F.get(speeds, F.lit(0)) < m.held_rate, F.lit(False))


def summary(profile: Column, m: Motion = Motion()) -> tuple[Column, Column]:
    """Reversals and rounded spread of a profile; NULL for an empty one."""
    there = F.size(profile) > 0
    return F.when(there, reversals(profile, m)), F.when(there, rounded(spread(profile, m.held_rate), 3))


def find_windows(profile: Column, start: Column, min_seconds: float, max_seconds: Column, m: Motion = Motion()) -> Column:
    """Steady stretches of a profile that don't overlap: the longest first, then the calmest, then the earliest.

    A stretch has no reversal and a spread within limits. Only if there is none, one that eases in may have
    any spread. A stretch that overlaps none taken lies inside one free gap, and its merit doesn't depend
    on the gaps, so taking all candidates in order of merit is the same as searching the gaps anew. A stretch that has a
    reversal has one however much longer it gets, so each start is followed once, until its first.
    """
    n = F.size(profile)
    shortest = max(1, round(min_seconds / m.bucket))
    longest = F.least(n, F.greatest(F.lit(shortest), F.rint(max_seconds / m.bucket).cast("int")))

    def at(o: Column) -> Column:
        def of_length(k: Column) -> Column:
            part = F.slice(profile, o + 1, k)
            return F.struct((-k).alias("less"), spread(part, m.held_rate).alias("spread"), o.alias("at"), eases_in(part, m).alias("eases"))

        reach = one_way(F.slice(profile, o + 1, F.least(longest, n - o)), m)
        return let(reach, lambda r: F.when(r >= shortest, F.transform(F.sequence(F.lit(shortest), r), of_length)).otherwise(F.array().cast(kind)))

    kind = "array<struct<less: int, spread: double, at: int, eases: boolean>>"
    every = F.when(longest >= shortest, F.flatten(F.transform(F.sequence(F.lit(0), n - shortest), at)))
    clean = F.coalesce(every, F.array().cast(kind))

    def take(acc: Column, c: Column) -> Column:
        clash = F.exists(acc, lambda t: (c["at"] < t["at"] - t["less"]) & (t["at"] < c["at"] - c["less"]))
        return F.when(clash, acc).otherwise(F.concat(acc, F.array(c))).cast(kind)

    def chosen(cs: Column) -> Column:
        return F.aggregate(F.array_sort(cs), F.array().cast(kind), take)

    strict = F.filter(clean, lambda c: c["spread"] <= m.max_spread)
    picked = let(chosen(strict), lambda s: F.when(F.size(s) > 0, s).otherwise(chosen(F.filter(clean, lambda c: (c["spread"] <= m.max_spread) | c["eases"]))))
    spans = F.transform(picked, lambda c: F.struct((start + c["at"] * m.bucket).alias("start"), (start + (c["at"] - c["less"]) * m.bucket).alias("end"), rounded(c["spread"], 3).alias("spread")))
    return F.array_sort(spans).cast(SPAN) if min_seconds > 0 else F.array().cast(SPAN)


def carve_windows(start: Column, end: Column, cls: Column, profile: Column, min_render: float = 0.0, max_render: float = 0.0, m: Motion = Motion()) -> Column:
    """Pieces of a run: steady windows, and what is left between them.

    Without a minimal length (the default), a profile, or the length itself, the run stays whole and counts
    as a window. Gaps of at most one bucket join a window unless that brings a reversal in.
    """
    def part(a: Column, b: Column) -> Column:
        lo, hi = F.greatest(F.lit(0), F.rint((a - start) / m.bucket).cast("int")), F.greatest(F.lit(0), F.rint((b - start) / m.bucket).cast("int"))
        return F.slice(profile, lo + 1, F.greatest(F.lit(0), hi - lo))

    def piece(a: Column, b: Column, window: bool | Column) -> Column:
        flag = window if isinstance(window, Column) else F.lit(window)
        return F.struct(a.alias("start"), b.alias("end"), cls.alias("cls"), part(a, b).alias("profile"), flag.alias("is_window"))

    carving = (F.size(profile) > 0) & (end - start >= min_render) if min_render > 0 else F.lit(False)
    whole = F.array(F.struct(start.alias("start"), end.alias("end"), cls.alias("cls"), profile.alias("profile"), (~carving).alias("is_window"))).cast(PIECE)
    if min_render <= 0:
        return whole
    windows = find_windows(profile, start, min_render, F.lit(float(max_render)) if max_render > 0 else end - start, m)
    state = f"struct<cursor: double, out: {PIECE}>"

    def step(s: Column, w: Column) -> Column:
        gap = s["cursor"] < w["start"]
        apart = gap & ((w["start"] - s["cursor"] > m.bucket) | (reversals(part(s["cursor"], w["end"]), m) > 0))
        first = F.when(apart | ~gap, w["start"]).otherwise(s["cursor"])
        stop = F.least(w["end"], end)
        last = F.when((end - stop <= m.bucket) & (reversals(part(first, end), m) == 0), end).otherwise(stop)
        before = F.when(apart, F.array(piece(s["cursor"], w["start"], False)).cast(PIECE)).otherwise(F.array().cast(PIECE))
        return F.struct(last.alias("cursor"), F.concat(s["out"], before, F.array(piece(first, last, True)).cast(PIECE)).alias("out")).cast(state)

    def rest(s: Column) -> Column:
        return F.when(end - s["cursor"] > 0.01, F.concat(s["out"], F.array(piece(s["cursor"], end, False)).cast(PIECE))).otherwise(s["out"])

    carved = let(windows, lambda ws: F.when(F.size(ws) == 0, whole).otherwise(F.aggregate(ws, F.struct(start.alias("cursor"), F.array().cast(PIECE).alias("out")).cast(state), step, rest)))
    return F.when(carving, carved).otherwise(whole)


def samples_in_runs(samples: DataFrame, runs: DataFrame, scene: str, order: str) -> DataFrame:
    """(scene, run, order, far): each sample (start, end, dx, dy) with the runs (run, start, end) that hold its midpoint, ends included.

    Runs of a scene may share ends but not overlap, so a midpoint lies in one, or on the border of two. Both are sorted into
    one line of times for each scene, in which a sample follows the run that holds it: no sample is compared with runs elsewhere.
    """
    before = Window.partitionBy(scene).orderBy("start", "end")
    last = [F.lag(c).over(before).alias(f"last_{c}") for c in ("run", "end")]
    events = runs.select(scene, "run", "start", "end").select(F.col(scene), F.col("start").alias("t"), F.lit(0).alias("kind"), F.struct("run", "end", *last).alias("r"), F.lit(None).cast(samples.schema[order].dataType).alias(order), F.lit(None).cast("double").alias("far"))
    mids = samples.select(F.col(scene), ((F.col("start") + F.col("end")) / 2).alias("t"), F.lit(1).alias("kind"), F.lit(None).cast(events.schema["r"].dataType).alias("r"), F.col(order), F.hypot("dx", "dy").alias("far"))
    line = Window.partitionBy(scene).orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, 0)
    held = events.unionByName(mids).withColumn("at", F.last("r", ignorenulls=True).over(line)).where("kind = 1")
    both = F.array(F.when(F.col("t") <= F.col("at.last_end"), F.col("at.last_run")), F.when(F.col("t") <= F.col("at.end"), F.col("at.run")))
    return held.select(scene, F.explode(F.array_compact(both)).alias("run"), order, "far")


def split_by_motion(scenes: DataFrame, samples: DataFrame, scene: str, order: str, width: float, fps: float, m: Motion = Motion(), min_render: float = 0.0, max_render: float = 0.0) -> DataFrame:
    """(scene, piece, start, end, cls, profile, is_window): scenes (scene, start, end) split into pieces that cover them.

    A scene without samples stays one moving piece. A sample whose midpoint lies on the border of two runs
    counts in both. Samples meet their runs in one sorted line of times, and a run's speeds are averaged as rows, so only its
    seconds are ever an array.
    """
    runs = segment(samples, scene, order, width, fps, m)
    per = max(1, round(fps * m.bucket))
    held = scenes.select(scene, F.col("start").alias("s0"), F.col("end").alias("s1")).join(runs, scene, "left")

    def stretched(r: Column, i: Column) -> Column:
        return _run(F.when(i == 0, F.col("s0")).otherwise(r["start"]), F.when(i == F.size("runs") - 1, F.col("s1")).otherwise(r["end"]), r["cls"])

    one = held.select(scene, "s0", "s1", F.when(F.coalesce(F.size("runs"), F.lit(0)) > 0, F.transform("runs", stretched)).cast(RUN).alias("runs"))
    one = one.select(scene, "s0", "s1", F.posexplode_outer("runs").alias("run", "r"))
    inside = samples_in_runs(samples, one.where("r IS NOT NULL").select(scene, "run", "r.start", "r.end"), scene, order)
    place = F.row_number().over(Window.partitionBy(scene, "run").orderBy(order)) - 1
    seconds = inside.select(scene, "run", "far", F.floor(place / per).alias("second")).groupBy(scene, "run", "second").agg((F.avg("far") * (fps / width)).alias("speed"), F.count(F.lit(1)).alias("n")).where(F.col("n") == per)
    speeds = F.transform(F.array_sort(F.collect_list(F.struct("second", "speed"))), lambda p: p["speed"])
    one = one.join(seconds.groupBy(scene, "run").agg(speeds.alias("profile")), [scene, "run"], "left")
    one = one.withColumn("profile", F.coalesce("profile", F.array().cast("array<double>")))
    start, end, cls = F.coalesce("r.start", "s0"), F.coalesce("r.end", "s1"), F.coalesce("r.cls", F.lit("move"))
    kept = F.array(F.struct(start.alias("start"), end.alias("end"), cls.alias("cls"), F.col("profile").alias("profile"), F.lit(True).alias("is_window"))).cast(PIECE)
    pieces = F.when(F.col("r").isNull() | (cls == "reposition"), kept).otherwise(carve_windows(start, end, cls, F.col("profile"), min_render, max_render, m))
    out = one.select(scene, "run", F.posexplode(pieces).alias("part", "p"))
    place = F.row_number().over(Window.partitionBy(scene).orderBy("p.start", "run", "part")) - 1
    return out.select(scene, place.alias("piece"), "p.start", "p.end", "p.cls", "p.profile", "p.is_window")


def untiled(pieces: DataFrame, scenes: DataFrame, scene: str, slack: float = 1e-6) -> DataFrame:
    """(scene, problem): scenes whose pieces leave gaps, overlap or don't reach an end."""
    w = Window.partitionBy(scene).orderBy("start", "end")
    gaps = pieces.select(scene, (F.lead("start").over(w) - F.col("end")).alias("gap")).where(F.abs("gap") > slack).select(scene, F.lit("gap or overlap").alias("problem"))
    ends = pieces.groupBy(scene).agg(F.min("start").alias("a"), F.max("end").alias("b"))
    s = scenes.select(scene, F.col("start").alias("s0"), F.col("end").alias("s1"))
    off = s.join(ends, scene, "left").where(F.col("a").isNull() | (F.abs(F.col("a") - F.col("s0")) > slack) | (F.abs(F.col("b") - F.col("s1")) > slack)).select(scene, F.lit("ends").alias("problem"))
    return gaps.unionByName(off).distinct()


def sample_times(in_point: Column, out_point: Column, fps: float, most: int = 600) -> Column:
    """Midpoints of equal parts of a shot, rounded to 3 digits; none without a length."""
    length = out_point - in_point
    n = F.greatest(F.lit(1), F.least(F.floor(length * fps), F.lit(most))).cast("int")
    times = F.transform(F.sequence(F.lit(0), n - 1), lambda i: rounded(in_point + length / n * (i + 0.5), 3))
    return F.when(length > 0, times).otherwise(F.array().cast("array<double>"))


def dense_times(start: Column, end: Column, fps: float, most: int) -> Column:
    """start, start + 1/fps, ... before the end, at most ``most``; none without a length."""
    n = F.least(F.ceil((end - start) * fps), F.lit(most)).cast("int")
    return F.when((end > start) & F.lit(fps > 0), F.transform(F.sequence(F.lit(0), n - 1), lambda i: start + i / fps)).otherwise(F.array().cast("array<double>"))
