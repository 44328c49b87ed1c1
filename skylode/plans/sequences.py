"""Sequence operators over camera samples derived from the events table (a scene is a user)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylode.functions import scoring
from skylode.operators import sequences as seq
from skylode.sources.tables import read_table

WIDTH, FPS = 512.0, 4.0


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """(scene, ord, start, end, dx, dy, response) from events, in each user's order of time."""
    e = read_table(spark, folder, "events", "user_id", "event_id", "ts", "event_type", "value")
    rn = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    e = e.select(F.col("user_id").alias("scene"), "event_id", "event_type", "value", rn.cast("bigint").alias("ord"))
    phase = F.floor(F.col("ord") / 24) % 3
    far = F.when(phase == 0, F.col("value") / 4e2).when(phase == 1, 6.0 + F.col("value") / 1e2).otherwise(F.col("value") / 4.0)
    back = F.col("event_type").isin("error", "signup") & (phase == 2)
    return e.select("scene", "ord", (F.col("ord") * 0.25).alias("start"), ((F.col("ord") + 1) * 0.25).alias("end"), F.when(back, -far).otherwise(far).alias("dx"), F.lit(0.0).alias("dy"), (0.05 + ((F.col("event_id") * 7) % 96) / 1e2).alias("response"))


def scenes(spark: SparkSession, folder: str) -> DataFrame:
    """(scene, start, end): each scene reaches a little beyond its samples."""
    return samples(spark, folder).groupBy("scene").agg((F.min("start") - 0.1).alias("start"), (F.max("end") + 0.1).alias("end"))


def w01_labels(spark: SparkSession, folder: str) -> DataFrame:
    return seq.label_samples(samples(spark, folder), "scene", "ord", WIDTH, FPS).select("scene", "ord", "cls", scoring.rounded(F.col("shift"), 6).alias("shift"), scoring.rounded(F.col("drift"), 6).alias("drift"))


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    return seq.to_runs(seq.label_samples(samples(spark, folder), "scene", "ord", WIDTH, FPS), "scene", "ord")


def w04_runs(spark: SparkSession, folder: str) -> DataFrame:
    return _runs(spark, folder).select("scene", F.col("run").cast("bigint").alias("run"), "cls", F.col("start").alias("run_start"), F.col("end").alias("run_end"), "n")


def w04_camera_summary(spark: SparkSession, folder: str) -> DataFrame:
    """What the camera does: runs, samples and seconds of each class."""
    return _runs(spark, folder).groupBy("cls").agg(F.count(F.lit(1)).alias("runs"), F.sum("n").alias("samples"), F.sum(F.col("end") - F.col("start")).alias("seconds"))


def w03_displacements(spark: SparkSession, folder: str) -> DataFrame:
    s = samples(spark, folder)
    frames = s.select("scene", "ord", F.col("start").alias("t"), F.when(F.col("ord") % 7 != 3, F.col("dx")).alias("x"), F.lit(0.0).alias("y"))
    return seq.displacements(frames, "scene", "ord").select("scene", "ord", F.col("start").alias("from_s"), F.col("end").alias("to_s"), scoring.rounded(F.col("dx"), 6).alias("dx"))


def _exploded(runs: DataFrame) -> DataFrame:
    return runs.select("scene", F.posexplode("runs").alias("run", "r")).select("scene", F.col("run").cast("bigint").alias("run"), "r.cls", F.col("r.start").alias("run_start"), F.col("r.end").alias("run_end"))


def w05_merge_short(spark: SparkSession, folder: str) -> DataFrame:
    runs = seq.run_list(_runs(spark, folder), "scene")
    return _exploded(runs.select("scene", seq.merge_short_runs(F.col("runs")).alias("runs")))


def w06_merge_usable(spark: SparkSession, folder: str) -> DataFrame:
    runs = seq.run_list(_runs(spark, folder), "scene")
    return _exploded(runs.select("scene", seq.merge_usable_runs(F.col("runs")).alias("runs")))


def w07_segment(spark: SparkSession, folder: str) -> DataFrame:
    return _exploded(seq.segment(samples(spark, folder), "scene", "ord", WIDTH, FPS))


def w08_merge_segments(spark: SparkSession, folder: str) -> DataFrame:
    runs = seq.run_list(_runs(spark, folder), "scene")
    return _exploded(runs.select("scene", seq.merge_short_segments(F.col("runs"), 3.0).alias("runs")))


def w09_cut_list(spark: SparkSession, folder: str) -> DataFrame:
    """Cuts where the movement jumps, as a detector would give them, extended to the file's end."""
    s = samples(spark, folder)
    w = Window.partitionBy("scene").orderBy("ord")
    jump = F.coalesce((F.abs(F.col("dx") - F.lag("dx").over(w)) > 32).cast("int"), F.lit(0))
    part = s.select("scene", "ord", "start", "end", F.sum(jump).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("part"))
    cuts = part.groupBy("scene", "part").agg(F.min("start").alias("start"), F.max("end").alias("end")).withColumn("cls", F.lit(None).cast("string"))
    return _exploded(seq.run_list(cuts, "scene").select("scene", seq.cut_list(F.col("runs"), F.element_at("runs", -1)["end"] + 0.75, 3.0).alias("runs")))


def w10_speed_buckets(spark: SparkSession, folder: str) -> DataFrame:
    b = seq.speed_buckets(samples(spark, folder), "scene", "ord", WIDTH, FPS)
    return b.select("scene", F.col("second").cast("bigint").alias("second"), scoring.rounded(F.col("speed"), 6).alias("speed"))


def _profiles(spark: SparkSession, folder: str) -> DataFrame:
    return seq.speed_profile(seq.speed_buckets(samples(spark, folder), "scene", "ord", WIDTH, FPS), "scene")


def w11_reversals(spark: SparkSession, folder: str) -> DataFrame:
    p = F.col("profile")
    return _profiles(spark, folder).select("scene", seq.reversals(p).alias("reversals"), scoring.rounded(scoring.spread(p), 3).alias("spread"), seq.eases_in(p).cast("int").alias("eases"))


def w13_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Steady windows of 3 to 8 seconds."""
    found = seq.find_windows(F.col("profile"), F.lit(0.0), 3.0, F.lit(8.0))
    return _profiles(spark, folder).select("scene", F.explode(found).alias("w")).select("scene", F.col("w.start").alias("win_start"), F.col("w.end").alias("win_end"), "w.spread")


def w14_carved(spark: SparkSession, folder: str) -> DataFrame:
    p = _profiles(spark, folder).withColumn("stop", F.size("profile") + 0.4)
    pieces = seq.carve_windows(F.lit(0.0), F.col("stop"), F.lit("move"), F.col("profile"), 3.0, 8.0)
    return p.select("scene", F.posexplode(pieces).alias("piece", "p")).select("scene", "piece", F.col("p.start").alias("piece_start"), F.col("p.end").alias("piece_end"), F.size("p.profile").alias("seconds"), F.col("p.is_window").cast("int").alias("is_window"))


def _split(spark: SparkSession, folder: str) -> DataFrame:
    return seq.split_by_motion(scenes(spark, folder), samples(spark, folder), "scene", "ord", WIDTH, FPS, min_render=3.0, max_render=8.0)


def w15_split(spark: SparkSession, folder: str) -> DataFrame:
    """Scenes split at changes of movement, and their usable runs carved into steady windows of 3 to 8 seconds."""
    return _split(spark, folder).select("scene", "piece", "cls", F.col("start").alias("piece_start"), F.col("end").alias("piece_end"), F.size("profile").alias("seconds"), F.col("is_window").cast("int").alias("is_window"))


def w16_untiled(spark: SparkSession, folder: str) -> DataFrame:
    """Scenes whose runs don't cover them.

    Each scene starts and ends with its samples here; runs are whole but for planted faults: the second run of a scene starts late where
    its number leaves 1 by 5, and ends late by 2; the first run starts late by 3.
    """
    late = F.when((F.col("run") == 1) & (F.col("scene") % 5 == 1), 0.125).when((F.col("run") == 0) & (F.col("scene") % 5 == 3), 0.125).otherwise(0.0)
    over = F.when((F.col("run") == 1) & (F.col("scene") % 5 == 2), 0.125).otherwise(0.0)
    pieces = _runs(spark, folder).select("scene", (F.col("start") + late).alias("start"), (F.col("end") + over).alias("end"))
    whole = samples(spark, folder).groupBy("scene").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return seq.untiled(pieces, whole, "scene")


def w16_split_untiled(spark: SparkSession, folder: str) -> DataFrame:
    """Scenes that the pieces of ``w15_split`` don't cover: none, whatever the tables hold."""
    return seq.untiled(_split(spark, folder), scenes(spark, folder), "scene")


def j05_samples_in_runs(spark: SparkSession, folder: str) -> DataFrame:
    """How many samples have their midpoint in each run, ends included."""
    inside = seq.samples_in_runs(samples(spark, folder), _runs(spark, folder), "scene", "ord")
    return inside.groupBy("scene", F.col("run").cast("bigint").alias("run")).agg(F.count(F.lit(1)).alias("n"))


def a04_flow_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Motion, stability and technical score of each scene, its samples taken as flows."""
    s = samples(spark, folder)
    far = F.hypot("dx", "dy")
    g = s.groupBy("scene").agg(F.avg(far).alias("m"), F.stddev_pop(far).alias("sd"), F.avg("dx").alias("x"), F.avg("dy").alias("y"), F.avg(F.col("response") * 500).alias("sharp"), F.avg(F.col("response") / 4).alias("clip"))
    motion = scoring.rounded(scoring.motion_score(F.col("m"), F.lit(WIDTH)), 4)
    stability = scoring.rounded(scoring.stability_score(F.col("m"), F.col("sd"), F.col("x"), F.col("y"), F.lit(WIDTH)), 4)
    return g.select("scene", motion.alias("motion"), stability.alias("stability"), scoring.technical_score(F.col("sharp"), F.col("clip")).alias("technical"))


QUERIES = {f.__name__: f for f in (w01_labels, w03_displacements, w04_runs, w04_camera_summary, w05_merge_short, w06_merge_usable, w07_segment, w08_merge_segments, w09_cut_list, w10_speed_buckets, w11_reversals, w13_windows, w14_carved, w15_split, w16_untiled, w16_split_untiled, j05_samples_in_runs, a04_flow_scores)}

_SAMPLES = """
    e AS (SELECT user_id AS scene, event_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS ord FROM events),
    h AS (SELECT *, CAST(floor(ord / 24e0) AS BIGINT) % 3 AS ph FROM e),
    s AS (SELECT scene, ord, ord * 25e-2 AS start_s, (ord + 1) * 25e-2 AS end_s, 5e-2 + ((event_id * 7) % 96) / 1e2 AS response,
          CASE WHEN event_type IN ('error', 'signup') AND ph = 2 THEN -1e0 ELSE 1e0 END * CASE WHEN ph = 0 THEN value / 4e2 WHEN ph = 1 THEN 6e0 + value / 1e2 ELSE value / 4e0 END AS dx FROM h)
"""
_LABELS = f"""{_SAMPLES},
    f AS (SELECT scene, ord, start_s, end_s, avg(abs(dx)) OVER w AS shift, abs(avg(dx) OVER w) AS drift, avg(response) OVER w AS resp FROM s WINDOW w AS (PARTITION BY scene ORDER BY ord ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
    j AS (SELECT *, shift * 4e0 / 512e0 AS rate, CASE WHEN shift < 1e-9 THEN 0e0 ELSE greatest(0e0, least(1e0, (shift - drift) / shift)) END AS jit FROM f),
    l AS (SELECT *, CASE WHEN resp < 15e-2 THEN CASE WHEN rate < 1e-2 THEN 'held' ELSE 'reposition' END WHEN rate < 1e-2 THEN 'held' WHEN jit > 25e-2 THEN 'reposition' WHEN rate > 1e0 THEN 'reposition' ELSE 'move' END AS cls FROM j)
"""
_RUNS = f"""{_LABELS},
    n AS (SELECT *, CASE WHEN ord = 0 OR cls <> lag(cls) OVER (PARTITION BY scene ORDER BY ord) THEN 1 ELSE 0 END AS fresh FROM l),
    i AS (SELECT *, sum(fresh) OVER (PARTITION BY scene ORDER BY ord) - 1 AS run FROM n),
    r AS (SELECT scene, CAST(run AS BIGINT) AS run, min(cls) AS cls, min(start_s) AS run_start, max(end_s) AS run_end, count(*) AS n FROM i GROUP BY scene, run)
"""
_BUCKETS = f"""{_SAMPLES},
    b AS (SELECT scene, CAST(floor(ord / 4e0) AS BIGINT) AS second, avg(abs(dx)) * (4e0 / 512e0) AS speed FROM s GROUP BY 1, 2 HAVING count(*) = 4)
"""
SQL = {
    "w01_labels": f"WITH {_LABELS} SELECT scene, ord, cls, floor(shift * 1e6 + 0.5) / 1e6 AS shift, floor(drift * 1e6 + 0.5) / 1e6 AS drift FROM l",
    "w03_displacements": f"WITH {_SAMPLES}, k AS (SELECT *, lag(start_s) OVER (PARTITION BY scene ORDER BY ord) AS from_s FROM s), d AS (SELECT scene, ord, from_s, start_s AS to_s, dx - lag(dx) OVER w AS d FROM k WHERE ord % 7 <> 3 WINDOW w AS (PARTITION BY scene ORDER BY ord)) "
    "SELECT scene, ord, from_s, to_s, floor(d * 1e6 + 0.5) / 1e6 AS dx FROM d WHERE d IS NOT NULL",
    "w04_runs": f"WITH {_RUNS} SELECT scene, run, cls, run_start, run_end, n FROM r",
    "w04_camera_summary": f"WITH {_RUNS} SELECT cls, count(*) AS runs, CAST(sum(n) AS BIGINT) AS samples, sum(run_end - run_start) AS seconds FROM r GROUP BY cls",
    "w10_speed_buckets": f"WITH {_BUCKETS} SELECT scene, second, floor(speed * 1e6 + 0.5) / 1e6 AS speed FROM b",
    "w16_untiled": f"""WITH {_RUNS}, p AS (SELECT scene, run, run_start + CASE WHEN run = 1 AND scene % 5 = 1 OR run = 0 AND scene % 5 = 3 THEN 125e-3 ELSE 0e0 END AS a, run_end + CASE WHEN run = 1 AND scene % 5 = 2 THEN 125e-3 ELSE 0e0 END AS b FROM r),
        g AS (SELECT scene, b, lead(a) OVER (PARTITION BY scene ORDER BY a, b) AS nxt FROM p),
        sc AS (SELECT scene, min(run_start) AS s0, max(run_end) AS s1 FROM r GROUP BY scene)
        SELECT DISTINCT scene, 'gap or overlap' AS problem FROM g WHERE abs(nxt - b) > 1e-6
        UNION ALL SELECT sc.scene, 'ends' FROM sc JOIN p ON p.scene = sc.scene GROUP BY sc.scene, s0, s1 HAVING abs(min(a) - s0) > 1e-6 OR abs(max(b) - s1) > 1e-6""",
    "w16_split_untiled": "SELECT 0 AS scene, '' AS problem WHERE false",
    "j05_samples_in_runs": f"WITH {_RUNS} SELECT r.scene, r.run, count(*) AS n FROM r JOIN s ON s.scene = r.scene AND (s.start_s + s.end_s) / 2 BETWEEN r.run_start AND r.run_end GROUP BY r.scene, r.run",
    "a04_flow_scores": f"""WITH {_SAMPLES}, g AS (SELECT scene, avg(abs(dx)) AS m, stddev_pop(abs(dx)) AS sd, avg(dx) AS x, avg(response * 500) AS sharp, avg(response / 4) AS clip FROM s GROUP BY scene)
        SELECT scene, floor(greatest(0e0, least(1e0, tanh(m / 512e0 / 4e-2))) * 1e4 + 0.5) / 1e4 AS motion,
        floor(CASE WHEN m < 512e0 * 3e-4 THEN 1e0 ELSE greatest(0e0, least(1e0, 65e-2 * greatest(0e0, least(1e0, abs(x) / m)) + 35e-2 * greatest(0e0, least(1e0, 1e0 - sd / m)))) END * 1e4 + 0.5) / 1e4 AS stability,
        floor((6e-1 * greatest(0e0, least(1e0, sharp / 500e0)) + 4e-1 * greatest(0e0, least(1e0, 1e0 - greatest(0e0, clip - 2e-2) / 2e-1))) * 1e4 + 0.5) / 1e4 AS technical FROM g""",
}
SQL["w11_reversals"] = f"""WITH RECURSIVE {_BUCKETS},
    t AS (SELECT scene, second AS i, 0 AS k, 0 AS way, speed AS anchor FROM b WHERE second = 0
          UNION ALL
          SELECT t.scene, b.second, CASE WHEN greatest(anchor, speed) < 1e-2 OR abs(speed - anchor) / greatest(anchor, 1e-2) < 3e-1 THEN k WHEN way <> 0 AND way <> sign(speed - anchor) THEN k + 1 ELSE k END,
          CASE WHEN greatest(anchor, speed) < 1e-2 OR abs(speed - anchor) / greatest(anchor, 1e-2) < 3e-1 THEN way ELSE CAST(sign(speed - anchor) AS INTEGER) END,
          CASE WHEN greatest(anchor, speed) < 1e-2 THEN speed WHEN abs(speed - anchor) / greatest(anchor, 1e-2) < 3e-1 THEN anchor ELSE speed END
          FROM t JOIN b ON b.scene = t.scene AND b.second = t.i + 1),
    z AS (SELECT scene, max_by(k, i) AS reversals FROM t GROUP BY scene),
    q AS (SELECT scene, max(speed) AS hi, min(speed) AS lo, min_by(speed, second) AS head FROM b GROUP BY scene)
    SELECT z.scene, z.reversals, floor(CASE WHEN hi > 0 THEN hi / greatest(lo, 1e-2) ELSE 1e0 END * 1e3 + 0.5) / 1e3 AS spread, CASE WHEN head < 1e-2 THEN 1 ELSE 0 END AS eases FROM z JOIN q ON q.scene = z.scene"""


def _joined_sql(runs: str, name: str) -> str:
    """Adjoining usable runs as one, by recursion over a scene's runs."""
    return f"""
    {name}_t AS (SELECT scene, run AS i, 0 AS grp, run_start AS a, run_end AS b, cls FROM {runs} WHERE run = 0
        UNION ALL
        SELECT t.scene, r.run, CASE WHEN t.cls <> 'reposition' AND r.cls <> 'reposition' THEN t.grp ELSE t.grp + 1 END, CASE WHEN t.cls <> 'reposition' AND r.cls <> 'reposition' THEN t.a ELSE r.run_start END, r.run_end,
        CASE WHEN t.cls <> 'reposition' AND r.cls <> 'reposition' AND t.b - t.a >= r.run_end - r.run_start THEN t.cls ELSE r.cls END FROM {name}_t AS t JOIN {runs} AS r ON r.scene = t.scene AND r.run = t.i + 1),
    {name} AS (SELECT scene, CAST(grp AS BIGINT) AS run, max_by(cls, i) AS cls, min(a) AS run_start, max(b) AS run_end FROM {name}_t GROUP BY scene, grp)"""


def _swept_sql(runs: str, name: str, least: str = "3e0") -> str:
    """Short segments extended by the next, a short tail folded back."""
    return f"""
    {name}_t AS (SELECT scene, run AS i, 0 AS grp, run_start AS a, run_end AS b, cls FROM {runs} WHERE run = 0
        UNION ALL
        SELECT t.scene, r.run, CASE WHEN t.b - t.a < {least} THEN t.grp ELSE t.grp + 1 END, CASE WHEN t.b - t.a < {least} THEN t.a ELSE r.run_start END, r.run_end, CASE WHEN t.b - t.a < {least} THEN t.cls ELSE r.cls END
        FROM {name}_t AS t JOIN {runs} AS r ON r.scene = t.scene AND r.run = t.i + 1),
    {name}_g AS (SELECT scene, grp, max_by(cls, i) AS cls, max_by(a, i) AS a, max(b) AS b FROM {name}_t GROUP BY scene, grp),
    {name}_l AS (SELECT *, max(grp) OVER (PARTITION BY scene) AS last FROM {name}_g),
    {name}_f AS (SELECT *, bool_or(grp = last AND grp > 0 AND b - a < {least}) OVER (PARTITION BY scene) AS fold, max(b) OVER (PARTITION BY scene) AS stop FROM {name}_l),
    {name} AS (SELECT scene, CAST(grp AS BIGINT) AS run, cls, a AS run_start, CASE WHEN fold AND grp = last - 1 THEN stop ELSE b END AS run_end FROM {name}_f WHERE NOT (fold AND grp = last))"""


def _absorbed_sql(runs: str, name: str) -> str:
    """The first short run joins its longer neighbour, again and again; equal neighbours then become one."""
    short = "(x.b - x.a < CASE WHEN x.c = 'reposition' THEN 1e0 ELSE 3e0 END)"
    return f"""
    {name}_s AS (SELECT scene, list({{'a': run_start, 'b': run_end, 'c': cls}} ORDER BY run) AS v FROM {runs} GROUP BY scene),
    {name}_r AS (SELECT scene, 0 AS step, v, list_position(list_transform(v, lambda x: {short}), true) AS pos FROM {name}_s
        UNION ALL
        SELECT scene, step + 1, w, list_position(list_transform(w, lambda x: {short}), true) FROM (
            SELECT scene, step, list_concat(list_concat(v[1:j - 1], [{{'a': v[j].a, 'b': v[j + 1].b, 'c': CASE WHEN back THEN v[j].c ELSE v[j + 1].c END}}]), v[j + 2:]) AS w FROM (
                SELECT *, CASE WHEN back THEN pos - 1 ELSE pos END AS j FROM (
                    SELECT *, CASE WHEN pos = len(v) THEN true WHEN pos = 1 THEN false ELSE v[pos - 1].b - v[pos - 1].a >= v[pos + 1].b - v[pos + 1].a END AS back FROM {name}_r WHERE pos > 0 AND len(v) > 1) AS p) AS q) AS o),
    {name}_e AS (SELECT scene, unnest(v) AS x, unnest(range(0, len(v))) AS i FROM (SELECT scene, max_by(v, step) AS v FROM {name}_r GROUP BY scene) AS m),
    {name}_n AS (SELECT scene, i, x.a AS a, x.b AS b, x.c AS cls, CASE WHEN x.c = lag(x.c) OVER (PARTITION BY scene ORDER BY i) THEN 0 ELSE 1 END AS fresh FROM {name}_e),
    {name}_k AS (SELECT *, sum(fresh) OVER (PARTITION BY scene ORDER BY i) - 1 AS grp FROM {name}_n),
    {name} AS (SELECT scene, CAST(grp AS BIGINT) AS run, min(cls) AS cls, min(a) AS run_start, max(b) AS run_end FROM {name}_k GROUP BY scene, grp)"""


_SELECT = "SELECT scene, run, cls, run_start, run_end FROM "
SQL["w05_merge_short"] = f"WITH RECURSIVE {_RUNS}, {_absorbed_sql('r','u')} {_SELECT} u"
SQL["w06_merge_usable"] = f"WITH RECURSIVE {_RUNS}, {_joined_sql('r','u')} {_SELECT} u"
SQL["w07_segment"] = f"WITH RECURSIVE {_RUNS}, {_absorbed_sql('r','u')}, {_joined_sql('u','y')} {_SELECT} y"
SQL["w08_merge_segments"] = f"WITH RECURSIVE {_RUNS}, {_swept_sql('r','u')} {_SELECT} u"
SQL["w09_cut_list"] = f"""WITH RECURSIVE {_SAMPLES},
    m AS (SELECT *, CASE WHEN abs(dx - lag(dx) OVER (PARTITION BY scene ORDER BY ord)) > 32 THEN 1 ELSE 0 END AS jump FROM s),
    p AS (SELECT *, sum(jump) OVER (PARTITION BY scene ORDER BY ord) AS part FROM m),
    q AS (SELECT scene, CAST(part AS BIGINT) AS run, CAST(NULL AS VARCHAR) AS cls, min(start_s) AS run_start, max(end_s) AS stop FROM p GROUP BY scene, part),
    r AS (SELECT scene, run, cls, run_start, CASE WHEN run = max(run) OVER (PARTITION BY scene) THEN stop + 75e-2 ELSE stop END AS run_end FROM q), {_swept_sql('r','u')} {_SELECT} u"""


def _windows_sql(profiles: str) -> str:
    """Steady windows of 3 to 8 seconds of each group g in ``profiles`` (g, second, speed): tables wn (seconds of g), rv (turns of every stretch), wz (g, o, e, s)."""
    still = "(greatest(anchor, speed) < 1e-2 OR abs(speed - anchor) / greatest(anchor, 1e-2) < 3e-1)"
    return f"""
    wn AS (SELECT g, count(*) AS n FROM {profiles} GROUP BY g),
    rv AS (SELECT g, second AS o, second + 1 AS e, 0 AS turns, 0 AS way, speed AS anchor, speed AS lo, speed AS hi, speed AS head FROM {profiles}
        UNION ALL
        SELECT t.g, t.o, t.e + 1, CASE WHEN {still} THEN turns WHEN way <> 0 AND way <> sign(speed - anchor) THEN turns + 1 ELSE turns END,
        CASE WHEN {still} THEN way ELSE CAST(sign(speed - anchor) AS INTEGER) END,
        CASE WHEN greatest(anchor, speed) < 1e-2 THEN speed WHEN {still} THEN anchor ELSE speed END,
        least(lo, speed), greatest(hi, speed), head FROM rv AS t JOIN {profiles} AS b ON b.g = t.g AND b.second = t.e),
    wf AS (SELECT g, o, e - o AS k, CASE WHEN hi > 0 THEN hi / greatest(lo, 1e-2) ELSE 1e0 END AS spread, head < 1e-2 AS eased FROM rv WHERE turns = 0 AND e - o BETWEEN 3 AND 8),
    wg AS (SELECT *, bool_or(spread <= 3e0) OVER (PARTITION BY g) AS strict FROM wf),
    wm AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY k DESC, spread, o) AS rk FROM wg WHERE spread <= 3e0 OR (NOT strict AND eased)),
    wy AS (SELECT g, rk, [{{'o': o, 'e': o + k, 's': spread}}] AS taken FROM wm WHERE rk = 1
        UNION ALL
        SELECT y.g, m.rk, CASE WHEN len(list_filter(taken, lambda z: z.o < m.o + m.k AND m.o < z.e)) > 0 THEN taken ELSE list_concat(taken, [{{'o': m.o, 'e': m.o + m.k, 's': m.spread}}]) END FROM wy AS y JOIN wm AS m ON m.g = y.g AND m.rk = y.rk + 1),
    wz AS (SELECT g, w.o AS o, w.e AS e, w.s AS s FROM (SELECT g, unnest(max_by(taken, rk)) AS w FROM wy GROUP BY g) AS u)"""


def _carved_sql(profiles: str, spans: str) -> str:
    """Pieces cp (g, piece, a, b, seconds, is_window) of the runs in ``spans`` (g, a, b) by windows of 3 to 8 seconds."""
    turned = "coalesce((SELECT max(turns) FROM rv WHERE rv.g = q.g AND rv.o = {lo} AND rv.e = least(q.n, {hi})), 0)"
    return f"""{_windows_sql(profiles)},
    cs AS (SELECT s.g, s.a, s.b, coalesce(n.n, 0) AS n, n.n IS NOT NULL AND s.b - s.a >= 3e0 AS carving FROM {spans} AS s LEFT JOIN wn AS n ON n.g = s.g),
    cw AS (SELECT z.g, s.a, s.b, s.n, s.a + z.o AS ws, s.a + z.e AS we, row_number() OVER (PARTITION BY z.g ORDER BY z.o) AS j FROM wz AS z JOIN cs AS s ON s.g = z.g WHERE s.carving),
    cx AS (SELECT g, CAST(0 AS BIGINT) AS j, a AS here, CAST([] AS STRUCT(a DOUBLE, b DOUBLE, w INTEGER)[]) AS parts FROM cw WHERE j = 1
        UNION ALL
        SELECT g, j, last, list_concat(parts, CASE WHEN apart THEN [{{'a': here, 'b': ws, 'w': 0}}, {{'a': head, 'b': last, 'w': 1}}] ELSE [{{'a': head, 'b': last, 'w': 1}}] END) FROM (
            SELECT *, CASE WHEN b - stop <= 1e0 AND {turned.format(lo="CAST(round_even(q.head - q.a, 0) AS BIGINT)", hi="CAST(round_even(q.b - q.a, 0) AS BIGINT)")} = 0 THEN b ELSE stop END AS last FROM (
                SELECT *, CASE WHEN apart OR here >= ws THEN ws ELSE here END AS head, least(we, b) AS stop FROM (
                    SELECT *, here < ws AND (ws - here > 1e0 OR {turned.format(lo="CAST(round_even(q.here - q.a, 0) AS BIGINT)", hi="CAST(round_even(q.we - q.a, 0) AS BIGINT)")} > 0) AS apart FROM (
                        SELECT w.*, x.here, x.parts FROM cx AS x JOIN cw AS w ON w.g = x.g AND w.j = x.j + 1) AS q) AS q) AS q) AS q),
    ce AS (SELECT g, max_by(here, j) AS here, max_by(parts, j) AS parts FROM cx GROUP BY g),
    cl AS (SELECT s.g, s.a AS s0, s.n, CASE WHEN e.g IS NULL THEN [{{'a': s.a, 'b': s.b, 'w': CASE WHEN s.carving THEN 0 ELSE 1 END}}]
            WHEN s.b - e.here > 1e-2 THEN list_concat(e.parts, [{{'a': e.here, 'b': s.b, 'w': 0}}]) ELSE e.parts END AS parts FROM cs AS s LEFT JOIN ce AS e ON e.g = s.g),
    cp AS (SELECT g, piece, p.a AS a, p.b AS b, p.w AS is_window, CAST(CASE WHEN len(parts) = 1 AND whole THEN n ELSE greatest(0, least(n, CAST(round_even(p.b - s0, 0) AS BIGINT)) - greatest(0, CAST(round_even(p.a - s0, 0) AS BIGINT))) END AS BIGINT) AS seconds
        FROM (SELECT *, g NOT IN (SELECT g FROM ce) AS whole, unnest(parts) AS p, unnest(range(0, len(parts))) AS piece FROM cl) AS u)"""


SQL["w13_windows"] = f"WITH RECURSIVE {_BUCKETS}, b2 AS (SELECT scene AS g, second, speed FROM b), {_windows_sql('b2')} SELECT g AS scene, CAST(o AS DOUBLE) AS win_start, CAST(e AS DOUBLE) AS win_end, floor(s * 1e3 + 0.5) / 1e3 AS spread FROM wz"
SQL["w14_carved"] = f"""WITH RECURSIVE {_BUCKETS}, b2 AS (SELECT scene AS g, second, speed FROM b), sp AS (SELECT g, 0e0 AS a, count(*) + 4e-1 AS b FROM b2 GROUP BY g), {_carved_sql('b2', 'sp')}
    SELECT g AS scene, CAST(piece AS INTEGER) AS piece, a AS piece_start, b AS piece_end, seconds, is_window FROM cp"""
SPLIT_SQL = f"""WITH RECURSIVE {_RUNS}, {_absorbed_sql('r','u')}, {_joined_sql('u','y')},
    sc AS (SELECT scene, min(start_s) - 1e-1 AS s0, max(end_s) + 1e-1 AS s1 FROM s GROUP BY scene),
    rr AS (SELECT y.scene, y.run, y.cls, CASE WHEN y.run = 0 THEN s0 ELSE run_start END AS a, CASE WHEN y.run = max(y.run) OVER (PARTITION BY y.scene) THEN s1 ELSE run_end END AS b FROM y JOIN sc ON sc.scene = y.scene),
    ri AS (SELECT rr.scene, rr.run, s.dx, row_number() OVER (PARTITION BY rr.scene, rr.run ORDER BY s.ord) - 1 AS i FROM rr JOIN s ON s.scene = rr.scene AND (s.start_s + s.end_s) / 2 BETWEEN rr.a AND rr.b),
    rb AS (SELECT scene, run, i // 4 AS second, avg(abs(dx)) * (4e0 / 512e0) AS speed FROM ri GROUP BY ALL HAVING count(*) = 4),
    b2 AS (SELECT (scene * 100000 + run) * 2 + CASE WHEN cls = 'held' THEN 0 ELSE 1 END AS g, second, speed FROM rb JOIN rr USING (scene, run) WHERE cls <> 'reposition'),
    sp AS (SELECT (scene * 100000 + run) * 2 + CASE WHEN cls = 'held' THEN 0 ELSE 1 END AS g, a, b FROM rr WHERE cls <> 'reposition'), {_carved_sql('b2', 'sp')},
    rk AS (SELECT scene, run, count(*) AS k FROM rb GROUP BY scene, run),
    al AS (SELECT g // 200000 AS scene, g // 2 % 100000 AS run, g % 2 AS code, piece, a, b, seconds, is_window FROM cp
        UNION ALL SELECT rr.scene, rr.run, 2, 0, rr.a, rr.b, coalesce(rk.k, 0), 1 FROM rr LEFT JOIN rk ON rk.scene = rr.scene AND rk.run = rr.run WHERE cls = 'reposition')"""
CLASS_SQL = "CASE code WHEN 0 THEN 'held' WHEN 1 THEN 'move' ELSE 'reposition' END AS cls"
SQL["w15_split"] = f"""{SPLIT_SQL}
    SELECT scene, CAST(row_number() OVER (PARTITION BY scene ORDER BY a, run, piece) - 1 AS INTEGER) AS piece, {CLASS_SQL}, a AS piece_start, b AS piece_end, seconds, is_window FROM al"""
