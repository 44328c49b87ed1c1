"""Captions, commands, posts and answers, and the queues and counts of the stages, over the catalogue's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylode.functions import render, responses, scoring
from skylode.functions import text as tx
from skylode.operators import sequences as seq
from skylode.plans import sequences as scenes
from skylode.plans.shaping import _CASED, _LIST, _SCORED, _SHOT, _SRC, _shots, _sources, _with_source, a17_rejected
from skylode.sources.tables import read_table

HEADLINE = "It's 100% real: above"
# Fixed value: why a searching camera's shot isn't offered.
SEARCHING = "repositioning: camera searching, not composed"


def f16_captions(spark: SparkSession, folder: str) -> DataFrame:
    return _sources(spark, folder, "country", "captured_at").select("id", render.caption(F.lit(HEADLINE), F.col("country"), F.col("captured_at")).alias("caption"))


def _lines():
    return render.overlay_lines(F.lit(HEADLINE), F.col("captured_at"), F.col("country"), F.col("site"))


def f17_overlays(spark: SparkSession, folder: str) -> DataFrame:
    return _sources(spark, folder, "country", "captured_at", "site").select("id", F.array_join(_lines(), " / ").alias("overlay"))


def f18_clips(spark: SparkSession, folder: str) -> DataFrame:
    """Ends of clips of at most 20 seconds."""
    return _shots(spark, folder, "in_point", "out_point").select("id", render.clip_end(F.col("in_point"), F.col("out_point"), 20.0).alias("clip_end"))


def _offset():
    """Where the subject of a picture is: unknown for every fourth source."""
    return F.when(F.col("id") % 4 != 0, (F.col("id") % 11) / 10.0)


def f22_crop_filters(spark: SparkSession, folder: str) -> DataFrame:
    return _sources(spark, folder, "width", "height").select("id", render.crop_filter(F.col("width"), F.col("height"), _offset()).alias("filter"))


def _clip():
    start = (F.col("id") % 7) * 1.5
    return F.col("relpath"), start, start + (F.col("id") % 13) + 0.25


def f24_luma_commands(spark: SparkSession, folder: str) -> DataFrame:
    s = _sources(spark, folder, "relpath", "width", "height")
    return s.select("id", F.array_join(render.luma_command(*_clip(), F.col("width"), F.col("height"), _offset()), " ").alias("command"))


def f26_social_commands(spark: SparkSession, folder: str) -> DataFrame:
    """Upright clips with their overlay, its colours by how bright the backdrop is."""
    s = _sources(spark, folder, "relpath", "width", "height", "country", "captured_at", "site")
    source, start, end = _clip()
    luma = F.when(F.col("id") % 9 != 0, (F.col("id") % 101) / 100.0)
    command = render.social_command(source, F.concat(F.lit("out/"), F.col("id").cast("string"), F.lit(".mp4")), start, end, F.col("width"), F.col("height"), _offset(), _lines(), render.palette(luma))
    return s.select("id", F.array_join(command, " ").alias("command"))


def f27_master_commands(spark: SparkSession, folder: str) -> DataFrame:
    source, start, end = _clip()
    codec = F.when(F.col("id") % 3 == 0, "libx264").when(F.col("id") % 3 == 1, "prores_ks").otherwise("dnxhd")
    return _sources(spark, folder, "relpath").select("id", F.array_join(render.master_command(source, F.lit("out.mov"), start, end, codec), " ").alias("command"))


def f28_content_types(spark: SparkSession, folder: str) -> DataFrame:
    name = F.concat(F.col("relpath"), F.when(F.col("id") % 5 == 0, ".JPG").when(F.col("id") % 5 == 1, ".Webm").when(F.col("id") % 5 == 2, ".xyz").otherwise(""))
    return _sources(spark, folder, "relpath").select("id", responses.content_type(name).alias("content_type"), responses.media_kind(name).alias("kind"))


#: Bodies of error answers, taken in turns, and the line that each becomes.
BODIES = (
    ('{"message":"Bad Request","issues":[{"path":["platforms",0,"id"],"message":"gone"},{"code":"x1"},"plain"]}', "Bad Request (platforms.0.id: gone; x1; plain)"),
    ('{"error":{"message":"inner","more":1}}', "inner"),
    ("<html>oops\nagain", None),
    ("", "{}"),
    ('{"error":"plain words"}', "plain words"),
    ('{"message":"","error":null}', '{"message":"","error":null}'),
    ("[1,2]", "[1,2]"),
    ('{"message":"six","issues":[{"message":"a"},{"message":"b"},{"message":"c"},{"message":"d"},{"message":"e"},{"message":"f"}]}', "six (a; b; c; d; e)"),
)
STATUS = (400, 401, 429, 500, 404)


def f30_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Lines for error answers, and whether to try again."""
    e = read_table(spark, folder, "events", "event_id")
    body = F.array(*[F.lit(b) for b, _ in BODIES])[(F.col("event_id") % len(BODIES)).cast("int")]
    status = F.array(*[F.lit(s) for s in STATUS])[(F.col("event_id") % len(STATUS)).cast("int")]
    return e.select("event_id", responses.error_text(status, body).alias("error"), responses.retryable(status).cast("int").alias("again"))


def f32_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies of posts, or why there is none."""
    i = F.col("id")
    accounts = F.when(i % 4 == 0, F.create_map(F.lit("instagram"), F.concat(F.lit("a"), i.cast("string")))).when(i % 4 == 1, F.create_map(F.lit("youtube"), F.lit("y"), F.lit("tiktok"), F.lit("t"))).when(i % 4 == 2, F.create_map(F.lit("youtube"), F.lit("y")))
    url = F.when(i % 3 != 0, F.concat(F.lit("u/"), i.cast("string")))
    caption = F.when(i % 5 == 0, "  ").otherwise(F.concat(F.lit(" shot "), i.cast("string")))
    body = responses.post_body(caption, accounts, url, F.lit("video"), F.when(i % 2 == 0, "p"), F.when(i % 7 == 0, F.lit(1500)))
    return _sources(spark, folder, "width").select("id", body.alias("body"), responses.post_problem(accounts, url).alias("problem"))


def _answer():
    """An answer to a post made of an event: two rows of one platform, one without a platform, one without a state."""
    e = F.col("event_type")
    row = lambda p, s, x, a: F.struct(p.alias("platform"), s.alias("status"), x.alias("error"), a.alias("accountId"))
    none = F.lit(None).cast("string")
    rows = F.array(row(e, F.lit("PENDING"), none, F.lit("a1")), row(F.lit(""), F.lit("Error"), F.lit(" no access "), none), row(F.lit("tiktok"), none, F.lit(""), none), row(e, F.upper(e), F.when(F.col("event_id") % 3 == 0, "late"), F.lit("a2")))
    return F.struct(F.when(F.col("event_id") % 4 != 0, F.col("event_id").cast("string")).alias("_id"), rows.alias("platforms"))


def f33_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """States by platform, the last of a platform's rows counting."""
    e = read_table(spark, folder, "events", "event_id", "event_type")
    return e.select("event_id", F.explode(responses.delivery(_answer()["platforms"])).alias("platform", "state"))


def f34_published(spark: SparkSession, folder: str) -> DataFrame:
    """What is kept of answers to posts; dry runs give no id."""
    got = read_table(spark, folder, "events", "event_id", "event_type").select("event_id", F.to_json(F.struct(_answer().alias("post"))).alias("answer")).select("event_id", responses.published(F.col("answer")).alias("p")).select("event_id", "p.post_id", F.col("p.accounts").alias("a"), F.col("p.states").alias("s"))
    as_text = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda x: F.concat_ws("=", x["key"], x["value"])), ";")
    return got.select("event_id", "post_id", as_text("a").alias("accounts"), as_text("s").alias("states"), responses.failed_delivery(F.col("s")).cast("int").alias("failed"))


def f38_known_facts(spark: SparkSession, folder: str) -> DataFrame:
    s = _sources(spark, folder, "country", "site", "captured_at", "gps_lat", "gps_lon", "duration")
    whole = tx.known_facts(F.col("country"), F.col("site"), F.col("captured_at"), F.floor("gps_lat"), F.floor("gps_lon"), F.floor("duration"))
    return s.select("id", whole.alias("facts"))


def p09_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Why shots aren't offered once their source is segmented."""
    outside = F.concat(F.lit("outside a steady "), tx.number_text(F.lit(3.0)), F.lit("s window"))
    reason = F.when(F.col("motion_class") == "reposition", SEARCHING).when(F.col("is_window") == 0, outside)
    return _shots(spark, folder, "motion_class", "is_window").select("id", reason.alias("reason")).where("reason IS NOT NULL")


def a16_segment_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of a segmentation in one row: sources, shots, searching and usable ones, sources of one shot, sources without a length."""
    by = _shots(spark, folder, "source_id", "motion_class").groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("motion_class") == "reposition").alias("r"))
    one = by.agg(F.count(F.lit(1)).alias("sources"), F.sum("n").alias("shots"), F.sum("r").alias("reposition"), F.sum(F.col("n") - F.col("r")).alias("usable"), F.count_if(F.col("n") == 1).alias("continuous"))
    failed = _sources(spark, folder, "duration").agg(F.count_if(F.coalesce("duration", F.lit(0.0)) == 0).alias("without_length"))
    return one.crossJoin(failed)  # one row each


def q12_exports(spark: SparkSession, folder: str) -> DataFrame:
    """Kept and tagged shots of one tier in order of country and time; the tables say nothing of rendered files."""
    s = _shots(spark, folder, "source_id", "rejected", "tagged_at", "license_tier").where("rejected = 0 AND tagged_at IS NOT NULL AND license_tier = 'exclusive'")
    return _with_source(spark, folder, s, "country", "captured_at").select("id", "country", "captured_at").orderBy("country", "captured_at", "id")


def _purgeable(spark: SparkSession, folder: str) -> DataFrame:
    open_ = _shots(spark, folder, "source_id", "rejected").where("rejected = 0").select("source_id")
    s = _sources(spark, folder, "relpath", "size_bytes", "scene_detected_at", "purged_at").where("scene_detected_at IS NOT NULL AND purged_at IS NULL")
    return s.join(open_, F.col("id") == F.col("source_id"), "left_anti")


def q13_purgeable(spark: SparkSession, folder: str) -> DataFrame:
    """Segmented files that are still there and of which every shot is rejected (no table says which are rendered)."""
    return _purgeable(spark, folder).select("id", "relpath").orderBy("relpath", "id")


def a11_purge_totals(spark: SparkSession, folder: str) -> DataFrame:
    return _purgeable(spark, folder).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"))


def q21_stamped(spark: SparkSession, folder: str) -> DataFrame:
    """Sources after a run: those with shots are stamped as segmented, those without a length are to be done again."""
    there = _shots(spark, folder, "source_id").select(F.col("source_id").alias("sid")).distinct()
    s = _sources(spark, folder, "duration", "scene_detected_at").join(there, F.col("id") == F.col("sid"), "left")
    stamp = F.when(F.coalesce("duration", F.lit(0.0)) == 0, F.lit(None).cast("string")).when(F.col("sid").isNotNull(), F.coalesce("scene_detected_at", F.lit("2026-01-01 00:00:00"))).otherwise(F.col("scene_detected_at"))
    return s.select("id", stamp.alias("scene_detected_at"))


def s05_dense_times(spark: SparkSession, folder: str) -> DataFrame:
    """How many frames a dense pass over each file takes, and when the last one is."""
    t = seq.dense_times(F.lit(0.0), F.col("duration"), 4.0, 600)
    return _sources(spark, folder, "duration").select("id", t.alias("t")).select("id", F.size("t").alias("frames"), F.try_element_at("t", F.lit(-1)).alias("last_time"))


def u_tag_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Union, intersection and difference of each shot's two lists of tags, and whether one contains the other."""
    nothing = F.array().cast("array<string>")
    lists = {c: F.array_distinct(F.array_compact(F.coalesce(tx.tag_elements(F.col(f"{c}_tags")), nothing))).alias(c) for c in ("subject", "mood")}
    s = _shots(spark, folder, "subject_tags", "mood_tags").select("id", *lists.values())
    text = lambda x: F.array_join(F.array_sort(x), "|")
    return s.select("id", text(F.array_union("subject", "mood")).alias("either"), text(F.array_intersect("subject", "mood")).alias("both"), text(F.array_except("subject", "mood")).alias("only_subject"), (F.size(F.array_except("mood", "subject")) == 0).cast("int").alias("mood_within"))


def w21_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Reversals and spread of each scene's speed, as they are stored with a shot."""
    turns, spread = seq.summary(F.col("profile"))
    return scenes._profiles(spark, folder).select("scene", turns.alias("reversals"), spread.alias("spread"))


def a12_run_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of a segmentation by class and whether they are steady windows."""
    return scenes._split(spark, folder).groupBy("cls", F.col("is_window").cast("int").alias("is_window")).agg(F.count(F.lit(1)).alias("pieces"), scoring.rounded(F.sum(F.col("end") - F.col("start")), 3).alias("seconds"))


def q20_flagged(spark: SparkSession, folder: str) -> DataFrame:
    """Shots with the judgement of ``a17_rejected`` written back: judged ones are cleared and flagged anew, the others keep their flag."""
    shots = _shots(spark, folder, "rejected", "scored_at", "motion_class", "is_window")
    judged = F.expr("scored_at IS NOT NULL AND (motion_class IS NULL OR motion_class <> 'reposition') AND coalesce(is_window, 1) = 1")
    j = shots.join(a17_rejected(spark, folder).withColumnRenamed("id", "__id"), F.col("id") == F.col("__id"), "left")
    return j.select("id", F.when(judged, F.col("__id").isNotNull().cast("int")).otherwise(F.col("rejected")).alias("rejected"), "reason")


def q23_ids_by_path(spark: SparkSession, folder: str) -> DataFrame:
    """The id of each path, as a write by path hands it back."""
    return _sources(spark, folder, "path").select("path", "id")


def a02_latest_stamp(spark: SparkSession, folder: str) -> DataFrame:
    """The latest time, as text, at which a shot of each tier was tagged."""
    return _shots(spark, folder, "license_tier", "tagged_at").groupBy("license_tier").agg(F.max("tagged_at").alias("latest"))


def f35_stamps(spark: SparkSession, folder: str) -> DataFrame:
    """Times of shots read from text, moved by a day and written again."""
    s = _shots(spark, folder, "scored_at").select("id", tx.parsed_stamp(F.col("scored_at")).alias("t"))
    seconds = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01', t)")  # whatever the session's zone is
    return s.select("id", seconds.alias("seconds"), tx.stamp(F.col("t") + F.expr("INTERVAL 1 DAY")).alias("next_day"))


def j04_zipped(spark: SparkSession, folder: str) -> DataFrame:
    """A scene's merged runs met by place with the ids that they were given."""
    runs = seq.segment(scenes.samples(spark, folder), "scene", "ord", scenes.WIDTH, scenes.FPS)
    ids = F.transform(F.col("runs"), lambda r, i: F.col("scene") * 1000 + i)
    return runs.select("scene", F.explode(F.arrays_zip("runs", ids.alias("ids"))).alias("z")).select("scene", F.col("z.ids").cast("bigint").alias("id"), "z.runs.cls", F.col("z.runs.start").alias("run_start"))


def j06_platforms(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts of the platforms that are wanted, in their order; all where none is named."""
    i = F.col("id")
    accounts = F.create_map(F.lit("instagram"), F.lit("a"), F.lit("tiktok"), F.lit("b"), F.lit("youtube"), F.lit("c"))
    wanted = F.when(i % 4 == 0, F.array(F.lit("tiktok"), F.lit("nowhere"), F.lit("instagram"))).when(i % 4 == 1, F.array().cast("array<string>")).when(i % 4 == 2, F.array(F.lit("nowhere")))
    chosen = responses.wanted_accounts(accounts, wanted)
    return _sources(spark, folder, "width").select("id", F.array_join(F.transform(F.map_entries(chosen), lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("accounts"))


QUERIES = {
    f.__name__: f
    for f in (f16_captions, f17_overlays, f18_clips, f22_crop_filters, f24_luma_commands, f26_social_commands, f27_master_commands, f28_content_types, f30_errors, f32_posts, f33_deliveries, f34_published, f38_known_facts, p09_reasons, a11_purge_totals, a12_run_counts, a16_segment_counts, q12_exports, q13_purgeable, q21_stamped, s05_dense_times, u_tag_sets, w21_summaries, q20_flagged, q23_ids_by_path, a02_latest_stamp, f35_stamps, j04_zipped, j06_platforms)
}

_QUOTED = HEADLINE.replace("'", "''")
_PLACE = f"nullif(concat_ws(' · ', {_CASED.format(x='country')}, nullif(substr(captured_at, 1, 4), '')), '')"
_UNDER = "nullif(concat_ws(' · ', nullif(substr(captured_at, 1, 4), ''), nullif(site, ''), nullif(country, '')), '')"
_EVEN = "greatest(2, CAST(round_even({x}, 0) AS BIGINT) - CAST(round_even({x}, 0) AS BIGINT) % 2)"
_E = {k: _EVEN.format(x=x) for k, x in {"w": "CAST(width AS DOUBLE)", "h": "CAST(height AS DOUBLE)", "hw": "height * 9e0 / 16", "wh": "width / (9e0 / 16)"}.items()}
_CROP = f"""CASE WHEN width > 0 AND height > 0 AND abs(CAST(width AS DOUBLE) / height - 9e0 / 16) >= 1e-3 THEN CASE WHEN CAST(width AS DOUBLE) / height > 9e0 / 16
    THEN concat('crop=', least({_E['hw']}, {_E['w']}), ':', {_E['h']}, CASE WHEN id % 4 <> 0 THEN concat(':', CAST(round_even(least(greatest(id % 11 / 1e1 * width - least({_E['hw']}, {_E['w']}) / 2e0, 0e0), width - least({_E['hw']}, {_E['w']})), 0) AS BIGINT), ':0') ELSE '' END)
    ELSE concat('crop=', {_E['w']}, ':', least({_E['wh']}, {_E['h']})) END END"""
_SPAN = "concat('-ss ', printf('%.3f', id % 7 * 15e-1), ' -to ', printf('%.3f', id % 7 * 15e-1 + id % 13 + 25e-2), ' -i ', relpath)"
_COMMA = f"CASE WHEN {_CROP} IS NULL THEN '' ELSE concat({_CROP}, ',') END"
_ESC = "regexp_replace({x}, '([\\\\:''%])', '\\\\\\1', 'g')"
_FONT = "CASE WHEN id % 9 <> 0 AND id % 101 / 1e2 > 6e-1 THEN 'black' ELSE 'white' END"
_SHADE = "CASE WHEN id % 9 <> 0 AND id % 101 / 1e2 > 6e-1 THEN 'white@0.55' ELSE 'black@0.55' END"
_DRAWN = "concat('drawtext=text=''', {x}, ''':fontcolor=', {font}, ':fontsize=h/{size}:x=(w-text_w)/2:y=h*{y}:box=0:shadowcolor=', {shade}, ':shadowx=2:shadowy=2')"
_DOT = "CASE id % 5 WHEN 0 THEN '.jpg' WHEN 1 THEN '.webm' WHEN 2 THEN '.xyz' ELSE lower(regexp_extract(relpath, '(\\.[^./\\\\]+)$', 1)) END"
_LINE_SQL = "CASE event_id % 8 " + " ".join(f"WHEN {i} THEN '{m}'" for i, (_, m) in enumerate(BODIES) if m is not None) + " END"
_CODE = "CASE event_id % 5 " + " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(STATUS)) + " END"
_STATES = """
    r AS (SELECT event_id, unnest([{'p': event_type, 's': concat(lower(event_type), CASE WHEN event_id % 3 = 0 THEN ': late' ELSE '' END)}, {'p': '?', 's': 'error: no access'}, {'p': 'tiktok', 's': 'unknown'}]) AS x FROM events)
"""
_OPEN = f"c AS {_SHOT}, s AS {_SRC}, g AS (SELECT * FROM s WHERE scene_detected_at IS NOT NULL AND purged_at IS NULL AND NOT EXISTS (SELECT 1 FROM c WHERE c.source_id = s.id AND c.rejected = 0))"
SQL = {
    "f16_captions": f"WITH c AS {_SRC} SELECT id, CASE WHEN {_PLACE} IS NULL THEN '{_QUOTED}' ELSE concat('{_QUOTED}', chr(10), repeat(concat(chr(10240), chr(10)), 10), chr(10), {_PLACE}) END AS caption FROM c",
    "f17_overlays": f"WITH c AS {_SRC} SELECT id, concat_ws(' / ', '{_QUOTED}', {_UNDER}) AS overlay FROM c",
    "f18_clips": f"WITH c AS {_SHOT} SELECT id, least(out_point, in_point + 2e1) AS clip_end FROM c",
    "f22_crop_filters": f"WITH c AS {_SRC} SELECT id, {_CROP} AS filter FROM c",
    "f24_luma_commands": f"WITH c AS {_SRC} SELECT id, concat('ffmpeg -hide_banner -loglevel error ', {_SPAN}, ' -vf ', {_COMMA}, 'crop=iw*0.7:ih*0.150:iw*0.15:ih*0.700,fps=2.0,scale=8:2,format=gray -f rawvideo -pix_fmt gray -') AS command FROM c",
    "f26_social_commands": f"""WITH c AS {_SRC} SELECT id, concat('ffmpeg -hide_banner -loglevel error -y ', {_SPAN}, ' -vf ', {_COMMA}, 'scale=1080:1920,setsar=1,', {_DRAWN.format(x=_ESC.format(x=f"'{_QUOTED}'"), font=_FONT, shade=_SHADE, size=16, y='0.720')},
        CASE WHEN {_UNDER} IS NULL THEN '' ELSE concat(',', {_DRAWN.format(x=_ESC.format(x=_UNDER), font=_FONT, shade=_SHADE, size=22, y='0.780')}) END, ' -c:v libx264 -preset slow -crf 20 -pix_fmt yuv420p -movflags +faststart -an out/', id, '.mp4') AS command FROM c""",
    "f27_master_commands": f"WITH c AS {_SRC} SELECT id, concat('ffmpeg -hide_banner -loglevel error -y ', {_SPAN}, ' -c:v ', CASE id % 3 WHEN 0 THEN 'libx264 -preset slow -crf 12 -pix_fmt yuv420p' WHEN 1 THEN 'prores_ks -profile:v 3' ELSE 'dnxhd' END, ' -c:a copy out.mov') AS command FROM c",
    "f28_content_types": f"WITH c AS {_SRC}, d AS (SELECT id, {_DOT} AS e FROM c) SELECT id, CASE e WHEN '.mp4' THEN 'video/mp4' WHEN '.mov' THEN 'video/quicktime' WHEN '.webm' THEN 'video/webm' WHEN '.jpg' THEN 'image/jpeg' WHEN '.jpeg' THEN 'image/jpeg' WHEN '.png' THEN 'image/png' WHEN '.webp' THEN 'image/webp' END AS content_type, CASE WHEN e IN ('.mp4', '.mov', '.webm') THEN 'video' WHEN e IN ('.jpg', '.jpeg', '.png', '.webp') THEN 'image' END AS kind FROM d",
    "f30_errors": f"SELECT event_id, CASE WHEN event_id % 8 = 2 THEN concat('invalid response (HTTP ', {_CODE}, '): <html>oops again') ELSE concat({_LINE_SQL}, CASE WHEN event_id % 5 = 1 AND event_id % 8 NOT IN (6) THEN ' — check the key' ELSE '' END) END AS error, CASE WHEN event_id % 5 IN (2, 3) THEN 1 ELSE 0 END AS again FROM events",
    "f32_posts": f"""WITH c AS {_SRC}, p AS (SELECT id, CASE WHEN id % 4 = 3 THEN 'no connected accounts' WHEN id % 3 = 0 AND id % 4 = 0 THEN 'instagram require media' WHEN id % 3 = 0 AND id % 4 = 1 THEN 'tiktok require media' END AS problem FROM c)
        SELECT id, problem, CASE WHEN problem IS NULL THEN concat('{{"content":"', CASE WHEN id % 5 = 0 THEN ' ' ELSE concat('shot ', id) END, '","platforms":[', CASE id % 4 WHEN 0 THEN concat('{{"platform":"instagram","accountId":"a', id, '","platformSpecificData":{{"contentType":"reels","shareToFeed":true', CASE WHEN id % 7 = 0 THEN ',"thumbOffset":1500000' ELSE '' END, '}}}}')
        WHEN 1 THEN '{{"platform":"youtube","accountId":"y"}},{{"platform":"tiktok","accountId":"t"}}' ELSE '{{"platform":"youtube","accountId":"y"}}' END, '],"publishNow":true', CASE WHEN id % 2 = 0 THEN ',"profileId":"p"' ELSE '' END, CASE WHEN id % 3 <> 0 THEN concat(',"mediaItems":[{{"url":"u/', id, '","type":"video"}}]') ELSE '' END, '}}') END AS body FROM p""",
    "f33_deliveries": f"WITH {_STATES} SELECT event_id, x.p AS platform, x.s AS state FROM r",
    "f34_published": f"""WITH {_STATES}, g AS (SELECT event_id, string_agg(concat(x.p, '=', x.s), ';' ORDER BY x.p) AS states, string_agg(concat(x.p, '=', CASE WHEN x.p = 'tiktok' THEN '' ELSE 'a2' END), ';' ORDER BY x.p) FILTER (WHERE x.p <> '?') AS accounts, max(CASE WHEN x.s LIKE 'failed%' OR x.s LIKE 'error%' THEN 1 ELSE 0 END) AS failed FROM r GROUP BY event_id)
        SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN CAST(event_id AS VARCHAR) END AS post_id, CASE WHEN event_id % 4 <> 0 THEN accounts END AS accounts, CASE WHEN event_id % 4 <> 0 THEN states END AS states, CASE WHEN event_id % 4 <> 0 THEN failed END AS failed FROM g""",
    "f38_known_facts": f"""WITH c AS {_SRC} SELECT id, concat_ws(chr(10), 'country: ' || nullif(country, ''), 'site noted in the archive: ' || nullif(site, ''), 'captured: ' || nullif(captured_at, ''), CASE WHEN gps_lat IS NOT NULL AND gps_lon IS NOT NULL THEN printf('GPS: %.4f, %.4f', floor(gps_lat), floor(gps_lon)) END, printf('shot length: %.1fs', coalesce(floor(duration), 0e0))) AS facts FROM c""",
    "p09_reasons": f"WITH c AS {_SHOT} SELECT id, CASE WHEN motion_class = 'reposition' THEN '{SEARCHING}' ELSE 'outside a steady 3s window' END AS reason FROM c WHERE motion_class = 'reposition' OR is_window = 0",
    "a11_purge_totals": f"WITH {_OPEN} SELECT count(*) AS files, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS bytes FROM g",
    "a12_run_counts": f"{scenes.SPLIT_SQL} SELECT {scenes.CLASS_SQL}, is_window, pieces, seconds FROM (SELECT code, is_window, count(*) AS pieces, floor(sum(b - a) * 1e3 + 0.5) / 1e3 AS seconds FROM al GROUP BY code, is_window) AS g",
    "a16_segment_counts": f"""WITH c AS {_SHOT}, s AS {_SRC}, g AS (SELECT source_id, count(*) AS n, count(*) FILTER (WHERE motion_class = 'reposition') AS r FROM c GROUP BY source_id)
        SELECT count(*) AS sources, CAST(sum(n) AS BIGINT) AS shots, CAST(sum(r) AS BIGINT) AS reposition, CAST(sum(n - r) AS BIGINT) AS usable, count(*) FILTER (WHERE n = 1) AS continuous, (SELECT count(*) FROM s WHERE coalesce(duration, 0) = 0) AS without_length FROM g""",
    "q12_exports": f"WITH c AS {_SHOT}, s AS {_SRC} SELECT c.id, s.country, s.captured_at FROM c JOIN s ON s.id = c.source_id WHERE rejected = 0 AND tagged_at IS NOT NULL AND license_tier = 'exclusive'",
    "q13_purgeable": f"WITH {_OPEN} SELECT id, relpath FROM g",
    "q21_stamped": f"WITH c AS {_SHOT}, s AS {_SRC} SELECT id, CASE WHEN coalesce(duration, 0) = 0 THEN NULL WHEN id IN (SELECT source_id FROM c) THEN coalesce(scene_detected_at, '2026-01-01 00:00:00') ELSE scene_detected_at END AS scene_detected_at FROM s",
    "s05_dense_times": f"WITH c AS {_SRC}, n AS (SELECT id, CASE WHEN duration > 0 THEN CAST(least(ceil(duration * 4), 600) AS INTEGER) ELSE 0 END AS frames FROM c) SELECT id, frames, CASE WHEN frames > 0 THEN (frames - 1) / 4e0 END AS last_time FROM n",
    "q20_flagged": _SCORED + f""", w AS (SELECT j.id, CASE WHEN low THEN printf('technical below floor (%.2f < 0.15)', floor(k.t * 1e2 + 0.5) / 1e2) ELSE printf('bottom 35%% (< %.3f)', floor(threshold * 1e3 + 0.5) / 1e3) END AS reason FROM j JOIN k ON k.id = j.id CROSS JOIN q WHERE low OR j.combined < threshold - 1e-9)
        SELECT c.id, CASE WHEN j.id IS NULL THEN c.rejected WHEN w.id IS NULL THEN 0 ELSE 1 END AS rejected, w.reason FROM c LEFT JOIN j ON j.id = c.id LEFT JOIN w ON w.id = c.id""",
    "q23_ids_by_path": f"WITH c AS {_SRC} SELECT path, id FROM c",
    "a02_latest_stamp": f"WITH c AS {_SHOT} SELECT license_tier, max(tagged_at) AS latest FROM c GROUP BY license_tier",
    "f35_stamps": f"WITH c AS {_SHOT}, t AS (SELECT id, CASE WHEN regexp_matches(scored_at, '^\\d{{4}}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d$') THEN try_strptime(scored_at, '%Y-%m-%d %H:%M:%S') END AS t FROM c) SELECT id, CAST(epoch(t) AS BIGINT) AS seconds, strftime(t + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS next_day FROM t",
    "j04_zipped": scenes.SQL["w07_segment"].replace("SELECT scene, run, cls, run_start, run_end FROM", "SELECT scene, scene * 1000 + run AS id, cls, run_start FROM"),
    "j06_platforms": f"WITH c AS {_SRC} SELECT id, CASE id % 4 WHEN 0 THEN 'tiktok=b;instagram=a' WHEN 2 THEN '' ELSE 'instagram=a;tiktok=b;youtube=c' END AS accounts FROM c",
    "u_tag_sets": f"""WITH c AS {_SHOT}, l AS (SELECT id, list_filter(list_distinct({_LIST.format(c="subject_tags")}), lambda x: x IS NOT NULL) AS a, list_filter(list_distinct({_LIST.format(c="mood_tags")}), lambda x: x IS NOT NULL) AS b FROM c)
        SELECT id, array_to_string(list_sort(list_distinct(list_concat(a, b))), '|') AS either, array_to_string(list_sort(list_filter(a, lambda x: list_contains(b, x))), '|') AS both,
        array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), '|') AS only_subject, CASE WHEN len(list_filter(b, lambda x: NOT list_contains(a, x))) = 0 THEN 1 ELSE 0 END AS mood_within FROM l""",
    "w21_summaries": scenes.SQL["w11_reversals"].replace(", CASE WHEN head < 1e-2 THEN 1 ELSE 0 END AS eases", ""),
}
