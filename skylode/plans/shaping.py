"""Scalar functions, scores, joins and snapshot algebra over the catalogue's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylode.functions import scoring
from skylode.functions import text as tx
from skylode.operators import sequences as seq
from skylode.operators.joins import join_to_one
from skylode.operators.order import positions
from skylode.operators.versions import current_rows
from skylode.sources import files, store
from skylode.sources.tables import read_table

_CURRENT = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY loaded_at DESC) AS rn FROM {table}) AS v WHERE rn = 1)"
_SRC = _CURRENT.format(table="sources", key="id")
_SHOT = _CURRENT.format(table="shots", key="id")
_SCORE = _CURRENT.format(table="scores", key="shot_id")


def _sources(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return current_rows(read_table(spark, folder, "sources"), "id", "loaded_at", *columns)


def _shots(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return current_rows(read_table(spark, folder, "shots"), "id", "loaded_at", *columns)


def _with_source(spark: SparkSession, folder: str, shots: DataFrame, *columns: str) -> DataFrame:
    """``shots`` (with source_id) joined to ``columns`` of their sources, whose id is sid; one source may hold most shots."""
    s = _sources(spark, folder, *columns).withColumnRenamed("id", "sid")
    return join_to_one(shots, s, "source_id", "sid", sizes=read_table(spark, folder, "shots", "source_id"))


def _within(name: str, low: float, high: float):
    return F.when(F.col(name).between(low, high), F.col(name))


# --- scalar functions


def f01_frame_rate(spark: SparkSession, folder: str) -> DataFrame:
    rate = F.concat(F.floor(F.col("fps") * 1000 + 0.5).cast("string"), F.lit("/1000"))
    text = F.when(F.col("id") % 5 == 0, "0/0").when(F.col("id") % 5 == 1, "").when(F.col("id") % 5 == 2, "x/2").otherwise(rate)
    return _sources(spark, folder, "fps").select("id", tx.frame_rate(text).alias("fps"))


def f02_rotation(spark: SparkSession, folder: str) -> DataFrame:
    s = _sources(spark, folder, "width", "height")
    side = F.when(F.col("id") % 3 == 0, -90 * (F.col("id") % 7)).cast("int")
    tag = F.when(F.col("id") % 3 == 1, 450).cast("int")
    return s.select("id", tx.rotation(side, tag).alias("degrees"))


def f03_aspect(spark: SparkSession, folder: str) -> DataFrame:
    return _sources(spark, folder, "width", "height").select("id", tx.aspect_label(F.col("width"), F.col("height")).alias("aspect"))


def f04_positions(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("id")
    text = F.when(i % 4 == 0, "n/a").otherwise(F.concat(F.lit("+"), (i % 90).cast("string"), F.lit(".5-"), (i % 180).cast("string"), F.lit(".25+12.1/")))
    lat, lon = tx.latitude_longitude(text)
    return _sources(spark, folder, "width").select("id", lat.alias("lat"), lon.alias("lon"))


def f06_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Country, year, slugs and target path of each source."""
    s = _sources(spark, folder, "relpath", "captured_at", "site", "country", "drone_model")
    path = tx.shot_path("out", F.col("id"), F.col("relpath"), F.col("country"), F.col("captured_at"), F.col("site"), ".mp4")
    return s.select("id", tx.country_of(F.col("relpath")).alias("folder_country"), tx.year_of(F.col("captured_at")).alias("year"), tx.slug(F.col("site"), "none").alias("site_slug"), path.alias("path"), tx.joined(F.lit("Maker"), F.col("drone_model")).alias("model"))


def f12_titles(spark: SparkSession, folder: str) -> DataFrame:
    """A title for each document: its first clause, else the place of its shot."""
    d = join_to_one(read_table(spark, folder, "documents", "doc_id", "text", "shot_id"), read_table(spark, folder, "shot_details", "id", "country", "site"), "shot_id", "id", how="left", sizes=read_table(spark, folder, "documents", "shot_id"))
    return d.select("doc_id", tx.title(F.col("text"), F.col("site"), F.col("country")).alias("title"))


def f13_keywords(spark: SparkSession, folder: str) -> DataFrame:
    """Keywords of each shot, with the tags of JSON and of comma-separated lists."""
    shots = _shots(spark, folder, "source_id", "subject_tags", "mood_tags")
    j = _with_source(spark, folder, shots, "country", "site", "drone_model", "width")
    words = tx.keywords(*[tx.tag_elements(F.col(c)) for c in ("subject_tags", "mood_tags")], F.col("country"), F.col("site"), F.col("drone_model"), F.col("width"))
    return j.select("id", F.array_join(words, "; ").alias("keywords"))


def f20_crops(spark: SparkSession, folder: str) -> DataFrame:
    w, h = tx.crop_size(F.col("width"), F.col("height"))
    return _sources(spark, folder, "width", "height").select("id", w.alias("crop_w"), h.alias("crop_h"))


def f39_outside_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """Tags of either kind that its vocabulary lacks, with their number of shots, of JSON and of comma-separated lists.

    White space around the elements of a comma-separated list isn't part of the tag, and blank ones are none.
    """
    def foreign(column: str, vocabulary: list[str]):
        text = F.col(column)
        listed = F.filter(F.transform(tx.tag_elements(text), tx.strip), lambda x: x != "")
        tags = F.array_compact(F.array_distinct(F.when(text.startswith("["), tx.tag_elements(text)).otherwise(listed)))
        return F.transform(tx.outside(tags, vocabulary), lambda x: F.struct(F.lit(column).alias("list"), x.alias("tag")))

    nothing = F.array().cast("array<struct<list: string, tag: string>>")
    both = F.concat(*[F.coalesce(foreign(c, v), nothing) for c, v in (("subject_tags", tx.SUBJECTS), ("mood_tags", tx.MOODS))])
    found = _shots(spark, folder, "subject_tags", "mood_tags").select(F.explode(both).alias("t"))
    return found.groupBy(F.col("t.list").alias("list"), F.col("t.tag").alias("tag")).agg(F.count(F.lit(1)).alias("n"))


def f33_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    """A user's last value of each type of event: the greatest by time, reduced before the shuffle."""
    e = read_table(spark, folder, "events", "user_id", "event_id", "ts", "event_type")
    return e.groupBy("user_id", "event_type").agg(F.max(F.struct("ts", "event_id")).alias("m")).select("user_id", "event_type", "m.event_id")


def s03_probe(spark: SparkSession, folder: str) -> DataFrame:
    """Fields read back from probe documents made of the sources' columns.

    By turns the tags are a vendor's beside general ones, general ones only, and none but those of the video stream,
    of which only the time of creation counts.
    """
    s = _sources(spark, folder, "width", "height", "codec", "drone_model", "bitrate", "captured_at")
    turned = F.when(F.col("id") % 2 == 0, F.array(F.struct(F.lit(-90).alias("rotation"))))
    streamed = F.struct(F.lit("+5.0+5.0/").alias("location"), F.lit("Lens").alias("model"), F.lit("2020-02-02T00:00:00Z").alias("Creation_Time"))
    video = F.to_json(F.struct(F.lit("video").alias("codec_type"), F.col("codec").alias("codec_name"), "width", "height", F.lit("30000/1001").alias("r_frame_rate"), streamed.alias("tags"), turned.alias("side_data_list")))
    audio = F.lit('{"codec_type":"audio","codec_name":"aac","width":0,"height":0,"r_frame_rate":"0/0","tags":{"model":"Microphone"}}')
    general = F.struct(F.lit("+30.5+040.25/").alias("Location"), F.col("drone_model").alias("Model"), F.lit("").alias("make"))
    vendor = F.struct(F.lit("+10.5-020.25/").alias("com.apple.quicktime.location.ISO6709"), F.lit("Maker").alias("com.apple.quicktime.make"), F.col("drone_model").alias("com.apple.quicktime.model"), F.lit("+1.0+1.0/").alias("location"), F.lit("Other").alias("make"), F.col("captured_at").alias("creation_time"))
    tags = F.when(F.col("id") % 3 == 0, F.to_json(vendor)).when(F.col("id") % 3 == 1, F.to_json(general)).otherwise("{}")
    whole = F.concat(F.lit('{"format":{"duration":"12.5","bit_rate":"'), F.col("bitrate").cast("string"), F.lit('","tags":'), tags, F.lit('},"streams":['), audio, F.lit(","), video, F.lit("]}"))
    p = files.probe_fields(F.col("doc"))
    return s.select("id", whole.alias("doc")).select("id", *[p[c].alias(c) for c in ("duration", "width", "height", "fps", "codec", "bitrate", "captured_at", "gps_lat", "gps_lon", "drone_model")])


def _catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Shots joined to their sources, with all columns that exports need."""
    shots = _shots(spark, folder, "source_id", "in_point", "out_point", "license_tier", "person_in_frame", "inferred_site", "subject_tags", "mood_tags", "technical_score", "aesthetic_score")
    j = _with_source(spark, folder, shots, "relpath", "country", "site", "captured_at", "width", "drone_model", "height", "fps", "aspect", "gps_lat", "gps_lon")
    return j.withColumn("place", F.coalesce("inferred_site", "site"))


def _duration():
    return scoring.rounded(F.col("out_point") - F.col("in_point"), 3)


def _title():
    """From the place, as no column of the shots holds a description."""
    return tx.title(F.lit(None).cast("string"), F.col("place"), F.col("country"))


def _terms():
    return tx.keywords(tx.tag_elements(F.col("subject_tags")), tx.tag_elements(F.col("mood_tags")), F.col("country"), F.col("place"), F.col("drone_model"), F.col("width"))


def _blank(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def s13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the catalogue as a manifest has them, all 18 fields in order: empty text for what is missing.

    No column of the shots holds a description or a rendered file, so that field is empty and the suffix .mp4.
    """
    counted = lambda c: F.coalesce(F.nullif(F.col(c), F.lit(0)).cast("string"), F.lit(""))
    file = F.substring(tx.shot_path(".", F.col("id"), F.col("relpath"), F.col("country"), F.col("captured_at"), F.col("place"), ".mp4"), 3, 1 << 30)
    return _catalogue(spark, folder).select(
        F.col("id").alias("shot_id"), file.alias("file"), _title().alias("title"), F.lit("").alias("description"), F.array_join(_terms(), "; ").alias("keywords"),
        _blank("country").alias("country"), _blank("place").alias("site"), _blank("captured_at").alias("captured_at"), _blank("gps_lat").alias("gps_lat"), _blank("gps_lon").alias("gps_lon"),
        _blank("drone_model").alias("drone_model"), counted("width").alias("width"), counted("height").alias("height"), counted("fps").alias("fps"), _duration().alias("duration_seconds"),
        _blank("license_tier").alias("license_tier"), _blank("aesthetic_score").alias("aesthetic_score"), _blank("technical_score").alias("technical_score"),
    )


def s14_side_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A nested JSON document for each shot; its description is NULL, as no column of the shots holds one."""
    doc = files.side_document({
        "shot_id": F.col("id"),
        "title": _title(),
        "description": F.lit(None).cast("string"),
        "keywords": _terms(),
        "location": {"country": F.col("country"), "site": F.col("place"), "latitude": F.col("gps_lat"), "longitude": F.col("gps_lon")},
        "capture": {"captured_at": F.col("captured_at"), "drone_model": F.col("drone_model")},
        "technical": {"width": F.col("width"), "height": F.col("height"), "fps": F.col("fps"), "duration_seconds": _duration(), "aspect": F.col("aspect")},
        "editorial": {"person_in_frame": F.coalesce(F.col("person_in_frame") != 0, F.lit(False)), "license_tier": F.col("license_tier"), "aesthetic_score": F.col("aesthetic_score"), "technical_score": F.col("technical_score")},
        "provenance": {"source_file": F.col("relpath"), "in_point": F.col("in_point"), "out_point": F.col("out_point")},
    })
    return _catalogue(spark, folder).select("id", doc.alias("document"))


# --- scores and counts


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    shots = _shots(spark, folder, "scored_at", "motion_class", "is_window", "technical_score", "aesthetic_score")
    raw = current_rows(read_table(spark, folder, "scores"), "shot_id", "loaded_at", "motion", "stability")
    j = shots.join(raw, shots.id == raw.shot_id, "left")
    parts = {"aesthetic_score": _within("aesthetic_score", 0, 1), "technical_score": _within("technical_score", 0, 1), "stability_score": _within("stability", 0, 100) / 100.0, "motion_score": F.when((F.col("motion") >= 0) & (F.col("motion") < 1e300), F.tanh(F.col("motion") / 40.0))}
    return j.select("id", "scored_at", "motion_class", "is_window", *[c.alias(n) for n, c in parts.items()])


def _rating():
    return scoring.combine({n: F.col(n) for n in scoring.WEIGHTS})


def a07_combined(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select("id", _rating().alias("combined"))


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    """Shots that are judged: scored, not searching moves, and inside their window."""
    judged = _scored(spark, folder).where("scored_at IS NOT NULL AND (motion_class IS NULL OR motion_class <> 'reposition') AND coalesce(is_window, 1) = 1")
    return judged.select("id", _rating().alias("combined"), scoring.fails_floor({"technical_score": F.col("technical_score")}, {"technical_score": 0.15}).alias("floor"))


def _threshold(judged: DataFrame, share: float) -> DataFrame:
    """One row: the interpolated percentile of ratings above the floors. Ratings have 4 digits, so few values."""
    counts = judged.where("floor IS NULL AND combined IS NOT NULL").groupBy("combined").agg(F.count(F.lit(1)).alias("c"))
    return counts.agg(F.percentile("combined", F.lit(share), F.col("c")).alias("threshold"))


def a17_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Judged shots below a floor or in the lowest 35 %, with the reason."""
    j = _judged(spark, folder)
    low = F.col("combined") < F.col("threshold") - 1e-9
    reason = F.coalesce(F.col("floor"), F.when(low, tx.percent_text(F.lit(0.35), F.col("threshold"))))
    return j.crossJoin(_threshold(j, 0.35)).select("id", reason.alias("reason")).where("reason IS NOT NULL")


def a18_summary(spark: SparkSession, folder: str) -> DataFrame:
    """What ``a17_rejected`` does in one row: shots considered, rejected, below a floor, below the threshold."""
    j = _judged(spark, folder)
    low = F.col("floor").isNull() & (F.col("combined") < F.col("threshold") - 1e-9)
    return j.crossJoin(_threshold(j, 0.35)).agg(F.count(F.lit(1)).alias("considered"), F.count("floor").alias("floor_failures"), F.count_if(low).alias("below"), (F.count("floor") + F.count_if(low)).alias("rejected"), scoring.rounded(F.max("threshold"), 4).alias("threshold"))


def a10_brightness(spark: SparkSession, folder: str) -> DataFrame:
    """How bright the backdrop of each user's pixels is; pixels are counted by value, of which there are 256."""
    e = read_table(spark, folder, "events", "user_id", "value").select("user_id", (F.floor(F.col("value") * 2) % 256).cast("int").alias("v"))
    counts = e.groupBy("user_id", "v").agg(F.count(F.lit(1)).alias("n")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("v", "n"))).alias("counts"))
    return counts.select("user_id", scoring.rounded(scoring.brightness_of_counts(F.col("counts")), 6).alias("luma"))


def a14_linear_head(spark: SparkSession, folder: str) -> DataFrame:
    """Mean score of each shot's frames by a linear head on unit vectors."""
    weights = [((i * 37) % 11 - 5) / 10 for i in range(64)]
    v = read_table(spark, folder, "embeddings", "vec_id", "embedding")
    scored = v.select(F.floor(F.col("vec_id") / 5).alias("shot"), scoring.linear_head(F.col("embedding"), weights, 0.5).alias("x"))
    return scored.groupBy("shot").agg(scoring.rounded(scoring.clamp(F.avg("x")), 4).alias("score"))


def q18_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the catalogue, each table read once; the tables hold no rendered, scheduled or posted shots to count."""
    s = _shots(spark, folder, "scored_at", "tagged_at", "rejected", "motion_class", "selection_state")
    classes = [F.count_if(F.col("motion_class") == c).alias(n) for n, c in (("held", "held"), ("moving", "move"), ("repositioning", "reposition"))]
    states = [F.count("scored_at").alias("scored"), F.count_if(F.col("rejected") == 1).alias("rejected"), F.count("tagged_at").alias("tagged"), F.count_if(F.col("selection_state") == "approved").alias("approved")]
    s = s.agg(F.count(F.lit(1)).alias("shots"), *classes, *states)
    c = _sources(spark, folder, "size_bytes", "scene_detected_at").agg(F.count(F.lit(1)).alias("sources"), F.count_if(F.col("scene_detected_at").isNull()).alias("sources_unsegmented"), F.sum("size_bytes").alias("bytes"))
    return s.crossJoin(c).withColumn("survival", scoring.rounded((F.col("scored") - F.col("rejected")) / F.nullif(F.col("scored"), F.lit(0)), 4))


def q01_unsegmented(spark: SparkSession, folder: str) -> DataFrame:
    return _sources(spark, folder, "relpath", "scene_detected_at").where("scene_detected_at IS NULL").select("id", "relpath").orderBy("relpath", "id")


def _first(rows: DataFrame, most: int) -> DataFrame:
    """The first ``most`` rows; 0 sets no limit."""
    return rows.limit(most) if most else rows


def q02_unscored(spark: SparkSession, folder: str, most: int = 0) -> DataFrame:
    return _first(_shots(spark, folder, "scored_at").where("scored_at IS NULL").select("id").orderBy("id"), most)


def q03_untagged(spark: SparkSession, folder: str, most: int = 0) -> DataFrame:
    s = _shots(spark, folder, "rejected", "scored_at", "tagged_at", "aesthetic_score").where("rejected = 0 AND scored_at IS NOT NULL AND tagged_at IS NULL")
    return _first(s.select("id", "aesthetic_score").orderBy(F.col("aesthetic_score").desc_nulls_last(), "id"), most)


def o02_top(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 shots with the greatest valid technical score."""
    return _shots(spark, folder, "technical_score").where(F.col("technical_score").between(0, 1)).orderBy(F.col("technical_score").desc(), "id").limit(50)


def o04_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """Place of each source in an order that a seed decides, sorted by range over all tasks."""
    key = F.md5(F.concat(F.lit("seed:"), F.col("id").cast("string")))
    return positions(_sources(spark, folder, "width").select("id", key.alias("k")), [F.col("k"), F.col("id")], "place").select("id", "place")


def w17_numbered(spark: SparkSession, folder: str) -> DataFrame:
    s = _shots(spark, folder, "source_id", "in_point").select("id", "source_id", F.struct("in_point", "id").alias("o"))
    return store.number_segments(s, "source_id", "o").select("id", F.col("shot_index").cast("bigint").alias("shot_index"), "continuous_move")


def w20_sample_times(spark: SparkSession, folder: str) -> DataFrame:
    s = _shots(spark, folder, "in_point", "out_point")
    return s.select("id", F.posexplode(seq.sample_times(F.col("in_point"), F.col("out_point"), 0.25, 6)).alias("i", "t"))


# --- joins


def j01_shot_details(spark: SparkSession, folder: str) -> DataFrame:
    """Shots joined to their sources, the inferred site before the folder's."""
    shots = _shots(spark, folder, "source_id", "inferred_site")
    return _with_source(spark, folder, shots, "relpath", "country", "site", "aspect").select("id", "source_id", F.col("relpath").alias("source_relpath"), "country", F.coalesce("inferred_site", "site").alias("site"), F.col("aspect").alias("source_aspect"))


def j02_without_shots(spark: SparkSession, folder: str) -> DataFrame:
    """Sources without a shot that is kept."""
    kept = _shots(spark, folder, "source_id", "rejected").where("rejected = 0").select("source_id")
    return _sources(spark, folder, "width").join(kept, F.col("id") == F.col("source_id"), "left_anti").select("id")


def j08_without_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Shots whose source is at least Full HD wide."""
    return store.without_orphans(_shots(spark, folder, "source_id"), _sources(spark, folder, "width").where("width >= 1920"), "source_id", "id").select("id", "source_id")


# --- snapshots


def _first_and_later(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The oldest version of every source, and the current version of those that have a newer one."""
    columns = ("captured_at", "gps_lat", "gps_lon")
    version = F.struct(F.col("loaded_at").alias("v"), *columns, "width")
    g = read_table(spark, folder, "sources", "id", "loaded_at", *columns, "width").groupBy("id").agg(F.min(version).alias("a"), F.max(version).alias("z"))
    changed = [(~F.col(f"a.{c}").eqNullSafe(F.col(f"z.{c}"))).alias(f"has_{c}") for c in columns]
    return g.select("id", "a.*").drop("v"), g.where("z.v > a.v").select("id", *[F.col(f"z.{c}") for c in columns], *changed)


def s08_conformed(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of an old schema in a newer one."""
    old = _sources(spark, folder, "country").select("country", F.col("id").cast("int").alias("id"))
    newer = T.StructType([T.StructField("id", T.LongType()), T.StructField("country", T.StringType()), T.StructField("purged_at", T.StringType())])
    return store.conform(old, newer)


def s09_upserted(spark: SparkSession, folder: str) -> DataFrame:
    """Oldest versions of all sources with their current ones written over them."""
    base, changes = _first_and_later(spark, folder)
    return store.upsert(base, changes.select("id", "captured_at", "gps_lat", "gps_lon"), "id")


def s10_replaced(spark: SparkSession, folder: str) -> DataFrame:
    base = _shots(spark, folder, "source_id", "shot_index", "in_point", "motion_class").select("source_id", "shot_index", "in_point", "motion_class")
    fresh = base.where("source_id % 10 = 0").groupBy("source_id").agg(F.min("in_point").alias("in_point"))
    return store.replace_children(base, fresh, "source_id", "in_point").select("source_id", F.col("shot_index").cast("bigint").alias("shot_index"), "in_point", "motion_class", "continuous_move")


def s11_patched(spark: SparkSession, folder: str) -> DataFrame:
    """Oldest versions of all sources with the columns replaced in which the current ones differ."""
    base, changes = _first_and_later(spark, folder)
    return store.patch(base, changes, "id", {c: f"has_{c}" for c in ("captured_at", "gps_lat", "gps_lon")})


def s25_ingest_plan(spark: SparkSession, folder: str) -> DataFrame:
    """What an ingest would do with each file of a scan.

    The scan finds every file; known are the files without a purge, those whose scenes were never looked for with a byte less.
    """
    s = _sources(spark, folder, "path", "size_bytes", "mtime", "duration", "scene_detected_at", "purged_at")
    known = s.where("purged_at IS NULL").withColumn("size_bytes", F.col("size_bytes") - F.col("scene_detected_at").isNull().cast("int"))
    return store.ingest_plan(s.select("path", "size_bytes", "mtime"), known)


def s_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that break the tables' rules, and which."""
    s = _shots(spark, folder, "in_point", "out_point", "technical_score", "motion_class", "license_tier")
    return store.violations(s, {
        "ends after it starts": F.col("out_point") > F.col("in_point"),
        "score in range": F.col("technical_score").between(0, 1),
        "known class": F.col("motion_class").isin("held", "move", "reposition"),
        "known tier": F.col("license_tier").isin("public", "non-exclusive", "exclusive"),
    }, "id")


def s_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """Ids delivered more than once."""
    return store.repeated(read_table(spark, folder, "sources", "id"), "id")


QUERIES = {
    f.__name__: f
    for f in (f01_frame_rate, f02_rotation, f03_aspect, f04_positions, f06_paths, f12_titles, f13_keywords, f20_crops, f33_last_wins, f39_outside_vocabulary, s03_probe, s08_conformed, s09_upserted, s10_replaced, s11_patched, s13_manifest, s14_side_documents, s25_ingest_plan, s_violations, s_repeated, a07_combined, a10_brightness, a14_linear_head, a17_rejected, a18_summary, q01_unsegmented, q02_unscored, q03_untagged, q18_stats, o02_top, o04_shuffled, w17_numbered, w20_sample_times, j01_shot_details, j02_without_shots, j08_without_orphans)
}

_SLUG = "regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce({x}, ''), '^\\s+|\\s+$', '', 'g'), '[<>:\"/\\\\|?*]', '', 'g'), '^[. ]+|[. ]+$', '', 'g'), '\\s+', '-', 'g'), '^-+|-+$', '', 'g')), '^$', '{d}')"
_STEM = "regexp_replace(regexp_replace(relpath, '^.*/', ''), '\\.[^.]*$', '')"
_YEAR = "CASE WHEN regexp_matches(substr(captured_at, 1, 4), '^[0-9]+$') THEN substr(captured_at, 1, 4) ELSE 'undated' END"
_SCORED = f"""
    WITH c AS {_SHOT}, m AS {_SCORE},
    p AS (SELECT c.id, scored_at, motion_class, is_window, CASE WHEN aesthetic_score BETWEEN 0 AND 1 AND NOT isnan(aesthetic_score) THEN aesthetic_score END AS a,
          CASE WHEN technical_score BETWEEN 0 AND 1 AND NOT isnan(technical_score) THEN technical_score END AS t,
          CASE WHEN stability BETWEEN 0 AND 100 AND NOT isnan(stability) THEN stability / 100e0 END AS s,
          CASE WHEN motion >= 0 AND motion < 1e300 AND NOT isnan(motion) THEN tanh(motion / 40e0) END AS v
          FROM c LEFT JOIN m ON m.shot_id = c.id),
    k AS (SELECT *, floor((coalesce(a * 4e-1, 0e0) + coalesce(s * 3e-1, 0e0) + coalesce(t * 2e-1, 0e0) + coalesce(v * 1e-1, 0e0))
          / nullif(CASE WHEN a IS NULL THEN 0e0 ELSE 4e-1 END + CASE WHEN s IS NULL THEN 0e0 ELSE 3e-1 END + CASE WHEN t IS NULL THEN 0e0 ELSE 2e-1 END + CASE WHEN v IS NULL THEN 0e0 ELSE 1e-1 END, 0e0) * 1e4 + 0.5) / 1e4 AS combined FROM p),
    j AS (SELECT id, combined, t < 15e-2 AS low FROM k WHERE scored_at IS NOT NULL AND (motion_class IS NULL OR motion_class <> 'reposition') AND coalesce(is_window, 1) = 1),
    q AS (SELECT quantile_cont(combined, 0.35) AS threshold FROM j WHERE NOT coalesce(low, false) AND combined IS NOT NULL)
"""
_ENDS = """
    o AS (SELECT id, captured_at, gps_lat, gps_lon, width, loaded_at FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at) AS rn FROM sources) AS v WHERE rn = 1),
    z AS (SELECT id, captured_at, gps_lat, gps_lon, loaded_at FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) AS rn FROM sources) AS v WHERE rn = 1)
"""
_HEAD = "[" + ", ".join(f"{((i * 37) % 11 - 5)}" for i in range(64)) + "]"
_LIST = "CASE WHEN {c} LIKE '[%' THEN CASE WHEN json_valid({c}) AND json_type({c}) = 'ARRAY' THEN from_json({c}, '[\"VARCHAR\"]') ELSE CAST([] AS VARCHAR[]) END ELSE coalesce(string_split({c}, ','), CAST([] AS VARCHAR[])) END"
_TERMS = f"""list_concat(list_concat(list_concat({_LIST.format(c="subject_tags")}, {_LIST.format(c="mood_tags")}), [s.country, {{place}}]), list_concat(CASE WHEN coalesce(s.drone_model, '') <> '' THEN ['aerial', 'drone'] ELSE CAST([] AS VARCHAR[]) END, CASE WHEN s.width >= 3840 THEN ['4k'] ELSE CAST([] AS VARCHAR[]) END))"""
_TRIMMED = "nullif(lower(regexp_replace(replace(x, '-', ' '), '^[ \t\r\n\f\v]+|[ \t\r\n\f\v]+$', '', 'g')), '')"
_WORDS = f"list_filter(list_transform(raw, lambda x: {_TRIMMED}), lambda x: x IS NOT NULL)"
_CASED = "list_reduce(list_transform(regexp_extract_all({x}, '\\p{{L}}+|\\P{{L}}+'), lambda w: concat(upper(w[1:1]), lower(w[2:]))), lambda a, b: concat(a, b))"
_TEXT = "coalesce(CASE WHEN isnan({x}) THEN 'NaN' ELSE CAST({x} AS VARCHAR) END, '')"
_PLACED = f"""WITH c AS {_SHOT}, s AS {_SRC},
    j AS (SELECT c.id, c.in_point, c.out_point, c.license_tier, c.person_in_frame, c.technical_score, c.aesthetic_score, coalesce(c.inferred_site, s.site) AS place, s.country, s.captured_at, s.gps_lat, s.gps_lon, s.drone_model, s.width, s.height, s.fps, s.aspect, s.relpath,
          floor((c.out_point - c.in_point) * 1e3 + 0.5) / 1e3 AS seconds, {_TERMS.format(place="coalesce(c.inferred_site, s.site)")} AS raw FROM c JOIN s ON s.id = c.source_id),
    k AS (SELECT *, {_WORDS} AS l, coalesce(nullif(concat_ws(' · ', nullif(place, ''), nullif(country, '')), ''), 'Aerial footage') AS spot FROM j),
    d AS (SELECT *, list_filter(l, lambda x, i: list_position(l, x) = i) AS words, {_CASED.format(x="spot")} AS title FROM k)"""
SQL = {
    "f01_frame_rate": f"WITH c AS {_SRC} SELECT id, CASE WHEN id % 5 > 2 THEN floor(fps * 1000 + 0.5) / 1000 END AS fps FROM c",
    "f02_rotation": f"WITH c AS {_SRC} SELECT id, CASE WHEN id % 3 = 0 THEN ((-90 * (id % 7)) % 360 + 360) % 360 WHEN id % 3 = 1 THEN 90 ELSE 0 END AS degrees FROM c",
    "f03_aspect": f"""WITH c AS {_SRC}, d AS (SELECT DISTINCT width, height, CAST(width AS DOUBLE) / height AS r FROM c WHERE width <> 0 AND height <> 0),
        n AS (SELECT *, CASE WHEN abs(r - 16e0 / 9) <= 2e-2 * greatest(r, 16e0 / 9) THEN '16:9' WHEN abs(r - 9e0 / 16) <= 2e-2 * greatest(r, 9e0 / 16) THEN '9:16' WHEN abs(r - 4e0 / 3) <= 2e-2 * greatest(r, 4e0 / 3) THEN '4:3'
              WHEN abs(r - 1) <= 2e-2 * greatest(r, 1) THEN '1:1' WHEN abs(r - 21e0 / 9) <= 2e-2 * greatest(r, 21e0 / 9) THEN '21:9' END AS named FROM d),
        t AS (SELECT n.*, k, round_even(r * k, 0) AS top, row_number() OVER (PARTITION BY width, height ORDER BY abs(r - round_even(r * k, 0) / k), k) AS rn FROM n CROSS JOIN (SELECT unnest(range(1, 51)) AS k) AS u)
        SELECT c.id, coalesce(t.named, concat(CAST(CAST(t.top AS BIGINT) AS VARCHAR), ':', CAST(t.k AS VARCHAR))) AS aspect FROM c JOIN t ON t.width = c.width AND t.height = c.height AND t.rn = 1""",
    "f04_positions": f"WITH c AS {_SRC} SELECT id, CASE WHEN id % 4 <> 0 THEN id % 90 + 5e-1 END AS lat, CASE WHEN id % 4 <> 0 THEN -(id % 180 + 25e-2) END AS lon FROM c",
    "f06_paths": f"""WITH c AS {_SRC} SELECT id, CASE WHEN relpath LIKE '%/%' THEN lower(replace(split_part(relpath, '/', 1), '_', ' ')) END AS folder_country, {_YEAR} AS year, {_SLUG.format(x="site", d="none")} AS site_slug,
        concat('out/', {_SLUG.format(x="country", d="unknown-country")}, '/', {_YEAR}, '/', printf('%06d', id), '_', {_SLUG.format(x=_STEM, d="source")}, CASE WHEN coalesce(site, '') = '' THEN '' ELSE concat('_', {_SLUG.format(x="site", d="site")}) END, '.mp4') AS path,
        CASE WHEN coalesce(drone_model, '') = '' THEN 'Maker' ELSE concat('Maker ', drone_model) END AS model FROM c""",
    "f12_titles": f"""WITH d AS (SELECT doc_id, text, coalesce(nullif(concat_ws(' · ', nullif(site, ''), nullif(country, '')), ''), 'Aerial footage') AS spot FROM documents LEFT JOIN shot_details AS s ON s.id = shot_id)
        SELECT doc_id, coalesce(nullif(substr(regexp_replace(split_part(split_part(text, '.', 1), ',', 1), '^[\\s\\v]+|[\\s\\v]+$', '', 'g'), 1, 120), ''), {_CASED.format(x="spot")}) AS title FROM d""",
    "f13_keywords": f"""WITH c AS {_SHOT}, s AS {_SRC}, k AS (SELECT c.id, {_TERMS.format(place="s.site")} AS raw FROM c JOIN s ON s.id = c.source_id), t AS (SELECT id, {_WORDS} AS l FROM k)
        SELECT id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '; ') AS keywords FROM t""",
    "f20_crops": f"""WITH c AS {_SRC}, r AS (SELECT *, CAST(width AS DOUBLE) / height AS q FROM c),
        s AS (SELECT id, q, width > 0 AND height > 0 AND abs(q - 9e0 / 16) >= 1e-3 AS cut, CAST(round_even(height * 9e0 / 16, 0) AS BIGINT) AS a, CAST(round_even(width * 16e0 / 9, 0) AS BIGINT) AS b, width, height FROM r)
        SELECT id, CASE WHEN cut THEN CASE WHEN q > 9e0 / 16 THEN greatest(2, a - a % 2) ELSE greatest(2, width - width % 2) END END AS crop_w, CASE WHEN cut THEN CASE WHEN q > 9e0 / 16 THEN greatest(2, height - height % 2) ELSE greatest(2, b - b % 2) END END AS crop_h FROM s""",
    "f33_last_wins": "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) AS v WHERE rn = 1",
    "f39_outside_vocabulary": f"""WITH c AS {_SHOT}, l AS (SELECT id, 'subject_tags' AS list, subject_tags AS t, {_LIST.format(c="subject_tags")} AS a FROM c UNION ALL SELECT id, 'mood_tags', mood_tags, {_LIST.format(c="mood_tags")} FROM c),
        e AS (SELECT id, list, t, unnest(a) AS x FROM l), g AS (SELECT id, list, CASE WHEN t LIKE '[%' THEN x ELSE nullif(regexp_replace(x, '^[ \t\r\n\f\v]+|[ \t\r\n\f\v]+$', '', 'g'), '') END AS tag FROM e)
        SELECT list, tag, count(DISTINCT id) AS n FROM g WHERE tag IS NOT NULL AND NOT (list = 'subject_tags' AND tag IN ({", ".join(f"'{m}'" for m in tx.SUBJECTS)})) AND NOT (list = 'mood_tags' AND tag IN ({", ".join(f"'{m}'" for m in tx.MOODS)})) GROUP BY list, tag""",
    "s03_probe": f"""WITH c AS {_SRC} SELECT id, 125e-1 AS duration, CASE WHEN id % 2 = 0 THEN height ELSE width END AS width, CASE WHEN id % 2 = 0 THEN width ELSE height END AS height, 2997e-2 AS fps, codec, bitrate,
        CASE WHEN id % 3 = 0 THEN coalesce(nullif(captured_at, ''), '2020-02-02T00:00:00Z') ELSE '2020-02-02T00:00:00Z' END AS captured_at,
        CASE id % 3 WHEN 0 THEN 105e-1 WHEN 1 THEN 305e-1 END AS gps_lat, CASE id % 3 WHEN 0 THEN -2025e-2 WHEN 1 THEN 4025e-2 END AS gps_lon,
        CASE id % 3 WHEN 0 THEN CASE WHEN coalesce(drone_model, '') = '' THEN 'Maker' ELSE concat('Maker ', drone_model) END WHEN 1 THEN nullif(drone_model, '') END AS drone_model FROM c""",
    "s08_conformed": f"WITH c AS {_SRC} SELECT id, country, CAST(NULL AS VARCHAR) AS purged_at FROM c",
    "s09_upserted": f"WITH {_ENDS} SELECT o.id, z.captured_at, z.gps_lat, z.gps_lon, o.width FROM o JOIN z ON z.id = o.id",
    "s10_replaced": f"""WITH c AS {_SHOT}, f AS (SELECT source_id, min(in_point) AS in_point FROM c WHERE source_id % 10 = 0 GROUP BY source_id)
        SELECT source_id, shot_index, in_point, motion_class, CAST(NULL AS INTEGER) AS continuous_move FROM c WHERE source_id % 10 <> 0 UNION ALL SELECT source_id, 0, in_point, NULL, 1 FROM f""",
    "s11_patched": f"WITH {_ENDS} SELECT o.id, z.captured_at, z.gps_lat, z.gps_lon, o.width FROM o JOIN z ON z.id = o.id",
    "s13_manifest": f"""{_PLACED} SELECT id AS shot_id, concat({_SLUG.format(x="country", d="unknown-country")}, '/', {_YEAR}, '/', printf('%06d', id), '_', {_SLUG.format(x=_STEM, d="source")}, CASE WHEN coalesce(place, '') = '' THEN '' ELSE concat('_', {_SLUG.format(x="place", d="site")}) END, '.mp4') AS file,
        title, '' AS description, array_to_string(words, '; ') AS keywords, coalesce(country, '') AS country, coalesce(place, '') AS site, coalesce(captured_at, '') AS captured_at, {_TEXT.format(x="gps_lat")} AS gps_lat, {_TEXT.format(x="gps_lon")} AS gps_lon, coalesce(drone_model, '') AS drone_model,
        coalesce(CAST(nullif(width, 0) AS VARCHAR), '') AS width, coalesce(CAST(nullif(height, 0) AS VARCHAR), '') AS height, {_TEXT.format(x="nullif(fps, 0)")} AS fps, seconds AS duration_seconds, coalesce(license_tier, '') AS license_tier, {_TEXT.format(x="aesthetic_score")} AS aesthetic_score, {_TEXT.format(x="technical_score")} AS technical_score FROM d""",
    "s14_side_documents": f"""{_PLACED} SELECT id, replace(to_json({{'shot_id': id, 'title': title, 'description': CAST(NULL AS VARCHAR), 'keywords': words, 'location': {{'country': country, 'site': place, 'latitude': gps_lat, 'longitude': gps_lon}},
        'capture': {{'captured_at': captured_at, 'drone_model': drone_model}}, 'technical': {{'width': width, 'height': height, 'fps': fps, 'duration_seconds': seconds, 'aspect': aspect}},
        'editorial': {{'person_in_frame': coalesce(person_in_frame <> 0, false), 'license_tier': license_tier, 'aesthetic_score': aesthetic_score, 'technical_score': technical_score}},
        'provenance': {{'source_file': relpath, 'in_point': in_point, 'out_point': out_point}}}}), ':NaN', ':"NaN"') AS document FROM d""",
    "s25_ingest_plan": f"WITH c AS {_SRC} SELECT path, CASE WHEN purged_at IS NOT NULL THEN 'added' WHEN scene_detected_at IS NULL OR mtime IS NULL OR duration IS NULL OR size_bytes IS NULL THEN 'updated' ELSE 'skipped' END AS status FROM c",
    "s_violations": f"""WITH c AS {_SHOT} SELECT id, 'ends after it starts' AS rule FROM c WHERE NOT out_point > in_point UNION ALL SELECT id, 'score in range' FROM c WHERE technical_score IS NOT NULL AND (isnan(technical_score) OR NOT technical_score BETWEEN 0 AND 1)
        UNION ALL SELECT id, 'known class' FROM c WHERE motion_class NOT IN ('held', 'move', 'reposition') UNION ALL SELECT id, 'known tier' FROM c WHERE license_tier NOT IN ('public', 'non-exclusive', 'exclusive')""",
    "s_repeated": "SELECT id, count(*) AS n FROM sources GROUP BY id HAVING count(*) > 1",
    "a07_combined": _SCORED + "SELECT id, combined FROM k",
    "a10_brightness": "WITH l AS (SELECT user_id, CAST(floor(value * 2) AS BIGINT) % 256 AS v, row_number() OVER (PARTITION BY user_id ORDER BY CAST(floor(value * 2) AS BIGINT) % 256) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events) "
    "SELECT user_id, floor(v / 255e0 * 1e6 + 0.5) / 1e6 AS luma FROM l WHERE rn = least(CAST(floor(n * 8e-1) AS BIGINT), n - 1) + 1",
    "a14_linear_head": f"WITH v AS (SELECT vec_id // 5 AS shot, list_dot_product(CAST(embedding AS DOUBLE[]), CAST({_HEAD} AS DOUBLE[])) / 1e1 / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) + 5e-1 AS x FROM embeddings) "
    "SELECT shot, floor(greatest(0e0, least(1e0, avg(x))) * 1e4 + 0.5) / 1e4 AS score FROM v GROUP BY shot",
    "a17_rejected": _SCORED + "SELECT j.id, CASE WHEN low THEN printf('technical below floor (%.2f < 0.15)', floor(k.t * 1e2 + 0.5) / 1e2) ELSE printf('bottom 35%% (< %.3f)', floor(threshold * 1e3 + 0.5) / 1e3) END AS reason FROM j JOIN k ON k.id = j.id CROSS JOIN q WHERE low OR j.combined < threshold - 1e-9",
    "a18_summary": _SCORED + "SELECT count(*) AS considered, count(*) FILTER (WHERE low) AS floor_failures, count(*) FILTER (WHERE NOT coalesce(low, false) AND combined < threshold - 1e-9) AS below, count(*) FILTER (WHERE coalesce(low, false) OR combined < threshold - 1e-9) AS rejected, floor(max(threshold) * 1e4 + 0.5) / 1e4 AS threshold FROM j CROSS JOIN q",
    "q01_unsegmented": f"WITH c AS {_SRC} SELECT id, relpath FROM c WHERE scene_detected_at IS NULL",
    "q02_unscored": f"WITH c AS {_SHOT} SELECT id FROM c WHERE scored_at IS NULL",
    "q03_untagged": f"WITH c AS {_SHOT} SELECT id, aesthetic_score FROM c WHERE rejected = 0 AND scored_at IS NOT NULL AND tagged_at IS NULL",
    "q18_stats": f"""WITH c AS {_SHOT}, s AS {_SRC}, a AS (SELECT count(*) AS shots, count(*) FILTER (WHERE motion_class = 'held') AS held, count(*) FILTER (WHERE motion_class = 'move') AS moving, count(*) FILTER (WHERE motion_class = 'reposition') AS repositioning, count(scored_at) AS scored,
        count(*) FILTER (WHERE rejected = 1) AS rejected, count(tagged_at) AS tagged, count(*) FILTER (WHERE selection_state = 'approved') AS approved FROM c),
        b AS (SELECT count(*) AS sources, count(*) FILTER (WHERE scene_detected_at IS NULL) AS sources_unsegmented, CAST(sum(size_bytes) AS BIGINT) AS bytes FROM s)
        SELECT *, floor((scored - rejected) / CAST(scored AS DOUBLE) * 1e4 + 0.5) / 1e4 AS survival FROM a CROSS JOIN b""",
    "o02_top": f"WITH c AS {_SHOT} SELECT id, technical_score FROM c WHERE technical_score BETWEEN 0 AND 1 AND NOT isnan(technical_score) ORDER BY technical_score DESC, id LIMIT 50",
    "o04_shuffled": f"WITH c AS {_SRC} SELECT id, row_number() OVER (ORDER BY md5(concat('seed:', CAST(id AS VARCHAR))), id) AS place FROM c",
    "w17_numbered": f"WITH c AS {_SHOT} SELECT id, row_number() OVER (PARTITION BY source_id ORDER BY in_point, id) - 1 AS shot_index, CASE WHEN count(*) OVER (PARTITION BY source_id) = 1 THEN 1 ELSE 0 END AS continuous_move FROM c",
    "w20_sample_times": f"""WITH c AS {_SHOT}, n AS (SELECT id, in_point AS a, out_point - in_point AS d, greatest(1, least(CAST(floor((out_point - in_point) * 25e-2) AS INTEGER), 6)) AS n FROM c WHERE out_point > in_point),
        e AS (SELECT *, unnest(range(0, n)) AS i FROM n) SELECT id, CAST(i AS INTEGER) AS i, floor((a + d / n * (i + 5e-1)) * 1e3 + 0.5) / 1e3 AS t FROM e""",
    "j01_shot_details": "SELECT id, source_id, source_relpath, country, site, source_aspect FROM shot_details",
    "j02_without_shots": f"WITH c AS {_SHOT}, s AS {_SRC} SELECT id FROM s WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.source_id = s.id AND c.rejected = 0)",
    "j08_without_orphans": f"WITH c AS {_SHOT}, s AS {_SRC} SELECT c.id, c.source_id FROM c JOIN s ON s.id = c.source_id AND s.width >= 1920",
}
