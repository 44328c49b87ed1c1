"""Video files and their descriptions: folder scans, probe documents, manifests and side files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylode.functions import text as tx

#: Suffixes of video files.
VIDEO = (".mp4", ".mov", ".mxf", ".insv")
# Fixed value: how the tags of one vendor's container start.
VENDOR = "com.apple.quicktime."
#: What a probe tool writes about a file, as far as it is read.
PROBE = (
    "format struct<duration: string, bit_rate: string, tags: map<string, string>>, "
    "streams array<struct<codec_type: string, codec_name: string, width: int, height: int, duration: string, "
    "r_frame_rate: string, tags: map<string, string>, side_data_list: array<struct<rotation: int>>>>"
)


def scan_videos(spark: SparkSession, root: str, suffixes: Sequence[str] = VIDEO) -> DataFrame:
    """(path, size_bytes, mtime) of video files below a folder in order of path; hidden files don't count, contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size_bytes"), F.unix_micros("modificationTime").alias("us"))
    name = F.lower(F.regexp_extract("path", r"[^/]*$", 0))
    wanted = F.lit(False)
    for s in suffixes:
        wanted = wanted | name.endswith(s)
    return files.where(wanted & ~name.startswith(".")).select("path", "size_bytes", (F.col("us") / 1e6).alias("mtime")).orderBy("path")


def probe_fields(document: Column) -> dict[str, Column]:
    """Columns of a probe document (JSON text); NULLs where it isn't one or says nothing.

    Tags are found whatever their case (of several that differ in case only the last counts), empty ones count as missing, and a
    vendor's tag goes before the general one. Only the time of creation falls back on the video stream's tags.
    """
    p = F.from_json(document, PROBE)
    video = F.get(F.filter(p["streams"], lambda s: s["codec_type"] == "video"), F.lit(0))

    def tag(tags: Column, name: str) -> Column:
        found = F.filter(F.map_entries(tags), lambda e: F.lower(e["key"]) == name)
        return tx.present(F.get(found, F.size(found) - 1)["value"])

    def first_tag(*names: str) -> Column:
        return F.coalesce(*[tag(p["format"]["tags"], n) for n in names])

    side = F.get(F.filter(F.transform(video["side_data_list"], lambda d: d["rotation"]), lambda r: r.isNotNull()), F.lit(0))
    turned = tx.rotation(side, tag(video["tags"], "rotate").try_cast("int")).isin(90, 270)
    lat, lon = tx.latitude_longitude(first_tag(VENDOR + "location.iso6709", "location"))
    width, height = F.when(turned, video["height"]).otherwise(video["width"]), F.when(turned, video["width"]).otherwise(video["height"])
    return {
        "duration": F.coalesce(tx.present(p["format"]["duration"]), video["duration"]).try_cast("double"),
        "width": width,
        "height": height,
        "fps": tx.frame_rate(video["r_frame_rate"]),
        "codec": video["codec_name"],
        "bitrate": p["format"]["bit_rate"].try_cast("bigint"),
        "aspect": tx.aspect_label(width, height),
        "captured_at": F.coalesce(first_tag("creation_time"), tag(video["tags"], "creation_time")),
        "gps_lat": lat,
        "gps_lon": lon,
        "drone_model": tx.joined(first_tag(VENDOR + "make", "make"), first_tag(VENDOR + "model", "model")),
    }


def side_document(columns: dict[str, Column | dict]) -> Column:
    """Nested columns as one JSON text; NULL fields are written."""
    def pack(c: dict) -> Column:
        return F.struct(*[(pack(v) if isinstance(v, dict) else v).alias(k) for k, v in c.items()])

    return F.to_json(pack(columns), {"ignoreNullFields": "false"})


def write_manifest(df: DataFrame, folder: str) -> int:
    """Writes ``df`` as CSV with a header; nothing if it has no rows. Returns the number of rows."""
    n = df.count()
    if n:
        df.write.mode("overwrite").option("header", True).option("quoteAll", False).option("escape", '"').csv(folder)
    return n
