"""Names, paths, ratios, titles and keywords as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The controlled vocabularies of tags.
SUBJECTS = "coastline beach cliffs mountains forest desert river lake waterfall farmland village town city harbour ruins religious-site castle bridge road boat vehicle livestock snow island canyon valley".split()
MOODS = "solitude vastness serenity drama desolation warmth golden-hour blue-hour overcast harsh-light mist storm nostalgia grandeur intimacy".split()
# Names that some file systems keep for devices.
DEVICES = "^(con|prn|aux|nul|com[1-9]|lpt[1-9])$"
# Named aspect ratios, tried in this order, and how close a picture must come.
ASPECTS = (("16:9", 16 / 9), ("9:16", 9 / 16), ("4:3", 4 / 3), ("1:1", 1.0), ("21:9", 21 / 9))
CLOSE = 0.02


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``x``, which is worked out once."""
    return F.transform(F.array(x), f)[0]


def present(x: Column) -> Column:
    """``x``, or NULL where it is empty text."""
    return F.nullif(x, F.lit(""))


def strip(x: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def frame_rate(text: Column) -> Column:
    """A rational text such as 30000/1001 as a number with 3 digits; NULL if it is none, or zero."""
    parts = F.split(text, "/")
    top, bottom = F.get(parts, F.lit(0)).try_cast("double"), F.when(F.size(parts) > 1, F.get(parts, F.lit(1)).try_cast("double")).otherwise(1.0)
    rate = F.floor(F.try_divide(top, bottom) * 1000 + 0.5) / 1000
    return F.when((F.size(parts) <= 2) & (rate != 0), rate)


def rotation(side: Column, tag: Column) -> Column:
    """Degrees from 0 to 359: of the side data, else of the tag, else 0."""
    return F.pmod(F.coalesce(side, tag, F.lit(0)), F.lit(360))


def aspect_label(width: Column, height: Column) -> Column:
    """A named ratio that is close, else the best fraction with a denominator up to 50; NULL without a size."""
    ratio = width / F.nullif(height, F.lit(0))
    cases = F.lit(None).cast("string")
    for name, target in reversed(ASPECTS):
        cases = F.when(F.abs(ratio - target) <= CLOSE * F.greatest(ratio, F.lit(target)), name).otherwise(cases)
    tried = F.transform(F.sequence(F.lit(1), F.lit(50)), lambda d: F.struct(F.abs(ratio - F.rint(ratio * d) / d).alias("off"), d.alias("d")))
    best = F.array_min(tried)["d"]
    fraction = F.concat(F.rint(ratio * best).cast("bigint").cast("string"), F.lit(":"), best.cast("string"))
    return F.when((width != 0) & ratio.isNotNull(), F.coalesce(cases, fraction))


def latitude_longitude(text: Column) -> tuple[Column, Column]:
    """The two leading signed numbers of a position text; NULLs if it has none."""
    pattern = r"^\s*([+-]\d+\.?\d*)([+-]\d+\.?\d*)"
    return tuple(present(F.regexp_extract(text, pattern, i)).cast("double") for i in (1, 2))


def joined(*parts: Column, sep: str = " ") -> Column:
    """The parts that aren't NULL or empty; NULL if none is left."""
    return present(F.concat_ws(sep, *[present(p) for p in parts]))


def country_of(relpath: Column) -> Column:
    """The first folder of a relative path in lower case, underscores as spaces; NULL at the root."""
    parts = F.split(F.replace(relpath, F.lit("\\"), F.lit("/")), "/")
    return F.when(F.size(parts) > 1, F.lower(F.replace(parts[0], F.lit("_"), F.lit(" "))))


def slug(text: Column, fallback: str) -> Column:
    """A path component that is safe on every platform, at most 64 characters."""
    t = F.regexp_replace(strip(F.coalesce(text, F.lit(""))), r'[<>:"/\\|?*\x00-\x1f]', "")
    t = F.regexp_replace(t, r"^[. ]+|[. ]+$", "")
    t = F.lower(F.regexp_replace(F.regexp_replace(t, r"\s+", "-"), r"^-+|-+$", ""))
    return F.when(t == "", fallback).when(t.rlike(DEVICES), F.concat(t, F.lit("-"))).otherwise(F.substring(t, 1, 64))


def year_of(text: Column) -> Column:
    """The first four characters if they are digits, else undated."""
    y = F.substring(text, 1, 4)
    return F.when(y.rlike("^[0-9]+$"), y).otherwise("undated")


def file_stem(relpath: Column) -> Column:
    """The file's name without folders and the last suffix."""
    return F.regexp_replace(F.regexp_replace(relpath, r"^.*[/\\]", ""), r"(?<=.)\.[^.]*$", "")


def shot_stem(shot_id: Column, relpath: Column, site: Column) -> Column:
    """Id of six digits or more, file and site."""
    return F.concat(F.format_string("%06d", shot_id), F.lit("_"), slug(file_stem(relpath), "source"), F.when(present(site).isNotNull(), F.concat(F.lit("_"), slug(site, "site"))).otherwise(""))


def shot_path(root: str, shot_id: Column, relpath: Column, country: Column, captured: Column, site: Column, suffix: str) -> Column:
    """root / country / year / stem and suffix."""
    return F.concat_ws("/", F.lit(root), slug(country, "unknown-country"), year_of(captured), F.concat(shot_stem(shot_id, relpath, site), F.lit(suffix)))


def title_case(text: Column) -> Column:
    """Every letter that no letter precedes in upper case, the others in lower case."""
    words = F.split(text, r"(?<=\P{L})(?=\p{L})")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))), "")


def title(description: Column, site: Column, country: Column) -> Column:
    """The description's first clause, at most 120 characters; else the place, else a general title."""
    clause = present(strip(F.split_part(F.split_part(description, F.lit("."), F.lit(1)), F.lit(","), F.lit(1))))
    return F.coalesce(F.substring(clause, 1, 120), title_case(F.coalesce(joined(site, country, sep=" · "), F.lit("Aerial footage"))))


def tag_elements(text: Column) -> Column:
    """The elements of a text as they stand: of a JSON array, or of a comma-separated list, with its white space.

    NULL for NULL, and for a text that starts with ``[`` but isn't a JSON array. Elements that aren't strings
    count as their JSON text.
    """
    # as the only element of the only field of an object, so that anything behind the array makes the text invalid
    options = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    outer = F.from_json(F.concat(F.lit('{"a":['), text, F.lit("]}")), "map<string, array<array<string>>>", options)
    parsed = let(outer, lambda o: F.when((F.size(o) == 1) & (F.size(o["a"]) == 1), o["a"][0]))  # parsed once, not for each use
    return F.when(text.startswith("["), parsed).otherwise(F.split(text, ","))


def ordered_distinct(x: Column) -> Column:
    """Each element once, where it comes first."""
    return F.array_distinct(x)


def keywords(subjects: Column, moods: Column, country: Column, site: Column, model: Column, width: Column) -> Column:
    """Search terms in order, each once: tags, place, and what the footage is."""
    nothing = F.array().cast("array<string>")
    flown = F.when(present(model).isNotNull(), F.array(F.lit("aerial"), F.lit("drone"))).otherwise(nothing)
    wide = F.when(width >= 3840, F.array(F.lit("4k"))).otherwise(nothing)
    raw = F.concat(F.coalesce(subjects, nothing), F.coalesce(moods, nothing), F.array(country, site), flown, wide)
    terms = F.transform(raw, lambda x: present(F.lower(strip(F.replace(x, F.lit("-"), F.lit(" "))))))
    return ordered_distinct(F.array_compact(terms))


def outside(tags: Column, vocabulary: list[str]) -> Column:
    """Tags that aren't in a vocabulary, in alphabetical order."""
    return F.array_sort(F.array_except(tags, F.array(*[F.lit(v) for v in vocabulary])))


def even(x: Column) -> Column:
    """Rounded half to even, then down to an even number, at least 2."""
    n = F.bround(x).cast("bigint")
    return F.greatest(F.lit(2), n - F.pmod(n, F.lit(2)))


def crop_size(width: Column, height: Column) -> tuple[Column, Column]:
    """Even size of the greatest upright 9:16 part of a picture; NULL for bad sizes or pictures that are that already."""
    ratio = width / F.nullif(height, F.lit(0))
    cut = (width > 0) & (height > 0) & (F.abs(ratio - 9 / 16) >= 0.001)
    wide = ratio > 9 / 16
    return F.when(cut, F.when(wide, F.least(even(height * 9.0 / 16), even(width))).otherwise(even(width))), F.when(cut, F.when(wide, even(height)).otherwise(F.least(even(width * 16.0 / 9), even(height))))


def last_wins(keys: Column, values: Column) -> Column:
    """A map from two arrays in which the last of repeated keys counts."""
    def of(kv: Column) -> Column:
        k, v = kv["k"], kv["v"]
        # the place of each key's last occurrence, counted from the end
        last = lambda x, i: F.array_position(F.reverse(F.slice(k, i + 1, F.size(k))), x) == F.size(k) - i
        entries = F.transform(k, lambda x, i: F.struct(x.alias("k"), F.get(v, i).alias("v"), last(x, i).alias("last")))
        return F.map_from_entries(F.transform(F.filter(entries, lambda e: e["last"]), lambda e: F.struct(e["k"], e["v"])))

    # bound once, as a lambda that named the arrays themselves would work them out for each element
    return let(F.struct(keys.alias("k"), values.alias("v")), of)


def number_text(x: Column) -> Column:
    """A number in as few characters as six digits allow: 3, 2.5, 0.125."""
    t = F.format_string("%.6f", x.cast("double"))
    return F.regexp_replace(F.regexp_replace(t, r"(\.\d*?)0+$", "$1"), r"\.$", "")


# Fixed value: how times are written as text, in UTC.
STAMP = "yyyy-MM-dd HH:mm:ss"


def stamp(at: Column) -> Column:
    """A time without zone as text, to the second."""
    return F.date_format(at, STAMP)


def parsed_stamp(text: Column) -> Column:
    """The time without zone that a text in that form denotes; NULL for any other."""
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"), text.try_cast("timestamp_ntz"))


def known_facts(country: Column, site: Column, captured: Column, lat: Column, lon: Column, seconds: Column) -> Column:
    """What is known of a shot, a line for each fact."""
    named = lambda name, x: F.concat(F.lit(f"{name}: "), present(x))
    position = F.when(lat.isNotNull() & lon.isNotNull(), F.format_string("GPS: %.4f, %.4f", lat.cast("double"), lon.cast("double")))
    return F.concat_ws("\n", named("country", country), named("site noted in the archive", site), named("captured", captured), position, F.format_string("shot length: %.1fs", F.coalesce(seconds.cast("double"), F.lit(0.0))))


def percent_text(share: Column, threshold: Column) -> Column:
    """Such as: bottom 35% (< 0.382)."""
    return F.format_string("bottom %.0f%% (< %.3f)", share * 100, F.floor(threshold * 1000 + 0.5) / 1000)
