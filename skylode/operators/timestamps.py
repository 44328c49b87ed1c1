"""Timestamps in mixed formats, precisions and time zones, brought to one UTC instant.

An ordered cascade of anchored patterns turns each text into canonical fields; every pattern is strict, so
a text that fits none, or whose fields form no date or time, denotes no instant. Everything is a Column
expression: one pass over the rows, plus a join with the small lookup of zones.

Policies
--------
* White space around the text is ignored. Case doesn't matter.
* An offset counts as it is, also beside a zone in brackets. A zone in brackets alone is the clock's zone.
* ``Z``, ``UT``, ``UTC`` and ``GMT`` are offset 0. Any other abbreviation is looked up among those that the
  place's own zone uses (around the year of the date); one that the zone doesn't use denotes no instant.
* A text without any of these is a clock time in the place's zone; without a known zone it denotes none.
* A clock time that occurred twice means the first; one that was skipped moves forward by the gap.
* Digits finer than microseconds are cut off. Second 60 and hour 24 are impossible.
* Dotted dates are day-month-year, dates with slashes month/day/year. Bare numbers of 10 digits (with
  decimals or not) count seconds, of 13 digits milliseconds, since 1970 UTC.
* Dates without a time, times without a date and NULL or empty texts denote no instant. A weekday that
  doesn't belong to the date makes it impossible.
"""

from __future__ import annotations

import functools
import zoneinfo
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_HMS = r"(?<h>[01]\d|2[0-3]):(?<mi>[0-5]\d)(?::(?<s>[0-5]\d)(?:[.,](?<f>\d+))?)?"
_H12 = r"(?<h>\d{1,2}):(?<mi>[0-5]\d)(?::(?<s>[0-5]\d)(?:[.,](?<f>\d+))?)?(?:\s?(?<p>[AP])\.?M\.?)?"
_ZONE = r"\s*(?:(?<o>[+\-−][01]\d(?::?[0-5]\d)?)|(?<a>Z|[A-Z]{2,5}))?(?:\[(?<z>[^\[\]|]+)\])?"
_MON = r"(?<mon>Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?"

#: The cascade, in order. Groups: y year, m month, d day, mon month's name, wd weekday, j day of the year,
#: w ISO week, k ISO weekday, h mi s f clock, p AM/PM, o offset, a abbreviation, z zone, es ems epoch.
PATTERNS: tuple[str, ...] = (
    rf"(?<y>\d{{4}})-(?<m>\d{{2}})-(?<d>\d{{2}})(?:T|\s+){_HMS}{_ZONE}",
    rf"(?<y>\d{{4}}):(?<m>\d{{2}}):(?<d>\d{{2}})(?:T|\s+){_HMS}{_ZONE}",
    rf"(?<y>\d{{4}})(?<m>\d{{2}})(?<d>\d{{2}})[T_ ](?<h>[01]\d|2[0-3])(?<mi>[0-5]\d)(?:(?<s>[0-5]\d)(?:[.,](?<f>\d+))?)?{_ZONE}",
    rf"(?<d>\d{{1,2}})\.(?<m>\d{{1,2}})\.(?<y>\d{{4}})(?:T|,?\s+){_HMS}{_ZONE}",
    rf"(?<m>\d{{1,2}})/(?<d>\d{{1,2}})/(?<y>\d{{4}})(?:T|,?\s+){_H12}{_ZONE}",
    rf"(?:(?<wd>Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,?\s+)?(?<d>\d{{1,2}})[\s-]{_MON}[\s-](?<y>\d{{4}}),?\s+{_H12}{_ZONE}",
    rf"(?:(?<wd>Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,?\s+)?{_MON}\s+(?<d>\d{{1,2}}),?\s+(?<y>\d{{4}}),?\s+{_H12}{_ZONE}",
    rf"(?<y>\d{{4}})-(?<j>\d{{3}})(?:T|\s+){_HMS}{_ZONE}",
    rf"(?<y>\d{{4}})-?W(?<w>\d{{2}})-?(?<k>\d)(?:T|\s+){_HMS}{_ZONE}",
    r"(?<es>\d{10})(?:\.(?<f>\d+))?",
    r"(?<ems>\d{13})",
)
_FIELDS = ("y", "m", "d", "mon", "wd", "j", "w", "k", "h", "mi", "s", "f", "p", "o", "a", "z", "es", "ems")
_UNIVERSAL = ("Z", "UT", "UTC", "GMT")
_YEARS = (1970, 2037)


@functools.lru_cache(maxsize=None)
def abbreviations(name: str) -> dict[str, list[tuple[int, int, int]]]:
    """Abbreviation -> [(first year, last year, offset in seconds)] of a zone, latest first; none for unknown zones.

    Sampled monthly over 1970..2037, so bounded by the tz database (about 600 zones, a few names each).
    """
    if name not in zoneinfo.available_timezones():
        return {}
    zone = zoneinfo.ZoneInfo(name)
    found: dict[tuple[str, int], list[int]] = {}
    for year in range(_YEARS[0], _YEARS[1] + 1):
        for month in range(1, 13):
            t = datetime(year, month, 15, 12, tzinfo=zone)
            abbr = t.tzname() or ""
            if abbr.isalpha():
                found.setdefault((abbr.upper(), int(t.utcoffset().total_seconds())), [year, year])[1] = year
    out: dict[str, list[tuple[int, int, int]]] = {}
    for (abbr, off), (lo, hi) in found.items():
        out.setdefault(abbr, []).append((lo, hi, off))
    return {a: sorted(v, reverse=True) for a, v in out.items()}


@functools.lru_cache(maxsize=1)
def _zone_ids(app: str) -> tuple[str, ...]:
    jvm = SparkSession.getActiveSession().sparkContext._jvm
    return tuple(sorted(str(x) for x in jvm.java.time.ZoneId.getAvailableZoneIds().toArray()))


def _known(zone: Column, ids: tuple[str, ...]) -> Column:
    # one text instead of a Column for each of the 600 names
    return F.array_contains(F.split(F.lit(",".join(ids)), ","), zone)


def zone_lookup(spark: SparkSession, zones: DataFrame, place: str, zone: str, at_most: int = 10_000) -> DataFrame:
    """(__place, __zone, __abbr) for each place: its zone, and the abbreviations used there.

    A place named twice takes its alphabetically first zone; zones that don't exist are NULL. Up to
    ``at_most`` places the lookup is fetched and marked for broadcast; with more it stays distributed and is
    joined without a hint.
    """
    ids = _zone_ids(spark.sparkContext.applicationId)
    kind = "__zone string, __abbr map<string, array<struct<lo: int, hi: int, off: int>>>"
    known = zones.where(F.col(place).isNotNull()).groupBy(F.col(place).cast("string").alias("__place")).agg(F.min(F.when(_known(F.col(zone), ids), F.col(zone))).alias("__zone"))
    got = known.limit(at_most + 1).collect()
    if len(got) > at_most:
        table = spark.createDataFrame([(z, abbreviations(z)) for z in ids], kind)
        return known.join(table, "__zone", "left").select("__place", "__zone", "__abbr")
    return F.broadcast(spark.createDataFrame([(p, z, abbreviations(z) if z else None) for p, z in got], f"__place string, {kind}"))


def _canonical(text: Column) -> Column:
    """The fields of the first pattern that fits, joined by ``|``; NULL where none does."""
    cases = []
    for p in PATTERNS:
        whole = rf"(?i)^{p}$"
        fill = "|".join(f"${{{f}}}" if f"(?<{f}>" in p else "" for f in _FIELDS)
        cases.append(F.when(text.rlike(whole), F.regexp_replace(text, whole, fill)))
    return F.coalesce(*cases)


def _texts() -> list[Column]:
    def part(name: str) -> Column:
        x = F.col("__parts")[_FIELDS.index(name)]
        return F.when(x != "", x)

    month = F.ceil(F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(F.substring(part("mon"), 1, 3))) / 3).cast("int")
    offset = F.replace(F.regexp_replace(part("o"), "−", "-"), F.lit(":"), F.lit(""))
    return [
        *[part(f).try_cast("int").alias(f"__{f}") for f in ("y", "d", "j", "w", "k", "h", "mi")],
        F.coalesce(part("m").try_cast("int"), month).alias("__m"),
        F.ceil(F.instr(F.lit("montuewedthufrisatsun"), F.lower(F.substring(part("wd"), 1, 3))) / 3).cast("int").alias("__wd"),
        F.coalesce(part("s").try_cast("int"), F.lit(0)).alias("__s"),
        F.coalesce(F.substring(F.rpad(part("f"), 6, "0"), 1, 6).try_cast("bigint"), F.lit(0).cast("bigint")).alias("__f"),
        F.lower(part("p")).alias("__p"),
        F.substring(offset, 1, 1).alias("__sign"),
        (F.substring(offset, 2, 2).try_cast("int") * 3600 + F.coalesce(F.substring(offset, 4, 2).try_cast("int"), F.lit(0)) * 60).alias("__ahead"),
        F.upper(part("a")).alias("__a"),
        part("z").alias("__z"),
        part("es").cast("bigint").alias("__es"),
        part("ems").cast("bigint").alias("__ems"),
    ]


def _days() -> Column:
    """Days since 1970 of the date, NULL where the fields form none."""
    y, m, d, j, w, k = (F.col(f"__{f}") for f in ("y", "m", "d", "j", "w", "k"))
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    last = F.when(m.isin(4, 6, 9, 11), 30).when(m == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
    # make_date is reached only with fields that form a date
    civil = F.when(m.between(1, 12) & d.between(1, last), F.unix_date(F.make_date(y, m, d)))
    ordinal = F.when(j.between(1, F.when(leap, 366).otherwise(365)), F.unix_date(F.make_date(y, F.lit(1), F.lit(1))) + j - 1)
    jan4 = F.make_date(y, F.lit(1), F.lit(4))
    monday = F.unix_date(jan4) - F.weekday(jan4) + (w - 1) * 7
    # a week belongs to the year that its Thursday is in
    week = F.when(w.between(1, 53) & k.between(1, 7), F.when(F.year(F.date_from_unix_date(monday + 3)) == y, monday + k - 1))
    return F.when(y < 1, None).when(m.isNotNull(), civil).when(j.isNotNull(), ordinal).when(w.isNotNull(), week)


def _local() -> Column:
    """Microseconds since 1970 that the clock showed."""
    days, h, p = F.col("__days"), F.col("__h"), F.col("__p")
    hour = F.when(p.isNull(), F.when(h <= 23, h)).when(h.between(1, 12), h % 12 + F.when(p == "p", 12).otherwise(0))
    of_week = F.pmod(days + 3, F.lit(7)) + 1
    days = F.when(F.coalesce(F.col("__wd") == of_week, F.lit(True)), days)
    return (days.cast("bigint") * 86400 + hour * 3600 + F.col("__mi") * 60 + F.col("__s")) * 1_000_000 + F.col("__f")


def _instant(ids: tuple[str, ...]) -> Column:
    a, z, local, ahead = (F.col(f"__{f}") for f in ("a", "z", "local", "ahead"))
    ahead = F.when(ahead <= 18 * 3600, F.when(F.col("__sign") == "-", -ahead).otherwise(ahead))
    about = F.greatest(F.lit(_YEARS[0]), F.least(F.lit(_YEARS[1]), F.col("__y")))
    named = F.filter(F.try_element_at(F.col("__abbr"), a), lambda x: (x.lo <= about) & (about <= x.hi))
    fixed = F.when(F.col("__ahead").isNotNull(), ahead).when(a.isin(*_UNIVERSAL), 0).otherwise(F.try_element_at(named, F.lit(1))["off"])
    clock = F.when(z.isNotNull(), F.when(_known(z, ids), z)).otherwise(F.col("__zone"))
    # to_utc_timestamp takes the first of two clock times and moves skipped ones forward by the gap
    zoned = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local), clock))
    return (
        F.when(F.col("__es").isNotNull(), F.col("__es") * 1_000_000 + F.col("__f"))
        .when(F.col("__ems").isNotNull(), F.col("__ems") * 1000)
        .when(F.col("__ahead").isNotNull() | a.isNotNull(), local - fixed.cast("bigint") * 1_000_000)
        .otherwise(zoned)
    )


def to_instants(df: DataFrame, zones: DataFrame, *, text: str = "captured_at", place: str = "country", zone_place: str = "country", zone: str = "tz_name", out: str = "captured_us") -> DataFrame:
    """``df`` with column ``out``: microseconds since 1970 UTC of the instant that ``text`` denotes, or NULL.

    All other columns and all rows stay as they are (``out`` replaces a column of that name); repeated rows
    give repeated results; no rows give none. See the module for the policies. ``zones`` gives each place's
    zone (see :func:`zone_lookup`). A NULL or unknown place has no zone. Column names that start with two
    underscores are this function's own.
    """
    spark = df.sparkSession
    ids = _zone_ids(spark.sparkContext.applicationId)
    keep = [F.col(f"`{c}`") for c in df.columns if c != out]
    clean = F.regexp_replace(F.col(f"`{text}`").cast("string"), r"^[\s\u00A0\uFEFF]+|[\s\u00A0\uFEFF]+$", "")
    rows = df.select(*keep, F.col(f"`{place}`").cast("string").alias("__at"), clean.alias("__text"))
    rows = rows.select(*keep, "__at", F.split(_canonical(F.col("__text")), r"\|").alias("__parts"))
    rows = rows.select(*keep, "__at", *_texts())
    held = ["__at", "__y", "__a", "__z", "__es", "__ems", "__f", "__ahead", "__sign"]
    rows = rows.select(*keep, *held, "__wd", "__h", "__mi", "__s", "__p", _days().alias("__days"))
    rows = rows.select(*keep, *held, _local().alias("__local"))
    rows = rows.join(zone_lookup(spark, zones, zone_place, zone), F.col("__at") == F.col("__place"), "left")
    return rows.select(*keep, _instant(ids).alias(out))
