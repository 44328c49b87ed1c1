"""The general problems of TESTDATA.md as queries: p1 (timestamps) and p3 (positions)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylode.operators.neighbours import near_pairs
from skylode.operators.regions import containing_regions
from skylode.operators.timestamps import to_instants
from skylode.operators.versions import current_rows
from skylode.sources.tables import read_table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """(id, captured_us) of each source whose captured_at denotes an instant."""
    rows = current_rows(read_table(spark, folder, "sources"), "id", "loaded_at", "captured_at", "country")
    got = to_instants(rows, read_table(spark, folder, "country_zones"))
    return got.where(F.col("captured_us").isNotNull()).select("id", "captured_us")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """(id_a, id_b) of sources filmed at most 60 m apart."""
    rows = current_rows(read_table(spark, folder, "sources"), "id", "loaded_at", "gps_lat", "gps_lon")
    return near_pairs(rows, 60.0)


def p3_regions(spark: SparkSession, folder: str) -> DataFrame:
    """(id, region) of sources filmed inside a diamond of 5 degrees around a grid of centres, but for a square hole of 1 degree at each.

    The tables have no polygons; these lie 10 degrees apart, so that about half of the earth is inside one.
    """
    n = F.col("id")
    x, y = (n % 36) * 10 - 175 + F.lit(0.123), F.floor(n / 36) * 10 - 80 + F.lit(0.123)

    def ring(*corners: tuple[float, float]):
        return F.array(*[F.struct((x + a).alias("lon"), (y + b).alias("lat")) for a, b in corners])

    rings = F.array(ring((5, 0), (0, 5), (-5, 0), (0, -5)), ring((1, 1), (-1, 1), (-1, -1), (1, -1)))
    diamonds = spark.range(36 * 17).select(n.alias("region"), rings.alias("rings"))
    rows = current_rows(read_table(spark, folder, "sources"), "id", "loaded_at", "gps_lat", "gps_lon")
    return containing_regions(rows, diamonds)


QUERIES = {"p1_found": p1_found, "p3_found": p3_found, "p3_regions": p3_regions}

#: The same policies in another dialect; the abbreviations are those of the zones in the lookup.
_P1 = r"""
    WITH c AS (SELECT v.id, v.country, regexp_replace(captured_at, '^\s+|\s+$', '', 'g') AS x
               FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) AS rn FROM sources) AS v WHERE rn = 1),
    z AS (SELECT id, country, regexp_extract(x, '\[([^\]]+)\]$', 1) AS zone, regexp_replace(x, '\[[^\]]+\]$', '') AS y FROM c),
    o AS (SELECT *, regexp_extract(y, ':\d\d[^+−-]*([+−-]\d\d(:?\d\d)?)$', 1) AS off, upper(regexp_extract(y, '\d ?([A-Za-z]{1,5})$', 1)) AS ab FROM z),
    t AS (SELECT id, country, zone, replace(replace(off, ':', ''), '−', '-') AS off, CASE WHEN ab IN ('AM', 'PM') THEN '' ELSE ab END AS ab,
          CASE WHEN off <> '' THEN regexp_replace(y, '\s*[+−-]\d\d(:?\d\d)?$', '') WHEN ab NOT IN ('', 'AM', 'PM') THEN regexp_replace(y, '\s*[A-Za-z]{1,5}$', '') ELSE y END AS t FROM o),
    f AS (SELECT *, CASE WHEN t LIKE '%:%' OR regexp_matches(t, '^\d{10}[.]\d+$') THEN regexp_extract(t, '[.,](\d+)$', 1) ELSE '' END AS frac,
          regexp_replace(CASE WHEN t LIKE '%:%' OR regexp_matches(t, '^\d{10}[.]\d+$') THEN regexp_replace(t, '[.,]\d+$', '') ELSE t END, '^(\d{4}-[0-9W-]+)[Tt]', '\1 ') AS b FROM t),
    w AS (SELECT *, CASE WHEN regexp_matches(b, '^\d{4}-W\d\d-[1-7] ') THEN CAST(concat(substr(b, 1, 4), '-01-04') AS DATE) END AS jan4 FROM f),
    d AS (SELECT *, CASE
            WHEN regexp_matches(b, '^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$') THEN try_strptime(b, '%Y-%m-%d %H:%M:%S')
            WHEN regexp_matches(b, '^\d{4}-\d\d-\d\d \d\d:\d\d$') THEN try_strptime(b, '%Y-%m-%d %H:%M')
            WHEN regexp_matches(b, '^\d{4}:\d\d:\d\d \d\d:\d\d:\d\d$') THEN try_strptime(b, '%Y:%m:%d %H:%M:%S')
            WHEN regexp_matches(b, '^\d{8}[_T]\d{6}$') THEN try_strptime(replace(b, 'T', '_'), '%Y%m%d_%H%M%S')
            WHEN regexp_matches(b, '^\d\d[.]\d\d[.]\d{4} \d\d:\d\d:\d\d$') THEN try_strptime(b, '%d.%m.%Y %H:%M:%S')
            WHEN regexp_matches(b, '^\d\d/\d\d/\d{4} \d{1,2}:\d\d [AP]M$') THEN try_strptime(b, '%m/%d/%Y %I:%M %p')
            WHEN regexp_matches(b, '^[A-Z][a-z]{2}, \d\d [A-Z][a-z]{2} \d{4} \d\d:\d\d:\d\d$') THEN try_strptime(substr(b, 6), '%d %b %Y %H:%M:%S')
            WHEN regexp_matches(b, '^\d\d [A-Z][a-z]{2} \d{4} \d\d:\d\d:\d\d$') THEN try_strptime(b, '%d %b %Y %H:%M:%S')
            WHEN regexp_matches(b, '^[A-Z][a-z]{2} \d{1,2}, \d{4} \d\d:\d\d:\d\d$') THEN try_strptime(b, '%b %d, %Y %H:%M:%S')
            WHEN regexp_matches(b, '^\d{4}-\d{3} \d\d:\d\d:\d\d$') THEN try_strptime(concat(substr(b, 1, 4), '-01-01', substr(b, 9)), '%Y-%m-%d %H:%M:%S') + to_days(CAST(substr(b, 6, 3) AS INTEGER) - 1)
            WHEN jan4 IS NOT NULL THEN try_strptime(concat(CAST(jan4 AS VARCHAR), substr(b, 11)), '%Y-%m-%d %H:%M:%S') + to_days(CAST(1 - isodow(jan4) + (CAST(substr(b, 7, 2) AS INTEGER) - 1) * 7 + CAST(substr(b, 10, 1) AS INTEGER) - 1 AS INTEGER))
          END AS clock FROM w),
    k AS (SELECT d.*, CAST(rpad(substr(concat(frac, '000000'), 1, 6), 6, '0') AS BIGINT) AS us, CASE WHEN zone <> '' THEN zone ELSE z.tz_name END AS tz,
          z.tz_name AS own, TRY_CAST(substr(off, 2, 2) AS INTEGER) * 60 + CASE WHEN length(off) > 3 THEN TRY_CAST(substr(off, 4, 2) AS INTEGER) ELSE 0 END AS ahead
          FROM (SELECT *, CASE WHEN off = '' THEN NULL ELSE off END AS has FROM d) AS d LEFT JOIN country_zones AS z ON z.country = d.country),
    a AS (SELECT *, CASE ab WHEN 'Z' THEN 0 WHEN 'UTC' THEN 0 WHEN 'GMT' THEN 0 WHEN 'WET' THEN 0 WHEN 'WEST' THEN 60 WHEN 'CET' THEN 60 WHEN 'CEST' THEN 120 WHEN 'EET' THEN 120 WHEN 'EEST' THEN 180 WHEN 'BST' THEN 60
            WHEN 'IST' THEN CASE own WHEN 'Asia/Kolkata' THEN 330 ELSE 60 END WHEN 'EAT' THEN 180 WHEN 'JST' THEN 540 WHEN 'AEST' THEN 600 WHEN 'AEDT' THEN 660 WHEN 'NZST' THEN 720 WHEN 'NZDT' THEN 780
            WHEN 'NST' THEN -210 WHEN 'NDT' THEN -150 WHEN 'AST' THEN -240 WHEN 'ADT' THEN -180 WHEN 'MST' THEN -420 WHEN 'MDT' THEN -360 END AS named FROM k),
    i AS (SELECT *, CASE WHEN has IS NULL AND ab = '' AND tz IS NOT NULL AND clock IS NOT NULL THEN timezone(tz, clock) END AS later FROM a),
    r AS (SELECT id, CASE
            WHEN regexp_matches(b, '^\d{10}$') THEN CAST(b AS BIGINT) * 1000000 + us
            WHEN regexp_matches(b, '^\d{13}$') THEN CAST(b AS BIGINT) * 1000
            WHEN has IS NOT NULL THEN epoch_us(clock) + us - CASE WHEN off LIKE '-%' THEN -ahead ELSE ahead END * CAST(60000000 AS BIGINT)
            WHEN ab <> '' THEN epoch_us(clock) + us - named * CAST(60000000 AS BIGINT)
            WHEN timezone(tz, later - INTERVAL 1 HOUR) = clock THEN epoch_us(later) - CAST(3600000000 AS BIGINT) + us
            WHEN timezone(tz, later - INTERVAL 30 MINUTE) = clock THEN epoch_us(later) - CAST(1800000000 AS BIGINT) + us
            ELSE epoch_us(later) + us END AS captured_us FROM i)
    SELECT id, captured_us FROM r WHERE captured_us IS NOT NULL
"""

SQL = {
    "p1_found": _P1,
    "p3_found": """
        WITH v AS (SELECT id, gps_lat AS la, gps_lon AS lo, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) AS rn FROM sources),
        c AS (SELECT id, la, lo, CAST(floor(la * 1e3) AS BIGINT) AS band FROM v
              WHERE rn = 1 AND la BETWEEN -90 AND 90 AND lo BETWEEN -180 AND 180 AND NOT isnan(la) AND NOT isnan(lo) AND NOT (la = 0 AND lo = 0)),
        n AS (SELECT *, band + k AS near FROM c CROSS JOIN (VALUES (-1), (0), (1)) AS t(k))
        SELECT a.id AS id_a, b.id AS id_b FROM c AS a JOIN n AS b ON a.band = b.near
        WHERE a.id < b.id AND 2 * 6371008.8 * asin(sqrt(least(1e0, pow(sin(radians(b.la - a.la) / 2), 2) + cos(radians(a.la)) * cos(radians(b.la)) * pow(sin(radians(b.lo - a.lo) / 2), 2)))) <= 60
    """,
    "p3_regions": """
        WITH v AS (SELECT id, gps_lat AS la, gps_lon AS lo, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) AS rn FROM sources),
        c AS (SELECT id, la, lo, CAST(floor((lo + 175 - 123e-3) / 10 + 0.5) AS BIGINT) AS i, CAST(floor((la + 80 - 123e-3) / 10 + 0.5) AS BIGINT) AS j FROM v
              WHERE rn = 1 AND la BETWEEN -90 AND 90 AND lo BETWEEN -180 AND 180 AND NOT isnan(la) AND NOT isnan(lo) AND NOT (la = 0 AND lo = 0)),
        d AS (SELECT *, abs(lo - (i * 10 - 175 + 123e-3)) AS dx, abs(la - (j * 10 - 80 + 123e-3)) AS dy FROM c)
        SELECT id, (i + 36) % 36 + 36 * j AS region FROM d WHERE j BETWEEN 0 AND 16 AND dx + dy < 5 AND NOT (dx < 1 AND dy < 1)
    """,
}
