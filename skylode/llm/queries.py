"""The problems tagged llm in TESTDATA.md as queries over its tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylode.llm import abuse, bpe, cooccur, dyadic, mixture, ranking, selection
from skylode.operators.versions import current_rows
from skylode.sources.tables import read_table

#: Current rows of a table, as SQL; TABLE and KEY are filled in.
_CURRENT = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY loaded_at DESC) AS rn FROM {table}) AS v WHERE rn = 1)"


def _tag_pairs(spark: SparkSession, folder: str, min_pairs: int = 10) -> DataFrame:
    shots = current_rows(read_table(spark, folder, "shots"), "id", "loaded_at", "subject_tags", "mood_tags")
    items = F.array_union(cooccur.tag_list(F.col("subject_tags")), cooccur.tag_list(F.col("mood_tags")))
    return cooccur.cooccurrence(shots.select(items.alias("items")), min_pairs=min_pairs)


def _named(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("item_a").alias("tag_a"), F.col("item_b").alias("tag_b"), "n_ab", "n_a", "n_b", "n", F.round("lift", 6).alias("lift"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """(tag_a, tag_b) of tags together in at least 10 shots and twice as often as by chance."""
    pairs = _tag_pairs(spark, folder)
    return pairs.where(cooccur.above_chance(pairs, 2)).select(F.col("item_a").alias("tag_a"), F.col("item_b").alias("tag_b"))


def p2_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, marginals and lift of every two tags together in at least 10 shots; ``p2_all_pairs`` has the others too."""
    return _named(_tag_pairs(spark, folder))


def p2_all_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, marginals and lift of every two tags together in any shot."""
    return _named(_tag_pairs(spark, folder, min_pairs=1))


def _kept(spark: SparkSession, folder: str) -> selection.Kept:
    shots = current_rows(read_table(spark, folder, "shots"), "id", "loaded_at", "technical_score")
    rows = shots.join(read_table(spark, folder, "shot_details", "id", "country"), "id")
    return selection.Kept(rows, read_table(spark, folder, "keep_targets"), group="country", key="id", score="technical_score", permille="keep_permille")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """(country, shot_id) of the shots that reach their country's cutoff."""
    return _kept(spark, folder).rows().select(F.col("grp").alias("country"), F.col("id").alias("shot_id"))


def p4_cutoffs(spark: SparkSession, folder: str) -> DataFrame:
    """Each country's target, number of scores, cutoff, and number kept."""
    return _kept(spark, folder).report().select(F.col("grp").alias("country"), F.col("permille").alias("keep_permille"), "n", "cutoff", "kept")


def _percentiles(spark: SparkSession, folder: str, pcts: tuple[float, ...]) -> DataFrame:
    shots = current_rows(read_table(spark, folder, "shots"), "id", "loaded_at", "motion_class", "technical_score", "aesthetic_score")
    rows = shots.join(read_table(spark, folder, "shot_details", "id", "country").where("country IS NOT NULL"), "id")
    groups = ["country", "motion_class"]
    parts = dyadic.build(rows, groups, {"technical": "technical_score", "aesthetic": "aesthetic_score"})
    got = dyadic.percentiles(dyadic.merge(parts, groups), groups, pcts)
    return got.select(*groups, F.col("metric").alias("score"), F.col("pct").cast("int").alias("pct"), "n", "value", "error", "rank_error")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """(country, motion_class, score, pct) of groups of 200 or more with a low median or 95th percentile."""
    got = _percentiles(spark, folder, (50.0, 95.0)).where("n >= 200")
    low = ((F.col("pct") == 50) & (F.col("value") < 0.42)) | ((F.col("pct") == 95) & (F.col("value") < 0.75))
    return got.where(low).select("country", "motion_class", "score", "pct")


def p5_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Five percentiles of both scores of each country and motion class, with their greatest error and that of their rank."""
    return _percentiles(spark, folder, (5.0, 25.0, 50.0, 75.0, 95.0))


def _rated(spark: SparkSession, folder: str) -> DataFrame:
    shots = current_rows(read_table(spark, folder, "shots"), "id", "loaded_at", "source_id", "technical_score", "aesthetic_score")
    scores = current_rows(read_table(spark, folder, "scores"), "shot_id", "loaded_at", "motion", "stability")
    rows = shots.join(scores, shots.id == scores.shot_id, "left").select(F.col("id").alias("shot_id"), "source_id", "motion", "stability", "technical_score", "aesthetic_score")
    valid = {
        "motion": F.when((F.col("motion") >= 0) & (F.col("motion") < float("inf")), F.col("motion")),
        "stability": F.when(F.col("stability").between(0, 100), F.col("stability")),
        "technical": F.when(F.col("technical_score").between(0, 1), F.col("technical_score")),
        "aesthetic": F.when(F.col("aesthetic_score").between(0, 1), F.col("aesthetic_score")),
    }
    return ranking.combined(rows, "shot_id", valid, carry=["source_id"])


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """(source_id, shot_id) of shots that lead their source by the ranking and in every score.

    A shot that is nowhere below and somewhere above each other has the greatest rating of its source, so the
    top of each source is the only candidate; the greatest of each score then decide.
    """
    four = ["motion", "stability", "technical", "aesthetic"]
    rated = _rated(spark, folder).where(" AND ".join(f"{c} IS NOT NULL" for c in four))
    tuple_ = ["rating", *four]
    top = rated.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.struct(*tuple_, "shot_id")).alias("first"),
        F.max(F.struct(*tuple_, (-F.col("shot_id")).alias("less"))).alias("last"),
        *[F.max(c).alias(f"max_{c}") for c in four],
    )
    leads = F.col("first.shot_id") == -F.col("last.less")  # else the same four scores come twice
    for c in four:
        leads &= F.col(f"first.{c}") == F.col(f"max_{c}")
    return top.where((F.col("n") >= 3) & leads & F.col("source_id").isNotNull()).select("source_id", F.col("first.shot_id").alias("shot_id"))


def p6_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """(position, shot_id, rating) of every shot; those without any valid score come last."""
    rated = _rated(spark, folder).select("shot_id", "rating")
    return ranking.positions(rated, [F.col("rating").desc_nulls_last(), F.col("shot_id")]).select("position", "shot_id", F.round("rating", 9).alias("rating"))


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, ids): the ids of each document's whole text by byte_bpe_50k."""
    return bpe.encode(read_table(spark, folder, "documents", "doc_id", "text")).select("doc_id", "ids")


def _mixed(spark: SparkSession, folder: str) -> mixture.Mixture:
    sizes = bpe.count_tokens(read_table(spark, folder, "documents", "doc_id", "source", "text"))
    return mixture.Mixture(sizes, read_table(spark, folder, "mix_targets"))


def p8_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, source, n_tokens, rate, copies) of the documents in the mixture."""
    return _mixed(spark, folder).rows().select(F.col("id").alias("doc_id"), F.col("src").alias("source"), F.col("size").alias("n_tokens"), "rate", "copies")


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares and repeats that the mixture reaches."""
    return _mixed(spark, folder).report()


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents", "doc_id", "source", "text")
    texts, labels = abuse.labelled(documents, read_table(spark, folder, "doc_labels"))
    model = abuse.train(texts, labels)
    return abuse.score(documents, model).withColumn("abusive", (F.col("score") >= model.threshold).cast("int"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id) of documents with an abusive, hateful or sexually explicit passage."""
    return _judged(spark, folder).where("abusive = 1").select("doc_id")


def p9_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's score, and whether it counts as abusive."""
    return _judged(spark, folder).select("doc_id", "source", "score", "abusive")


def p9_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, abusive documents and their rate for each source (NULL is one of its own)."""
    return _judged(spark, folder).groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("abusive").alias("abusive"), F.avg("abusive").alias("rate"))


QUERIES = {
    "p2_found": p2_found,
    "p2_pairs": p2_pairs,
    "p2_all_pairs": p2_all_pairs,
    "p4_found": p4_found,
    "p4_cutoffs": p4_cutoffs,
    "p5_found": p5_found,
    "p5_percentiles": p5_percentiles,
    "p6_found": p6_found,
    "p6_ranking": p6_ranking,
    "p7_ids": p7_ids,
    "p8_mixture": p8_mixture,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_scores": p9_scores,
    "p9_rates": p9_rates,
}

_P2 = f"""
    WITH c AS {_CURRENT.format(table="shots", key="id")},
    l AS (SELECT id, subject_tags AS t FROM c UNION ALL SELECT id, mood_tags FROM c),
    e AS (SELECT id, unnest(CASE WHEN t LIKE '[%' THEN CASE WHEN json_valid(t) THEN from_json(t, '["VARCHAR"]') ELSE NULL END ELSE string_split(t, ',') END) AS x FROM l WHERE t IS NOT NULL),
    g AS (SELECT DISTINCT id, replace(replace(lower(trim(x)), ' ', '-'), '_', '-') AS tag FROM e WHERE x IS NOT NULL AND trim(x) <> ''),
    m AS (SELECT tag, count(*) AS k FROM g GROUP BY tag),
    p AS (SELECT a.tag AS tag_a, b.tag AS tag_b, count(*) AS n_ab FROM g AS a JOIN g AS b ON a.id = b.id AND a.tag < b.tag GROUP BY a.tag, b.tag HAVING count(*) >= 10),
    r AS (SELECT p.*, a.k AS n_a, b.k AS n_b, (SELECT count(DISTINCT id) FROM g) AS n FROM p JOIN m AS a ON a.tag = p.tag_a JOIN m AS b ON b.tag = p.tag_b)
"""
_P2_ALL = _P2.replace(" HAVING count(*) >= 10", "")
_P4 = f"""
    WITH c AS {_CURRENT.format(table="shots", key="id")},
    s AS (SELECT d.country, c.id, c.technical_score AS x, t.keep_permille AS keep
          FROM c JOIN shot_details AS d ON d.id = c.id JOIN keep_targets AS t ON t.country = d.country
          WHERE c.technical_score BETWEEN 0 AND 1 AND NOT isnan(c.technical_score)),
    r AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY x DESC) AS place, count(*) OVER (PARTITION BY country) AS n FROM s),
    k AS (SELECT country, min(x) AS cutoff FROM r WHERE place <= greatest(1, (n * keep + 999) // 1000) GROUP BY country)
"""
_P5 = f"""
    WITH c AS {_CURRENT.format(table="shots", key="id")},
    v AS (SELECT d.country, c.motion_class, 'technical' AS score, c.technical_score AS x FROM c JOIN shot_details AS d ON d.id = c.id
          UNION ALL SELECT d.country, c.motion_class, 'aesthetic', c.aesthetic_score FROM c JOIN shot_details AS d ON d.id = c.id),
    q AS (SELECT country, motion_class, score, count(*) AS n, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.95) AS p95 FROM v
          WHERE x BETWEEN 0 AND 1 AND NOT isnan(x) AND country IS NOT NULL AND motion_class IS NOT NULL GROUP BY country, motion_class, score)
"""
_P6 = f"""
    WITH c AS {_CURRENT.format(table="shots", key="id")}, m AS {_CURRENT.format(table="scores", key="shot_id")},
    f AS (SELECT c.source_id, c.id AS shot_id, m.motion AS a, m.stability AS b, c.technical_score AS t, c.aesthetic_score AS e FROM c JOIN m ON m.shot_id = c.id
          WHERE NOT isnan(m.motion) AND m.motion >= 0 AND m.motion < CAST('Infinity' AS DOUBLE) AND m.stability BETWEEN 0 AND 100 AND NOT isnan(m.stability)
          AND c.technical_score BETWEEN 0 AND 1 AND NOT isnan(c.technical_score) AND c.aesthetic_score BETWEEN 0 AND 1 AND NOT isnan(c.aesthetic_score)),
    g AS (SELECT source_id, count(*) AS n, max(a) AS a, max(b) AS b, max(t) AS t, max(e) AS e FROM f GROUP BY source_id HAVING count(*) >= 3)
"""


def _horner(table: tuple[float, ...], x: str) -> str:
    """A polynomial as SQL, evaluated like numpy's."""
    out = "0e0"
    for c in table:
        out = f"({out} * {x} + {c!r}::DOUBLE)"
    return out


_FOUR = {"a": "m.motion >= 0 AND m.motion < CAST('Infinity' AS DOUBLE) AND NOT isnan(m.motion)", "b": "m.stability BETWEEN 0 AND 100 AND NOT isnan(m.stability)", "t": "c.technical_score BETWEEN 0 AND 1 AND NOT isnan(c.technical_score)", "e": "c.aesthetic_score BETWEEN 0 AND 1 AND NOT isnan(c.aesthetic_score)"}
_NAMED = {"a": "m.motion", "b": "m.stability", "t": "c.technical_score", "e": "c.aesthetic_score"}
_P6_ALL = f"""
    WITH c AS {_CURRENT.format(table="shots", key="id")}, m AS {_CURRENT.format(table="scores", key="shot_id")},
    f AS (SELECT c.id AS shot_id, {", ".join(f"CASE WHEN {test} THEN {_NAMED[k]} + 0e0 END AS {k}" for k, test in _FOUR.items())} FROM c LEFT JOIN m ON m.shot_id = c.id),
    {", ".join(f"""{k}d AS (SELECT {k} AS v, count(*) AS n FROM f WHERE {k} IS NOT NULL GROUP BY {k}),
    {k}p AS (SELECT v, (sum(n) OVER (ORDER BY v) - n / 2e0) / (SELECT sum(n) FROM {k}d) AS p FROM {k}d),
    {k}q AS (SELECT v, p, p - 5e-1 AS q, 180625e-6 - (p - 5e-1) * (p - 5e-1) AS r, sqrt(-ln(least(p, 1 - p))) AS s FROM {k}p),
    {k}z AS (SELECT v, CASE WHEN abs(q) <= 425e-3 THEN q * {_horner(ranking._CENTRE[0], "r")} / {_horner(ranking._CENTRE[1], "r")}
        ELSE sign(q) * CASE WHEN s <= 5 THEN {_horner(ranking._FLANK[0], "(s - 16e-1)")} / {_horner(ranking._FLANK[1], "(s - 16e-1)")} ELSE {_horner(ranking._TAIL[0], "(s - 5e0)")} / {_horner(ranking._TAIL[1], "(s - 5e0)")} END END AS z FROM {k}q)""" for k in _FOUR)},
    w AS (SELECT shot_id, ({" + ".join(f"coalesce({k}z.z, 0e0)" for k in _FOUR)}) / nullif({" + ".join(f"CASE WHEN {k}z.z IS NULL THEN 0 ELSE 1 END" for k in _FOUR)}, 0) AS rating
        FROM f {" ".join(f"LEFT JOIN {k}z ON {k}z.v = f.{k}" for k in _FOUR)})
"""
SQL = {
    "p2_found": _P2 + "SELECT tag_a, tag_b FROM r WHERE n_ab * n >= 2 * n_a * n_b",
    "p2_pairs": _P2 + "SELECT tag_a, tag_b, n_ab, n_a, n_b, n, round(CAST(n_ab AS DOUBLE) / n_a * n / n_b, 6) AS lift FROM r",
    "p2_all_pairs": _P2_ALL + "SELECT tag_a, tag_b, n_ab, n_a, n_b, n, round(CAST(n_ab AS DOUBLE) / n_a * n / n_b, 6) AS lift FROM r",
    "p4_found": _P4 + "SELECT s.country, s.id AS shot_id FROM s JOIN k ON k.country = s.country WHERE s.x >= k.cutoff",
    "p4_cutoffs": _P4 + "SELECT t.country, CAST(t.keep_permille AS BIGINT) AS keep_permille, count(s.x) AS n, min(k.cutoff) AS cutoff, count(*) FILTER (WHERE s.x >= k.cutoff) AS kept "
    "FROM keep_targets AS t LEFT JOIN s ON s.country = t.country LEFT JOIN k ON k.country = t.country GROUP BY t.country, t.keep_permille",
    "p5_found": _P5 + "SELECT country, motion_class, score, 50 AS pct FROM q WHERE n >= 200 AND p50 < 0.42 UNION ALL SELECT country, motion_class, score, 95 FROM q WHERE n >= 200 AND p95 < 0.75",
    "p6_found": _P6 + "SELECT f.source_id, min(f.shot_id) AS shot_id FROM f JOIN g ON g.source_id = f.source_id AND f.a = g.a AND f.b = g.b AND f.t = g.t AND f.e = g.e GROUP BY f.source_id HAVING count(*) = 1",
    "p6_ranking": _P6_ALL + "SELECT row_number() OVER (ORDER BY rating DESC NULLS LAST, shot_id) AS position, shot_id, round(rating, 9) AS rating FROM w",
}
