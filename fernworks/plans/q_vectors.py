"""Nearest occupations: `embeddings` with ids under 100 as occupations (label: major group), the others as ads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import exposure, stats, vectors
from .registry import query, read

BASE = """
WITH o AS (SELECT vec_id AS onet_code, label, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id < 100),
a AS (SELECT vec_id AS ad_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id >= 100)
"""

CENTROIDS = """,
c AS (SELECT label, list(x ORDER BY pos) AS m FROM (SELECT label, pos, avg(x) AS x FROM
  (SELECT label, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM o) GROUP BY label, pos) GROUP BY label)
"""

PICK = """
SELECT ad_id, (rn - 1)::INT AS rank, onet_code, round(c, 6) AS cosine_score
FROM (SELECT *, row_number() OVER (PARTITION BY ad_id ORDER BY c DESC, onet_code) AS rn FROM s) WHERE rn <= 5
"""


def sides(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = read(spark, sf_dir, "embeddings")
    ads = e.filter("vec_id >= 100").select(F.col("vec_id").alias("ad_id"), "embedding")
    return ads, e.filter("vec_id < 100").select(F.col("vec_id").alias("onet_code"), "embedding", F.col("label").alias("major_group"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("cosine_score", F.round("cosine_score", 6))


TOPK = BASE + ", s AS (SELECT ad_id, onet_code, list_cosine_similarity(a.e, o.e) AS c FROM a CROSS JOIN o)" + PICK


@query(TOPK)
def h5_cosine_topk(spark, sf_dir):
    return _rounded(vectors.cosine_topk(*sides(spark, sf_dir), 5))


@query(TOPK)
def c15_cosine_topk_columns(spark, sf_dir):
    """The nearest pairs' cosines by dot and norm of columns."""
    ads, occupations = sides(spark, sf_dir)
    best = vectors.cosine_topk(ads, occupations, 5).drop("cosine_score")
    return _rounded(vectors.pair_cosines(best, ads, occupations).withColumnRenamed("cosine", "cosine_score"))


@query(
    BASE + CENTROIDS + """,
g AS (SELECT ad_id, label FROM (SELECT ad_id, c.label, row_number() OVER (PARTITION BY ad_id ORDER BY list_cosine_similarity(a.e, c.m) DESC, c.label) AS rn
  FROM a CROSS JOIN c) WHERE rn <= 3),
s AS (SELECT g.ad_id, onet_code, list_cosine_similarity(a.e, o.e) AS c FROM g JOIN a USING (ad_id) JOIN o ON o.label = g.label)""" + PICK
)
def h24_hierarchical_topk(spark, sf_dir):
    return _rounded(vectors.hierarchical_topk(*sides(spark, sf_dir), 3, 5))


@query(
    BASE + CENTROIDS + """,
f AS (SELECT ad_id, onet_code, o.label, row_number() OVER (PARTITION BY ad_id ORDER BY list_cosine_similarity(a.e, o.e) DESC, onet_code) AS rn FROM a CROSS JOIN o),
n AS (SELECT ad_id, c.label, row_number() OVER (PARTITION BY ad_id ORDER BY list_cosine_similarity(a.e, c.m) DESC, c.label) AS place FROM a CROSS JOIN c),
z AS (SELECT label, count(*) AS size FROM o GROUP BY label), g AS (SELECT unnest([1, 2, 3]) AS groups),
cv AS (SELECT groups, avg((place <= groups)::INT::DOUBLE) AS coverage, avg((place <= groups)::INT::DOUBLE) FILTER (rn = 1) AS agreement FROM g, (SELECT f.ad_id, rn, place FROM f JOIN n USING (ad_id, label) WHERE rn <= 5) GROUP BY groups),
rd AS (SELECT groups, 1 - avg(size) / (SELECT count(*) FROM o) AS reduction FROM (SELECT groups, ad_id, sum(size) AS size FROM g, n JOIN z USING (label) WHERE place <= groups GROUP BY groups, ad_id) GROUP BY groups)
SELECT groups, round(coverage, 6) AS coverage, round(reduction, 6) AS reduction, round(agreement, 6) AS top1_agreement FROM cv JOIN rd USING (groups)"""
)
def h24_hierarchical_report(spark, sf_dir):
    """What looking into 1, 2 or 3 groups finds, saves and keeps."""
    out = vectors.hierarchical_report(*sides(spark, sf_dir), [1, 2, 3], 5)
    return out.select("groups", *[F.round(c, 6).alias(c) for c in ("coverage", "reduction", "top1_agreement")])


@query(
    BASE + CENTROIDS + """,
s AS (SELECT ad_id, onet_code, list_cosine_similarity(
    list_transform(list_zip(a.e, m), lambda x: x[1] - x[2]), list_transform(list_zip(o.e, m), lambda x: x[1] - x[2])) AS c
  FROM o JOIN c USING (label) CROSS JOIN a)""" + PICK
)
def h25_centroid_residual_topk(spark, sf_dir):
    return _rounded(vectors.residual_topk(*sides(spark, sf_dir), 5))


@query(
    BASE + """,
t AS (SELECT a.label AS true_group, arg_max(o.label, list_cosine_similarity(a.e, o.e)) AS found_group FROM a CROSS JOIN o GROUP BY ad_id, a.label)
SELECT true_group, found_group, count(*) AS n FROM t GROUP BY ALL"""
)
def x_confusion_matrix(spark, sf_dir):
    ads, occupations = sides(spark, sf_dir)
    e = read(spark, sf_dir, "embeddings").select("vec_id", "label")
    best = vectors.cosine_topk(ads, occupations, 1)
    t = best.join(e.select(F.col("vec_id").alias("ad_id"), F.col("label").alias("true_group")), "ad_id").join(e.select(F.col("vec_id").alias("onet_code"), F.col("label").alias("found_group")), "onet_code")
    return stats.confusion(t, "true_group", "found_group")


FLAGSHIP = (
    BASE + """,
s AS (SELECT ad_id, onet_code, list_cosine_similarity(a.e, o.e) AS c FROM a CROSS JOIN o),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ad_id ORDER BY c DESC, onet_code) AS rn FROM s) WHERE rn <= 5),
m AS (SELECT ad_id, onet_code, ((ad_id * 7919 + onet_code * 104729) % 1000) / 1000.0::DOUBLE - 0.1 AS r FROM t),
k AS (SELECT *, min(r) OVER (PARTITION BY ad_id) AS lo, max(r) OVER (PARTITION BY ad_id) AS hi FROM m WHERE r >= 0),
w AS (SELECT ad_id, onet_code, exp(CASE WHEN hi > lo THEN (r - lo) / (hi - lo) ELSE 0.5 END / 0.7) AS w FROM k),
x AS (SELECT ad_id, sum(w * (onet_code % 97) / 97.0::DOUBLE) / sum(w) AS score FROM w GROUP BY ad_id)
SELECT a.label AS district, count(*) AS n_ads, count(x.ad_id)::INT AS n_ads_with_scores, round(avg(score), 6) AS score, 'district ' || a.label AS name
FROM a LEFT JOIN x USING (ad_id) GROUP BY a.label"""
)


@query(FLAGSHIP)
def flagship_district_exposure(spark, sf_dir):
    """Vectors to candidates, candidates to weights, weights to ads, ads to districts (the label)."""
    ads, occupations = sides(spark, sf_dir)
    best = vectors.cosine_topk(ads, occupations, 5)
    scored = best.withColumn("rerank_score", F.pmod(F.col("ad_id") * 7919 + F.col("onet_code") * 104729, F.lit(1000)) / 1000.0 - 0.1)
    scores = occupations.select("onet_code", (F.col("onet_code") % 97 / 97.0).alias("score"))
    place = read(spark, sf_dir, "embeddings").filter("vec_id >= 100").select(F.col("vec_id").alias("ad_id"), F.col("label").alias("district"))
    names = place.select("district").distinct().withColumn("name", F.concat(F.lit("district "), F.col("district").cast("string")))
    out = exposure.by_district(exposure.all_ads(ads, exposure.ad_exposure(scored, scores)), place, names)
    return out.withColumn("score", F.round("score", 6))
