"""Exposure of ads: orders as ads, parts as occupations, lineitem's discount less 0.02 as the match score."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import exposure
from .registry import query, read

BASE = """
WITH m AS (SELECT l_orderkey AS ad_id, l_partkey AS code, l_discount - 0.02::DOUBLE AS s FROM lineitem WHERE l_discount - 0.02::DOUBLE >= 0),
j AS (SELECT m.*, p_size / 50.0::DOUBLE AS s1, (p_partkey % 97) / 97.0::DOUBLE AS s2 FROM m JOIN part ON code = p_partkey WHERE p_partkey % 10 <> 0),
k AS (SELECT *, min(s) OVER w AS lo, max(s) OVER w AS hi FROM j WINDOW w AS (PARTITION BY ad_id)),
e AS (SELECT *, exp(CASE WHEN hi > lo THEN (s - lo) / (hi - lo) ELSE 0.5 END / 0.7) AS w FROM k),
x AS (SELECT ad_id, count(*)::INT AS n_matches, sum(w * s1) / sum(w) AS s1, sum(w * s2) / sum(w) AS s2 FROM e GROUP BY ad_id)
"""


def exposed(spark, sf_dir):
    matches = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("ad_id"), F.col("l_partkey").alias("onet_code"), (F.col("l_discount") - 0.02).alias("rerank_score"))
    scores = read(spark, sf_dir, "part").filter("p_partkey % 10 <> 0").select(F.col("p_partkey").alias("onet_code"), (F.col("p_size") / 50.0).alias("s1"), (F.col("p_partkey") % 97 / 97.0).alias("s2"))
    return exposure.ad_exposure(matches, scores)


def ads(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ad_id"), F.col("o_custkey").alias("c_custkey"))


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(BASE + "SELECT ad_id, n_matches, round(s1, 6) AS s1, round(s2, 6) AS s2 FROM x")
def h9_ad_exposure(spark, sf_dir):
    return _rounded(exposed(spark, sf_dir), "s1", "s2")


@query(
    BASE + """SELECT o_orderkey AS ad_id, coalesce(n_matches, 0)::INT AS n_matches, round(s1, 6) AS s1, round(s2, 6) AS s2,
CASE WHEN n_matches IS NULL THEN 'no matched scores' END AS error FROM orders LEFT JOIN x ON ad_id = o_orderkey"""
)
def h9_all_ads_with_error(spark, sf_dir):
    return _rounded(exposure.all_ads(ads(spark, sf_dir), exposed(spark, sf_dir)), "s1", "s2")


DISTRICTS = BASE + """, g AS (SELECT c_nationkey AS district, count(*) AS n_ads, count(x.ad_id)::INT AS n_ads_with_scores, avg(s1) AS s1, avg(s2) AS s2
FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN x ON ad_id = o_orderkey GROUP BY c_nationkey)
"""


def districts(spark, sf_dir):
    place = ads(spark, sf_dir).join(read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("district")), "c_custkey").select("ad_id", "district")
    names = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("district"), F.col("n_name").alias("name"))
    return exposure.by_district(exposure.all_ads(ads(spark, sf_dir), exposed(spark, sf_dir)), place, names)


@query(DISTRICTS + "SELECT district, n_ads, n_ads_with_scores, round(s1, 6) AS s1, round(s2, 6) AS s2, n_name AS name FROM g LEFT JOIN nation ON n_nationkey = district")
def h10_aggregate_geo(spark, sf_dir):
    return _rounded(districts(spark, sf_dir), "s1", "s2")


@query(
    DISTRICTS + """, n AS (SELECT district, (s1 - min(s1) OVER ()) / (max(s1) OVER () - min(s1) OVER ()) AS e, (s2 - min(s2) OVER ()) / (max(s2) OVER () - min(s2) OVER ()) AS p FROM g)
SELECT district, round(e * (1 - p), 6) AS vulnerability FROM n"""
)
def h21_vulnerability(spark, sf_dir):
    return _rounded(exposure.vulnerability(districts(spark, sf_dir), "s1", "s2").select("district", "vulnerability"), "vulnerability")


@query(
    DISTRICTS + """, c AS (SELECT quantile_cont(s1, 0.5) AS m1, quantile_cont(s2, 0.5) AS m2 FROM g)
SELECT district, CASE WHEN s1 >= m1 AND s2 >= m2 THEN 'augmented' WHEN s1 >= m1 THEN 'vulnerable' WHEN s2 >= m2 THEN 'resilient' ELSE 'unchanged' END AS quadrant FROM g, c"""
)
def h22_quadrants(spark, sf_dir):
    return exposure.quadrants(districts(spark, sf_dir), "s1", "s2").select("district", "quadrant")


@query("SELECT event_type, round(sum(value), 3) AS seconds, round(sum(value) / 3600, 6) AS hours, round(sum(value) / 3600 * 0.25, 6) AS node_hours FROM events GROUP BY event_type")
def h26_cost_model(spark, sf_dir):
    from .cost import node_hours

    s = read(spark, sf_dir, "events").groupBy("event_type").agg(F.sum("value").alias("s"))
    hours = F.col("s") / 3600
    return s.select("event_type", F.round("s", 3).alias("seconds"), F.round(hours, 6).alias("hours"), F.round(node_hours(hours), 6).alias("node_hours"))
