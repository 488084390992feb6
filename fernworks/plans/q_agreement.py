"""Agreement of runs: the return flags of lineitem as runs, suppliers as ads, parts as candidates, the price as score."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import agreement
from ..sources.files import kept
from .registry import query, read

RUNS = """
WITH runs AS (SELECT l_returnflag AS run, l_suppkey AS ad, l_partkey AS code, max(l_extendedprice) / 100000 - 0.3::DOUBLE AS score FROM lineitem GROUP BY ALL),
com AS (SELECT ad FROM runs GROUP BY ad HAVING count(DISTINCT run) = (SELECT count(DISTINCT run) FROM runs)),
c AS (SELECT runs.* FROM runs JOIN com USING (ad)),
s AS (SELECT run, ad, count(*) AS n FROM c GROUP BY ALL),
sh AS (SELECT a.run AS ra, b.run AS rb, a.ad AS sad, count(*) AS k FROM c a JOIN c b ON a.ad = b.ad AND a.code = b.code AND a.run < b.run GROUP BY ALL),
o AS (SELECT x.run AS run_a, y.run AS run_b, x.ad, x.n AS na, y.n AS nb, coalesce(k, 0) AS k
  FROM s x JOIN s y ON x.ad = y.ad AND x.run < y.run LEFT JOIN sh ON ra = x.run AND rb = y.run AND sad = x.ad)
"""

J = ", j AS (SELECT run_a, run_b, avg(k / (na + nb - k)::DOUBLE) AS jaccard FROM o GROUP BY ALL)"


def runs(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("run"), F.col("l_suppkey").alias("ad"), F.col("l_partkey").alias("code")).agg((F.max("l_extendedprice") / 100000 - 0.3).alias("score"))


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query(RUNS + J + " SELECT run_a, run_b, round(jaccard, 6) AS jaccard FROM j")
def i1_jaccard(spark, sf_dir):
    return _rounded(agreement.jaccard(runs(spark, sf_dir)))


def _ruzicka_sql(score: str) -> str:
    return RUNS + f""", v AS ({score}),
f AS (SELECT coalesce(a.ad, b.ad) AS ad, p.ra2 AS run_a, p.rb2 AS run_b, coalesce(a.score, 0) AS x, coalesce(b.score, 0) AS y FROM (SELECT DISTINCT run_a AS ra2, run_b AS rb2, ad AS pad FROM o) p
  JOIN v a ON a.run = ra2 AND a.ad = pad LEFT JOIN v b ON b.run = rb2 AND b.ad = pad AND b.code = a.code
  UNION ALL SELECT b.ad, p.ra2, p.rb2, 0, b.score FROM (SELECT DISTINCT run_a AS ra2, run_b AS rb2, ad AS pad FROM o) p
  JOIN v b ON b.run = rb2 AND b.ad = pad WHERE NOT EXISTS (SELECT 1 FROM v a WHERE a.run = ra2 AND a.ad = pad AND a.code = b.code)),
g AS (SELECT run_a, run_b, ad, sum(least(x, y)) AS i, sum(greatest(x, y)) AS u FROM f GROUP BY ALL)
SELECT run_a, run_b, round(avg(CASE WHEN u > 0 THEN i / u ELSE 0 END), 6) AS ruzicka FROM g GROUP BY ALL"""


@query(_ruzicka_sql("SELECT run, ad, code, CASE WHEN t > 0 THEN greatest(score, 0) / t ELSE greatest(score, 0) END AS score FROM (SELECT *, sum(greatest(score, 0)) OVER (PARTITION BY run, ad) AS t FROM c)"))
def i2_ruzicka(spark, sf_dir):
    return _rounded(agreement.ruzicka(runs(spark, sf_dir)))


@query(_ruzicka_sql("SELECT * FROM c"))
def i3_raw_ruzicka(spark, sf_dir):
    return _rounded(agreement.raw_ruzicka(runs(spark, sf_dir)))


@query(_ruzicka_sql("SELECT run, ad, code, e / sum(e) OVER (PARTITION BY run, ad) AS score FROM (SELECT *, exp(score - max(score) OVER (PARTITION BY run, ad)) AS e FROM c)"))
def i4_softmax_ruzicka(spark, sf_dir):
    return _rounded(agreement.softmax_ruzicka(runs(spark, sf_dir)))


@query(
    RUNS + """, p AS (SELECT a.run AS run_a, b.run AS run_b, a.ad, a.score AS x, b.score AS y FROM c a JOIN c b ON a.ad = b.ad AND a.code = b.code AND a.run < b.run),
r AS (SELECT *, rank() OVER (PARTITION BY run_a, run_b, ad ORDER BY x) + (count(*) OVER (PARTITION BY run_a, run_b, ad, x) - 1) / 2.0::DOUBLE AS rx,
  rank() OVER (PARTITION BY run_a, run_b, ad ORDER BY y) + (count(*) OVER (PARTITION BY run_a, run_b, ad, y) - 1) / 2.0::DOUBLE AS ry FROM p),
q AS (SELECT run_a, run_b, ad, corr(rx, ry) AS rho FROM r GROUP BY ALL HAVING count(*) >= 3 AND count(DISTINCT x) > 1 AND count(DISTINCT y) > 1)
SELECT run_a, run_b, round(avg(rho), 6) AS spearman FROM q GROUP BY ALL"""
)
def i5_spearman(spark, sf_dir):
    return _rounded(agreement.spearman(runs(spark, sf_dir)))


@query(
    RUNS + """, t AS (SELECT run, ad, code AS top1 FROM (SELECT *, row_number() OVER (PARTITION BY run, ad ORDER BY score DESC, code) AS rn FROM runs) WHERE rn = 1 AND NOT (ad % 7 = 0 AND run <> 'A')),
f AS (SELECT s_suppkey AS ad, r.run, top1 FROM supplier CROSS JOIN (SELECT DISTINCT run FROM t) r LEFT JOIN t ON t.ad = s_suppkey AND t.run = r.run)
SELECT x.run AS run_a, y.run AS run_b, round(avg((x.top1 IS NOT DISTINCT FROM y.top1)::INT::DOUBLE), 6) AS top1 FROM f x JOIN f y ON x.ad = y.ad AND x.run < y.run GROUP BY ALL"""
)
def i6_top1(spark, sf_dir):
    tops = agreement.best(runs(spark, sf_dir)).filter("not (ad % 7 = 0 and run <> 'A')")
    return _rounded(agreement.top1(tops, read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ad"))))


@query(RUNS + "SELECT run_a, run_b, round(avg((k >= least(15, na, nb))::INT::DOUBLE), 6) AS at_least FROM o GROUP BY ALL")
def i7_at_least_n(spark, sf_dir):
    return _rounded(agreement.at_least(runs(spark, sf_dir), 15))


@query(RUNS + J + " SELECT round(avg(jaccard), 6) AS mean, round(median(jaccard), 6) AS median, round(min(jaccard), 6) AS min, round(max(jaccard), 6) AS max, round(stddev_pop(jaccard), 6) AS std FROM j")
def i8_matrix_summary(spark, sf_dir):
    return _rounded(agreement.matrix_summary(agreement.jaccard(runs(spark, sf_dir)), "jaccard"))


@query(RUNS + J + ", n AS (SELECT run_a AS r FROM j UNION SELECT run_b FROM j) SELECT run_a, run_b, round(jaccard, 6) AS jaccard FROM j UNION ALL SELECT run_b, run_a, round(jaccard, 6) FROM j UNION ALL SELECT r, r, 1.0::DOUBLE FROM n")
def i8_full_matrix(spark, sf_dir):
    return _rounded(agreement.full_matrix(agreement.jaccard(runs(spark, sf_dir)), "jaccard"))


@query(RUNS + J + " SELECT 3 AS size, round(avg(jaccard), 6) AS mean, 'A,N,R' AS runs FROM j UNION ALL (SELECT 2, round(jaccard, 6), run_a || ',' || run_b FROM j ORDER BY jaccard DESC, run_a, run_b LIMIT 1)")
def i9_best_subsets(spark, sf_dir):
    rows = agreement.best_subsets(agreement.jaccard(runs(spark, sf_dir)), "jaccard")
    return _rounded(spark.createDataFrame([(k, float(m), ",".join(n)) for k, m, n in rows], "size int, mean double, runs string"))


@query(RUNS + ", n AS (SELECT run, ad, count(*) AS n FROM runs GROUP BY ALL) SELECT run, round(avg(n), 1) AS mean_candidates, floor(median(n))::INT AS median_candidates FROM (SELECT run, ad, n FROM n) GROUP BY run")
def i10_selectivity(spark, sf_dir):
    return agreement.selectivity(runs(spark, sf_dir))


GROUPED = RUNS + """, v AS (SELECT run, ad, s_nationkey % 5 AS g, avg(score) AS v FROM runs JOIN supplier ON s_suppkey = ad GROUP BY ALL),
p AS (SELECT x.run AS run_a, y.run AS run_b, x.ad, x.g, x.v AS a, y.v AS b FROM v x JOIN v y ON x.ad = y.ad AND x.run < y.run)
"""


def grouped(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ad"), (F.col("s_nationkey") % 5).alias("group"))
    return runs(spark, sf_dir).groupBy("run", "ad").agg(F.avg("score").alias("value")).join(s, "ad")


@query(GROUPED + 'SELECT run_a, run_b, g AS "group", count(*) AS n, round(corr(a, b), 6) AS pearson FROM p GROUP BY ALL HAVING count(*) >= 15')
def i11_group_pearson(spark, sf_dir):
    return _rounded(agreement.vectors(grouped(spark, sf_dir), least=15).drop("mad"))


@query(
    GROUPED + """, t AS (SELECT run_a, run_b, corr(a, b) AS r FROM p GROUP BY ALL), gs AS (SELECT DISTINCT g AS lg FROM p),
l AS (SELECT run_a, run_b, lg, corr(a, b) AS r FROM p, gs WHERE g <> lg GROUP BY ALL HAVING count(*) >= 50)
SELECT run_a, run_b, lg AS "group", round(t.r - l.r, 6) AS delta FROM t JOIN l USING (run_a, run_b)"""
)
def i12_loo_delta(spark, sf_dir):
    return _rounded(agreement.leave_one_out(grouped(spark, sf_dir)))


TWO = RUNS.replace("FROM lineitem GROUP", "FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP")


@query(
    TWO + J + """, v AS (SELECT run, ad, avg(score) AS v FROM runs JOIN supplier ON s_suppkey = ad GROUP BY ALL),
m AS (SELECT count(*) AS n, corr(x.v, y.v) AS pearson, avg(abs(x.v - y.v)) AS mad FROM v x JOIN v y ON x.ad = y.ad AND x.run < y.run), g AS (SELECT max(v) - min(v) AS width FROM v),
w AS (SELECT run, ad, code, CASE WHEN t > 0 THEN greatest(score, 0) / t ELSE 0 END AS x FROM (SELECT *, sum(greatest(score, 0)) OVER (PARTITION BY run, ad) AS t FROM c)),
f AS (SELECT coalesce(a.ad, b.ad) AS ad, coalesce(a.x, 0) AS x, coalesce(b.x, 0) AS y FROM (SELECT * FROM w WHERE run = 'A') a FULL JOIN (SELECT * FROM w WHERE run = 'N') b ON a.ad = b.ad AND a.code = b.code),
z AS (SELECT avg(CASE WHEN u > 0 THEN i / u ELSE 0 END) AS ruzicka FROM (SELECT ad, sum(least(x, y)) AS i, sum(greatest(x, y)) AS u FROM f GROUP BY ad)),
q AS (SELECT a.ad, a.score AS x, b.score AS y FROM c a JOIN c b ON a.ad = b.ad AND a.code = b.code AND a.run < b.run),
k AS (SELECT *, rank() OVER (PARTITION BY ad ORDER BY x) + (count(*) OVER (PARTITION BY ad, x) - 1) / 2.0::DOUBLE AS rx, rank() OVER (PARTITION BY ad ORDER BY y) + (count(*) OVER (PARTITION BY ad, y) - 1) / 2.0::DOUBLE AS ry FROM q),
h AS (SELECT avg(rho) AS spearman FROM (SELECT corr(rx, ry) AS rho FROM k GROUP BY ad HAVING count(*) >= 3 AND count(DISTINCT x) > 1 AND count(DISTINCT y) > 1)),
t AS (SELECT run, ad, code AS top FROM (SELECT *, row_number() OVER (PARTITION BY run, ad ORDER BY score DESC, code) AS rn FROM c) WHERE rn = 1),
l AS (SELECT avg((x.top = y.top)::INT::DOUBLE) AS top1 FROM t x JOIN t y ON x.ad = y.ad AND x.run < y.run)
SELECT 'N' AS run, n, round(jaccard, 6) AS jaccard, round(top1, 6) AS top1, round(ruzicka, 6) AS ruzicka, round(spearman, 6) AS spearman, round(pearson, 6) AS pearson, round(mad, 6) AS mad, round(100.0::DOUBLE * mad / width, 6) AS mad_pct FROM m, g, j, z, h, l"""
)
def i13_benchmark_row(spark, sf_dir):
    """Top-1 is over the ads that both have. A measure that no ad has is null (NaN where SQL divides by zero); the row stays."""
    two = kept(runs(spark, sf_dir).filter("run in ('A', 'N')"))
    g = grouped(spark, sf_dir).drop("group").filter("run in ('A', 'N')")
    both = agreement.common(two)
    row = agreement.jaccard(two).crossJoin(g.agg((F.max("value") - F.min("value")).alias("range")))
    for other in (agreement.vectors(g, least=1), agreement.top1(agreement.best(both), both.select("ad").distinct()), agreement.ruzicka(two), agreement.spearman(two)):
        row = row.join(other, ["run_a", "run_b"], "left")
    nan = F.lit(float("nan"))
    pearson = F.when(F.col("n") > 0, F.coalesce("pearson", nan)).alias("pearson")
    pct = F.when(F.col("range") > 0, 100.0 * F.col("mad") / F.col("range")).when(F.col("n") > 0, nan).alias("mad_pct")
    n = F.coalesce("n", F.lit(0)).alias("n")
    return _rounded(row.select(F.lit("N").alias("run"), n, "jaccard", "top1", "ruzicka", "spearman", pearson, "mad", pct))


@query(RUNS + J + ", l AS (SELECT run_a AS run, jaccard FROM j UNION ALL SELECT run_b, jaccard FROM j) SELECT CASE WHEN run = 'A' THEN 'llm' ELSE 'reranker' END AS dimension, count(*) AS n, round(avg(jaccard), 6) AS mean, round(min(jaccard), 6) AS min, round(max(jaccard), 6) AS max FROM l GROUP BY 1")
def i14_mean_by_dimension(spark, sf_dir):
    j = agreement.jaccard(runs(spark, sf_dir))
    long = j.select(F.col("run_a").alias("run"), "jaccard").union(j.select("run_b", "jaccard"))
    return _rounded(long.groupBy(F.when(F.col("run") == "A", "llm").otherwise("reranker").alias("dimension")).agg(F.count(F.lit(1)).alias("n"), F.avg("jaccard").alias("mean"), F.min("jaccard").alias("min"), F.max("jaccard").alias("max")))


@query(
    """WITH n AS (SELECT 'val__d__' || l || '__' || e || '__' || r AS run, l, e, r FROM (SELECT DISTINCT l_returnflag AS l, l_linestatus AS e, (l_linenumber % 2)::VARCHAR AS r FROM lineitem) WHERE l <> 'R' OR e = 'O'),
a AS (SELECT 'llm' AS arm, e || ' + ' || r AS fixed, run FROM n UNION ALL SELECT 'embedding', l || ' + ' || r, run FROM n UNION ALL SELECT 'reranker', l || ' + ' || e, run FROM n)
SELECT arm, fixed, run FROM a WHERE (arm, fixed) IN (SELECT (arm, fixed) FROM a GROUP BY arm, fixed HAVING count(*) >= 2)"""
)
def i15_arms(spark, sf_dir):
    n = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("l"), F.col("l_linestatus").alias("e"), (F.col("l_linenumber") % 2).cast("string").alias("r")).distinct().filter("l <> 'R' or e = 'O'")
    return agreement.arms(n.select(F.concat_ws("__", F.lit("val"), F.lit("d"), "l", "e", "r").alias("run"))).select("arm", "fixed", "run")


@query(RUNS + J + ", b AS (SELECT run_a, run_b, jaccard FROM j ORDER BY jaccard DESC, run_a, run_b LIMIT 1) SELECT round(b.jaccard - (SELECT avg(jaccard) FROM j), 6) AS improvement, (SELECT min(run) FROM runs WHERE run NOT IN (b.run_a, b.run_b)) AS dropped FROM b")
def i16_pruned_subset(spark, sf_dir):
    gain, out = agreement.pruned_subset(agreement.jaccard(runs(spark, sf_dir)), "jaccard")
    return _rounded(spark.createDataFrame([(float(gain), ",".join(out))], "improvement double, dropped string"))


RANKED = RUNS + ", k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run, ad ORDER BY score DESC, code) AS rn FROM runs) WHERE rn <= 3)"


@query(
    RANKED + """, x AS (SELECT ad, max((code % 5) + 1) FILTER (run = 'A') AS a, max((code % 5) + 1) FILTER (run = 'N') AS b FROM k GROUP BY ad HAVING a IS NOT NULL AND b IS NOT NULL)
SELECT count(*) FILTER (a > b) AS wins_a, count(*) FILTER (a < b) AS wins_b, count(*) FILTER (a = b) AS ties FROM x"""
)
def i18_head_to_head(spark, sf_dir):
    from pyspark.sql.window import Window

    r = runs(spark, sf_dir)
    k = r.withColumn("rn", F.row_number().over(Window.partitionBy("run", "ad").orderBy(F.desc("score"), "code"))).filter("rn <= 3")
    ratings = r.select("ad", "code", (F.col("code") % 5 + 1).alias("rating")).distinct()
    return agreement.head_to_head(k.filter("run = 'A'").select("ad", "code"), k.filter("run = 'N'").select("ad", "code"), ratings)


@query(
    RUNS + """, f AS (SELECT run, ad, code FROM runs), n AS (SELECT run, ad, count(*) AS n FROM f GROUP BY ALL),
pr AS (SELECT DISTINCT a.run AS run_a, b.run AS run_b FROM f a, (SELECT DISTINCT run FROM f) b WHERE a.run < b.run),
t AS (SELECT run_a, run_b, ad, sum(n) AS t FROM pr JOIN n ON run IN (run_a, run_b) GROUP BY ALL),
h AS (SELECT a.run AS run_a, b.run AS run_b, a.ad, count(*) AS k FROM f a JOIN f b ON a.ad = b.ad AND a.code = b.code AND a.run < b.run GROUP BY ALL)
SELECT run_a, run_b, round(avg(coalesce(k, 0) / (t - coalesce(k, 0))::DOUBLE), 6) AS shared_fraction FROM t LEFT JOIN h USING (run_a, run_b, ad) GROUP BY ALL"""
)
def i19_shared_fraction(spark, sf_dir):
    return _rounded(agreement.shared_fraction(runs(spark, sf_dir).select("run", "ad", "code")))


@query(
    RUNS + """, k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run, ad ORDER BY score DESC, code) AS rn FROM c) WHERE rn <= 3),
g AS (SELECT run, ad, arg_min(code, rn) AS top, string_agg(code::VARCHAR, ',' ORDER BY code) AS st FROM k GROUP BY ALL)
SELECT x.run, round(avg((x.top = y.top)::INT::DOUBLE), 6) AS top1, round(avg((x.st = y.st)::INT::DOUBLE), 6) AS topk, round(avg((x.top // 100 = y.top // 100)::INT::DOUBLE), 6) AS group_agreement
FROM g x JOIN g y ON x.ad = y.ad AND y.run = 'A' WHERE x.run <> 'A' GROUP BY x.run"""
)
def i20_variant_agreement(spark, sf_dir):
    return _rounded(agreement.variant_agreement(runs(spark, sf_dir), "A", 3, F.floor(F.col("top") / 100)))


@query(
    RUNS + """, m AS (SELECT ad, code FROM runs GROUP BY ALL HAVING count(DISTINCT run) > 1.5),
h AS (SELECT run, count(m.ad) AS tp, count(*) AS n FROM runs LEFT JOIN m USING (ad, code) GROUP BY run),
pr AS (SELECT run, tp / n::DOUBLE AS p, tp / (SELECT count(*) FROM m)::DOUBLE AS r FROM h)
SELECT run, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM pr"""
)
def d26_majority_f1(spark, sf_dir):
    return _rounded(agreement.against_majority(runs(spark, sf_dir)))


@query(RUNS + "SELECT ad, count(*) AS n FROM c GROUP BY ad")
def f3_common_ads(spark, sf_dir):
    return agreement.common(runs(spark, sf_dir)).groupBy("ad").agg(F.count(F.lit(1)).alias("n"))
