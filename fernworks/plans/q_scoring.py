"""Occupation scores. lineitem stands in for ratings and task labels, its order or supplier for the occupation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scoring
from .registry import query, read


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, rn FROM (SELECT l_orderkey, l_linenumber, l_partkey,
row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey)::INT AS rn FROM lineitem) WHERE rn <= 3"""
)
def e1_topn_per_group(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").withColumn("tie", F.struct("l_linenumber", "l_partkey"))
    return scoring.top_per_group(li, "l_orderkey", "l_extendedprice", "tie", 3).select("l_orderkey", "l_linenumber", "l_partkey", "rn")


@query(
    """SELECT l_orderkey, string_agg(p_name, '; ' ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) AS tasks
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey"""
)
def d7_ordered_list(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey")).withColumn("down", -F.col("l_extendedprice"))
    return li.groupBy("l_orderkey").agg(F.array_join(scoring.ordered_list("p_name", "down", "l_linenumber", "l_partkey"), "; ").alias("tasks"))


@query("SELECT l_orderkey, string_agg(DISTINCT l_shipdate::DATE::VARCHAR, ',' ORDER BY l_shipdate::DATE::VARCHAR) AS days FROM lineitem GROUP BY l_orderkey")
def d8_set(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set(F.date_format("l_shipdate", "yyyy-MM-dd"))), ",").alias("days"))


@query(
    """WITH t AS (SELECT l_orderkey, p_name, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey) AS rn
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, max(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL) JOIN part ON p_partkey = l_partkey)
SELECT o_orderkey AS onet_code, o_orderpriority AS title, string_agg(p_name, '; ' ORDER BY rn) AS tasks, coalesce(any_value(titles), '') AS titles
FROM orders JOIN t ON t.l_orderkey = o_orderkey LEFT JOIN (SELECT l_orderkey, string_agg('Supplier ' || l_suppkey, '; ' ORDER BY 'Supplier ' || l_suppkey) AS titles FROM
  (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1) a ON a.l_orderkey = o_orderkey
WHERE rn <= 4 AND o_orderpriority <> '5-LOW' GROUP BY ALL"""
)
def h2_targets(spark, sf_dir):
    """Orders as occupations, their parts as tasks; the suppliers of what was returned are titles, so many have none."""
    li = read(spark, sf_dir, "lineitem")
    key = F.struct("l_linenumber", "l_partkey")
    one = li.groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(F.max("l_quantity").alias("q")).withColumn("task_id", key)
    occupations = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("onet_code"), F.col("o_orderpriority").alias("title"))
    part = read(spark, sf_dir, "part")
    tasks = one.join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("onet_code"), "task_id", F.col("p_name").alias("task"))
    ratings = one.select(F.col("l_orderkey").alias("onet_code"), "task_id", F.lit("IM").alias("scale"), F.col("q").cast("string").alias("value"))
    titles = li.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("onet_code"), F.concat(F.lit("Supplier "), F.col("l_suppkey")).alias("alternate_title")).distinct()
    out = scoring.targets(occupations, tasks, ratings, titles, top_n=4, leave_out=("5-LOW",))
    return out.select("onet_code", "title", F.array_join("top_tasks", "; ").alias("tasks"), F.array_join("alternate_titles", "; ").alias("titles"))


TASKS = "SELECT l_orderkey AS code, (l_linenumber % 3) AS x, CASE WHEN l_orderkey % 11 = 0 THEN 0 ELSE l_quantity END AS w, l_discount AS c FROM lineitem"


def labels(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("onet_code"), (F.col("l_linenumber") % 3).alias("exposure"), F.when(F.col("l_orderkey") % 11 == 0, 0.0).otherwise(F.col("l_quantity")).alias("task_importance"), F.col("l_discount").alias("confidence"))


@query(
    f"""SELECT code AS onet_code, round(avg(x::DOUBLE) / 2, 6) AS task_exposure_mean, round(coalesce(sum(x * w) / nullif(sum(w), 0), avg(x::DOUBLE)) / 2, 6) AS task_exposure_weighted,
round(avg(c), 6) AS confidence FROM ({TASKS}) GROUP BY code"""
)
def d6_weighted_mean(spark, sf_dir):
    t = scoring.task_exposure(labels(spark, sf_dir))
    return t.select("onet_code", *[F.round(c, 6).alias(c) for c in ("task_exposure_mean", "task_exposure_weighted", "confidence")])


@query(
    f"""SELECT code AS onet_code, {', '.join(f'count(*) FILTER (x = {k}) AS n_{k}, round(100.0::DOUBLE * count(*) FILTER (x = {k}) / count(*), 6) AS pct_{k}' for k in (0, 1, 2))},
round(count(*) FILTER (x >= 1)::DOUBLE / count(*), 6) AS binary_exposure FROM ({TASKS}) GROUP BY code"""
)
def d11_level_counts(spark, sf_dir):
    t = scoring.task_exposure(labels(spark, sf_dir))
    return t.select("onet_code", "n_0", "n_1", "n_2", *[F.round(c, 6).alias(c) for c in ("pct_0", "pct_1", "pct_2", "binary_exposure")])


@query(
    """WITH r AS (SELECT l_suppkey AS code, CASE l_linenumber % 3 WHEN 0 THEN 'work_context' WHEN 1 THEN 'gwas' ELSE 'skills' END AS source, l_partkey % 7 AS element,
    CASE WHEN l_linenumber % 3 = 0 THEN 'CX' WHEN l_returnflag = 'A' THEN 'IM' ELSE 'LV' END AS scale, CASE WHEN l_linenumber % 5 = 4 THEN NULL ELSE l_quantity / 8 END AS v FROM lineitem),
e AS (SELECT *, CASE WHEN element IN (0, 1, 2) THEN 'creative' WHEN element IN (3, 4) THEN 'emotional' ELSE 'physical' END AS dim,
    CASE WHEN v IS NOT NULL THEN least(greatest(CASE scale WHEN 'LV' THEN v / 7 ELSE (v - 1) / 4 END, 0), 1) END AS x FROM r),
w AS (SELECT dim, source, code, avg(x) AS score FROM e WHERE source = 'work_context' GROUP BY ALL),
i AS (SELECT dim, source, code, element, avg(x) AS im FROM e WHERE source <> 'work_context' AND scale = 'IM' GROUP BY ALL),
l AS (SELECT dim, source, code, element, avg(x) AS lv FROM e WHERE source <> 'work_context' AND scale = 'LV' GROUP BY ALL),
t AS (SELECT dim, source, code, avg((im + coalesce(lv, 0)) / 2) AS score FROM i LEFT JOIN l USING (dim, source, code, element) GROUP BY ALL),
d AS (SELECT code, dim, avg(score) AS s FROM (SELECT * FROM w UNION ALL SELECT * FROM t) GROUP BY ALL),
p AS (SELECT code, max(s) FILTER (dim = 'creative') AS c, max(s) FILTER (dim = 'emotional') AS e, max(s) FILTER (dim = 'physical') AS p FROM d GROUP BY code)
SELECT s_suppkey AS onet_code, round(c, 6) AS presence_creative, round(e, 6) AS presence_emotional, round(p, 6) AS presence_physical,
  round((coalesce(c, 0) + coalesce(e, 0) + coalesce(p, 0)) / nullif((c IS NOT NULL)::INT + (e IS NOT NULL)::INT + (p IS NOT NULL)::INT, 0), 6) AS presence_composite
FROM supplier LEFT JOIN p ON code = s_suppkey"""
)
def h11_presence(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber") % 3
    ratings = li.select(
        F.when(n == 0, "work_context").when(n == 1, "gwas").otherwise("skills").alias("source"), F.col("l_suppkey").alias("onet_code"), (F.col("l_partkey") % 7).cast("string").alias("element_id"),
        F.when(n == 0, "CX").when(F.col("l_returnflag") == "A", "IM").otherwise("LV").alias("scale"), F.when(F.col("l_linenumber") % 5 == 4, F.lit("n/a")).otherwise((F.col("l_quantity") / 8).cast("string")).alias("value"),
    )
    ids = {"creative": ("0", "1", "2"), "emotional": ("3", "4"), "physical": ("5", "6")}
    elements = scoring.element_table(spark, {d: {s: e for s in ("work_context", "gwas", "skills")} for d, e in ids.items()})
    out = scoring.presence(ratings, elements, read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("onet_code")))
    return out.select("onet_code", *[F.round(c, 6).alias(c) for c in out.columns if c != "onet_code"])


@query(
    f"""WITH p(application, progress) AS (VALUES {', '.join(f"('{a}', {x}::DOUBLE)" for a, x in zip(scoring.APPLICATIONS, scoring.PROGRESS['baseline_2025'], strict=True))}),
n AS (SELECT application, progress, row_number() OVER (ORDER BY application) AS j FROM p),
m AS (SELECT a.range AS ability, application, progress, ((a.range * 31 + j * 17) % 100) / 100.0::DOUBLE AS r FROM range(0, 13) a, n),
x AS (SELECT ability, sum(r * progress) / sum(progress) AS e FROM m WHERE progress > 0 GROUP BY ability),
a AS (SELECT l_suppkey AS code, l_partkey % 13 AS ability, CASE WHEN l_returnflag = 'A' THEN 'IM' ELSE 'LV' END AS scale, l_quantity / 6 AS v, l_orderkey * 1000 + l_linenumber * 100 + l_partkey % 100 AS pos FROM lineitem),
f AS (SELECT code, ability, scale, arg_min(v, pos) AS v FROM a GROUP BY ALL),
w AS (SELECT code, ability, 0.5 * coalesce(least(greatest(max(v) FILTER (scale = 'IM') / 5, 0), 1), 0) + 0.5 * coalesce(least(greatest(max(v) FILTER (scale = 'LV') / 7, 0), 1), 0) AS w FROM f GROUP BY ALL)
SELECT code AS onet_code, round(sum(w * e) / sum(w), 6) AS felten_score FROM w JOIN x USING (ability) GROUP BY code"""
)
def h12_felten(spark, sf_dir):
    progress = spark.createDataFrame(list(zip(scoring.APPLICATIONS, scoring.PROGRESS["baseline_2025"], strict=True)), "application string, progress double")
    matrix = spark.createDataFrame([(a, app, ((a * 31 + j * 17) % 100) / 100.0) for a in range(13) for j, app in enumerate(sorted(scoring.APPLICATIONS), 1)], "ability long, application string, relation double")
    pos = F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 100 + F.col("l_partkey") % 100
    ratings = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("onet_code"), (F.col("l_partkey") % 13).alias("ability"), F.when(F.col("l_returnflag") == "A", "IM").otherwise("LV").alias("scale"), (F.col("l_quantity") / 6).alias("value"), pos.alias("pos"))
    out = scoring.felten(ratings, scoring.ability_exposure(matrix, progress))
    return out.withColumn("felten_score", F.round("felten_score", 6))


def three(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    key = F.col("p_partkey").alias("onet_code")
    return {"size": p.select(key, (F.col("p_size") / 50.0).alias("size_score")), "digit": p.select(key, (F.col("p_partkey") % 10 / 9.0).alias("digit_score")), "price": p.select(key, (F.col("p_retailprice") / 1000.0).alias("price_score"))}


@query("SELECT p_partkey AS onet_code, (p_partkey % 10) / 9.0::DOUBLE AS digit_score, p_retailprice / 1000.0::DOUBLE AS price_score, p_size / 50.0::DOUBLE AS size_score FROM part")
def c6_combine_scores(spark, sf_dir):
    return scoring.combine(three(spark, sf_dir))


@query(
    """SELECT count(*) AS n_rows, count(*) FILTER (k IS NULL) AS null_keys, count(k) - count(DISTINCT k) AS repeated_keys,
count(*) FILTER (v IS NULL) AS missing_v, count(*) FILTER (v < -0.001 OR v > 1.001) AS outside_v
FROM (SELECT nullif(p_partkey % 100, 7) AS k, CASE WHEN p_size < 3 THEN NULL ELSE p_size / 49.0::DOUBLE END AS v FROM part)"""
)
def k1_validate(spark, sf_dir):
    k = F.col("p_partkey") % 100
    s = read(spark, sf_dir, "part").select(F.when(k != 7, k).alias("onet_code"), F.when(F.col("p_size") >= 3, F.col("p_size") / 49.0).alias("v"))
    return scoring.violations(s)


@query("SELECT p_partkey % 50 AS key, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def f9_repeated_keys(spark, sf_dir):
    return read(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 50).alias("key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
