"""Descriptive statistics."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import stats
from ..operators.vectors import top
from .registry import query, read


def _rounded(df, places=6):
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("SELECT round(quantile_cont(o_totalprice, 0.02), 4) AS q02, round(median(o_totalprice), 4) AS q50, round(quantile_cont(o_totalprice, 0.25), 4) AS q25, round(quantile_cont(o_totalprice, 0.98), 4) AS q98 FROM orders")
def d19_quantiles(spark, sf_dir):
    q = stats.quantiles(read(spark, sf_dir, "orders"), "o_totalprice", [0.02, 0.5, 0.25, 0.98])
    return _rounded(spark.createDataFrame([tuple(q)], "q02 double, q50 double, q25 double, q98 double"), 4)


@query(
    """SELECT count(o_totalprice) AS n, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std, round(min(o_totalprice), 4) AS min, round(quantile_cont(o_totalprice, 0.25), 4) AS q25,
round(median(o_totalprice), 4) AS q50, round(quantile_cont(o_totalprice, 0.75), 4) AS q75, round(max(o_totalprice), 4) AS max FROM orders"""
)
def d20_summary(spark, sf_dir):
    return _rounded(stats.summary(read(spark, sf_dir, "orders"), "o_totalprice"), 4)


@query(
    """WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT least(floor((o_totalprice - lo) / ((hi - lo) / 40)), 39)::INT AS bin, count(*) AS n FROM orders, e GROUP BY 1"""
)
def d28_histogram(spark, sf_dir):
    return stats.histogram(read(spark, sf_dir, "orders"), "o_totalprice", 40)


@query(
    """WITH s AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, count(*) AS n, stddev_samp(c_acctbal) * pow(count(*), -0.2) AS h FROM customer),
g AS (SELECT range::INT AS point, lo + (hi - lo) * range / 199 AS x, n, h FROM range(0, 200), s)
SELECT point, round(any_value(x), 4) AS x, round(sum(exp(-0.5 * pow((x - c_acctbal) / h, 2))) / (any_value(n) * any_value(h) * 2.5066282746310002), 9) AS density FROM g, customer GROUP BY point"""
)
def d29_kde(spark, sf_dir):
    k = stats.kde(read(spark, sf_dir, "customer"), "c_acctbal")
    return k.select("point", F.round("x", 4).alias("x"), F.round("density", 9).alias("density"))


@query("SELECT round(corr(l_quantity, l_extendedprice), 6) AS pearson FROM lineitem")
def d21_pearson(spark, sf_dir):
    return _rounded(read(spark, sf_dir, "lineitem").agg(F.corr("l_quantity", "l_extendedprice").alias("pearson")))


@query(
    """WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0::DOUBLE AS a,
  rank() OVER (ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_discount) - 1) / 2.0::DOUBLE AS b FROM lineitem) SELECT round(corr(a, b), 6) AS spearman FROM r"""
)
def d22_spearman(spark, sf_dir):
    return _rounded(stats.spearman(read(spark, sf_dir, "lineitem"), "l_quantity", "l_discount"))


CORR = ("l_discount", "l_extendedprice", "l_quantity", "l_tax")


@query(" UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS pearson FROM lineitem" for i, a in enumerate(CORR) for b in CORR[i + 1 :]))
def d23_corr_matrix(spark, sf_dir):
    return _rounded(stats.correlations(read(spark, sf_dir, "lineitem"), list(CORR)))


@query("SELECT substr(p_brand, 1, 7) AS prefix, count(*) AS n, round(avg(p_retailprice), 4) AS mean_price, count(DISTINCT p_type) AS n_types FROM part GROUP BY 1")
def d34_prefix_group(spark, sf_dir):
    return _rounded(read(spark, sf_dir, "part").groupBy(F.substring("p_brand", 1, 7).alias("prefix")).agg(F.count(F.lit(1)).alias("n"), F.avg("p_retailprice").alias("mean_price"), F.count_distinct("p_type").alias("n_types")), 4)


@query(
    """WITH r AS (SELECT p_partkey, rank() OVER (ORDER BY p_retailprice DESC) + (count(*) OVER (PARTITION BY p_retailprice) - 1) / 2.0::DOUBLE AS rank_a,
  rank() OVER (ORDER BY p_size DESC) + (count(*) OVER (PARTITION BY p_size) - 1) / 2.0::DOUBLE AS rank_b FROM part)
SELECT *, abs(rank_a - rank_b) AS change FROM r ORDER BY change DESC, p_partkey LIMIT 20"""
)
def e7_rank_change(spark, sf_dir):
    return stats.rank_change(read(spark, sf_dir, "part"), "p_partkey", "p_retailprice", "p_size", 20)


@query(
    """(SELECT 'largest' AS side, c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10)
UNION ALL (SELECT 'smallest positive', c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 ORDER BY c_acctbal, c_custkey LIMIT 10)"""
)
def g6_largest_smallest(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    most = c.orderBy(F.desc("c_acctbal"), "c_custkey").limit(10).withColumn("side", F.lit("largest"))
    return most.unionByName(c.filter("c_acctbal > 0").orderBy("c_acctbal", "c_custkey").limit(10).withColumn("side", F.lit("smallest positive")))


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer")
def e11_full_rank(spark, sf_dir):
    """A full ranking is one order over all rows; cells of the value keep it out of one task."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").withColumn("cell", F.floor(F.col("c_acctbal") / 100))
    above = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    start = c.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).withColumn("start", F.coalesce(F.sum("n").over(above), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy("cell").orderBy(F.desc("c_acctbal"), "c_custkey"))
    return c.join(start, "cell").select("c_custkey", (F.col("start") + inside).cast("long").alias("place"))


@query(
    """WITH n AS (SELECT c_nationkey, count(*) AS w, avg(o_totalprice) AS v FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_nationkey)
SELECT left(n_name, 8) AS prefix, round(sum(v * w) / sum(w), 4) AS v FROM n JOIN nation ON n_nationkey = c_nationkey WHERE n_name LIKE 'NATION_1%' GROUP BY 1"""
)
def d17_prefix_weighted(spark, sf_dir):
    o = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    n = o.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("w"), F.avg("o_totalprice").alias("v")).join(read(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    n = n.filter(F.col("n_name").startswith("NATION_1")).withColumn("prefix", F.substring("n_name", 1, 8))
    return _rounded(stats.weighted_average(n, "prefix", "v", "w"), 4)


@query(
    """SELECT o_orderpriority AS g, count(*) AS n, round(avg(o_totalprice), 4) AS mean, round(coalesce(stddev_samp(o_totalprice), 0), 4) AS std,
min(o_totalprice) AS min, max(o_totalprice) AS max, round(max(o_totalprice) - min(o_totalprice), 4) AS spread FROM orders GROUP BY 1"""
)
def d13_group_statistics(spark, sf_dir):
    p = "o_totalprice"
    out = read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("g")).agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean"), F.coalesce(F.stddev_samp(p), F.lit(0.0)).alias("std"), F.min(p).alias("min"), F.max(p).alias("max"), (F.max(p) - F.min(p)).alias("spread"))
    return out.select("g", "n", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", "max", F.round("spread", 4).alias("spread"))


@query("SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1")
def d10_pivot(spark, sf_dir):
    out = read(spark, sf_dir, "orders").groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1)))
    return out.select("o_custkey", *[F.coalesce(F.col(k), F.lit(0)).alias(k.lower()) for k in ("F", "O", "P")])


@query("SELECT o_custkey, arg_min(o_totalprice, o_orderkey) AS first_price FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def d9_first_present(spark, sf_dir):
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return read(spark, sf_dir, "orders").withColumn("v", price).filter("v is not null").groupBy("o_custkey").agg(F.min_by("v", "o_orderkey").alias("first_price"))


@query(
    """WITH n AS (SELECT event_type AS t, count(*) AS n FROM events GROUP BY 1) SELECT t AS event_type, n, round(100.0::DOUBLE * n / sum(n) OVER (), 6) AS pct FROM n"""
)
def d33_share(spark, sf_dir):
    n = read(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return n.crossJoin(n.agg(F.sum("n").alias("all"))).select("event_type", "n", F.round(100.0 * F.col("n") / F.col("all"), 6).alias("pct"))


@query(
    """SELECT s_suppkey, round((coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / nullif((a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT, 0), 6) AS mean
FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS a, CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey::DOUBLE END AS b, CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey::DOUBLE END AS c FROM supplier)"""
)
def d16_row_mean(spark, sf_dir):
    from ..functions.columns import mean_of_present

    k = F.col("s_suppkey")
    m = mean_of_present(F.when(k % 2 == 0, F.col("s_acctbal")), F.when(k % 3 == 0, F.col("s_nationkey").cast("double")), F.when(k % 5 == 0, k.cast("double")))
    return read(spark, sf_dir, "supplier").select("s_suppkey", F.round(m, 6).alias("mean"))


@query("SELECT c_mktsegment, c_custkey, rank FROM (SELECT c_mktsegment, c_custkey, (row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) - 1)::INT AS rank FROM customer) WHERE rank < 5")
def e4_zero_based_rank(spark, sf_dir):
    return top(read(spark, sf_dir, "customer"), "c_mktsegment", 5, "c_acctbal", "c_custkey").select("c_mktsegment", "c_custkey", "rank")
