"""Loading, harmonising and keeping the earliest."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import ads
from .registry import query, read


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts NULLS LAST, event_id) AS rn FROM events) WHERE rn = 1")
def f1_dedup_earliest(spark, sf_dir):
    return ads.earliest(read(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id", "value")


@query(
    """SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_id % 3 = 0 OR user_id % 5 = 0 THEN NULL ELSE ts END NULLS LAST, event_id) AS rn FROM events) WHERE rn = 1"""
)
def f1_null_dates(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("day", F.when((F.col("event_id") % 3 != 0) & (F.col("user_id") % 5 != 0), F.col("ts")))
    return ads.earliest(e, ["user_id"], "day", "event_id").select("user_id", "event_id")


@query(
    """SELECT s_suppkey AS id, 2024 AS year, 3 AS month, s_name AS title, NULL::VARCHAR AS description, s_nationkey::VARCHAR AS "SIC1", s_acctbal AS salary_min, NULL::DOUBLE AS company_id FROM supplier"""
)
def a6_schema_harmonise(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ID"), F.col("s_name").alias("title"), F.col("s_nationkey").alias("sic1"), F.col("s_acctbal").alias("salary_min"))
    return ads.harmonised(s, year=2024, month=3).select("id", "year", "month", "title", "description", "SIC1", "salary_min", "company_id")


@query("SELECT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, count(*) AS n FROM orders GROUP BY 1, 2")
def a9_partition_counts(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey AS id, o_orderpriority AS title FROM orders WHERE o_orderkey % 17 = 3")
def a36_by_id(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"), "o_totalprice")
    return ads.by_id(o, o.filter("id % 17 = 3").select("id"), ["title"])


@query("SELECT try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k, count(*) AS n FROM events GROUP BY 1")
def b6_numeric_coercion(spark, sf_dir):
    from ..functions.columns import number

    e = read(spark, sf_dir, "events").withColumn("p", F.from_json("props", T.StructType([T.StructField("k", T.StringType())]))["k"])
    return e.groupBy(number(F.col("p")).alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::INT AS finished, round(avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 6) AS mean_finished FROM orders GROUP BY 1")
def d3_conditional_mean(spark, sf_dir):
    done = F.col("o_orderstatus") == "F"
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum(F.when(done, 1).otherwise(0)).cast("int").alias("finished"), F.round(F.avg(F.when(done, F.col("o_totalprice"))), 6).alias("mean_finished"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def f4_difference(spark, sf_dir):
    """Customers without an urgent order."""
    ordered = read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").select("c_custkey").join(ordered, "c_custkey", "left_anti")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def s1_hourly_counts(spark, sf_dir):
    """The streaming extension's windowed counts, over the whole table at once."""
    from ..streaming.ingest import counts

    return counts(read(spark, sf_dir, "events"), "ts", "1 hour", "event_type").select("start", "event_type", "n")
