"""URL filters: host-suffix and path-prefix expressions joined to rules by short hash prefixes, in DataFrame operations.

A rule (host, path, action) fits a URL whose host is the rule's or below it, and whose path starts with the rule's. A
URL's expressions are its host suffixes at dots, each with its path prefixes of those lengths that rules have (other
lengths can fit none). Expressions and rules meet on the first 32 bits of their SHA-256; the full digest then confirms.
Of the rules that fit, the longest (host and path together) wins; of equally long ones the longer host, then block.

Work is done once for each distinct (host, path), then joined back to the rows; those without a host and path, which may
be very many, get their one verdict without a join by key. Rules are joined as any table: Spark broadcasts them only
where their size is known to be small.

Defined cases. Null URL or one without "://": host and path are empty, no rule fits. Empty host or path: expressions
as they are; a rule's path must be a prefix of an empty path, so only an empty one is. Repeated rows and ids: each row
has its own verdict. No rules, or no rows: no rule fits, or no rows. Very long URLs: as any other. Other columns are
left out. A rule given twice counts once; given with both actions, block holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def filter_urls(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """id_col, host, path, rule (host and path of the rule that holds; null: none), verdict, for each row of pages.

    rules: (host, path, action), action being allow or block.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "action").filter("rule_host is not null and rule_path is not null")
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("action").alias("action"))  # block is after allow
    digest = lambda h, p: F.sha2(F.concat(h, F.lit("\x00"), p).cast("binary"), 256)
    rules = rules.withColumn("rule_digest", digest(F.col("rule_host"), F.col("rule_path"))).withColumn("short", F.substring("rule_digest", 1, 8))
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())  # at most the length of a URL
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    distinct = rows.select("host", "path").distinct()
    said = distinct.withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode(F.transform(fitting, lambda n: F.substring(F.col("path"), F.lit(1), n))))
    said = said.withColumn("digest", digest(F.col("suffix"), F.col("prefix"))).withColumn("short", F.substring("digest", 1, 8))
    hits = said.join(rules, "short").filter(F.col("digest") == F.col("rule_digest"))
    order = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), "action", "rule_host", "rule_path")
    best = hits.groupBy("host", "path").agg(F.max(F.struct(order.alias("o"), F.concat("rule_host", "rule_path").alias("rule"), "action")).alias("best"))
    nothing = (F.col("host") == "") & (F.col("path") == "")
    out = rows.filter(~nothing).join(best, ["host", "path"], "left")
    of_nothing = best.filter(nothing).select("best")  # one row at most
    out = out.unionByName(rows.filter(nothing).join(F.broadcast(of_nothing), F.lit(True), "left"))
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))


#: The rules of the query: fixed values.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    values = ", ".join("({})".format(", ".join("'{}'".format(x.replace("\\", "\\\\").replace("'", "\\'")) for x in r)) for r in rules)
    return spark.sql(f"SELECT * FROM VALUES {values} AS r(host, path, action)")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_table(spark))


SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(h, p, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
n AS (SELECT *, row_number() OVER () AS i FROM hp),
m AS (
  SELECT n.i, arg_max(r.h || r.p, length(r.h || r.p)) AS rule, arg_max(r.action, length(r.h || r.p)) AS action
  FROM n JOIN r ON (n.host = r.h OR ends_with(n.host, '.' || r.h)) AND starts_with(n.path, r.p) GROUP BY n.i)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM n LEFT JOIN m USING (i)
"""
