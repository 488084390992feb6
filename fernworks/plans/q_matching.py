"""Keep/drop decisions and samples. Candidates are the four nearest occupations of each ad; responses go by the ad's id."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import matching, vectors
from .q_vectors import BASE, sides
from .registry import query, read

CANDIDATES = BASE + """,
s AS (SELECT ad_id, onet_code, list_cosine_similarity(a.e, o.e) AS c FROM a CROSS JOIN o),
t AS (SELECT ad_id, (rn - 1)::INT AS rank, onet_code, c FROM (SELECT *, row_number() OVER (PARTITION BY ad_id ORDER BY c DESC, onet_code) AS rn FROM s) WHERE rn <= 4),
r AS (SELECT *, CASE ad_id % 5 WHEN 0 THEN [1, 3] WHEN 1 THEN [2] WHEN 4 THEN [1, 2, 3, 4] END AS keep FROM t)
"""


def candidates(spark, sf_dir):
    return vectors.cosine_topk(*sides(spark, sf_dir), 4)


def responses(ads):
    said = ['{"keep": [1, 3]}', '{"keep": [2]}', "not json", '{"keep": [99]}', '{"keep": [1, 2, 3, 4]}']
    data = F.element_at(F.array(*[F.lit(x) for x in said]), (F.col("ad_id") % 5 + 1).cast("int"))
    return ads.select("ad_id", data.alias("data"), F.lit(None).cast("string").alias("error"))


def both(spark, sf_dir):
    return matching.split_by_response(candidates(spark, sf_dir), responses(sides(spark, sf_dir)[0]))


@query(CANDIDATES + "SELECT ad_id, (row_number() OVER (PARTITION BY ad_id ORDER BY rank) - 1)::INT AS rank, onet_code, round(c, 6) AS cosine_score FROM r WHERE list_contains(keep, rank + 1)")
def h6_keep_drop_split(spark, sf_dir):
    return both(spark, sf_dir)[0].withColumn("cosine_score", F.round("cosine_score", 6))


@query(CANDIDATES + "SELECT ad_id, onet_code, round(c, 6) AS cosine_score, rank AS original_rank FROM r WHERE keep IS NOT NULL AND NOT list_contains(keep, rank + 1)")
def h6_dropped(spark, sf_dir):
    return both(spark, sf_dir)[1].withColumn("cosine_score", F.round("cosine_score", 6))


@query(
    CANDIDATES + """, k AS (SELECT ad_id, (row_number() OVER (PARTITION BY ad_id ORDER BY rank) - 1)::INT AS rank, onet_code FROM r WHERE list_contains(keep, rank + 1))
SELECT *, ((ad_id * 7919 + onet_code * 104729) % 1000) / 1000.0::DOUBLE AS rerank_score FROM k"""
)
def h7_rerank_order_kept(spark, sf_dir):
    kept = both(spark, sf_dir)[0]
    scores = kept.select("ad_id", "onet_code", (F.pmod(F.col("ad_id") * 7919 + F.col("onet_code") * 104729, F.lit(1000)) / 1000.0).alias("rerank_score"))
    return matching.reranked(kept, scores).select("ad_id", "rank", "onet_code", "rerank_score")


@query(CANDIDATES + "SELECT ad_id, rank, onet_code FROM t WHERE rank < 2")
def b19_pruned(spark, sf_dir):
    return matching.pruned(candidates(spark, sf_dir), 2).select("ad_id", "rank", "onet_code")


@query(
    """SELECT event_id AS ad_id, CASE WHEN k < 1 THEN 'zero_or_negative_index' WHEN k > 60 THEN 'index_out_of_range' END AS error_class
FROM (SELECT event_id, json_extract(props, '$.k')::INT AS k FROM events)"""
)
def k6_response_validation(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    said = e.select(F.col("event_id").alias("ad_id"), F.concat(F.lit('{"keep": ['), k, F.lit("]}")).alias("data"), F.lit(None).cast("string").alias("error"))
    out = matching.validated(said, e.select(F.col("event_id").alias("ad_id"), F.lit(60).alias("n")))
    return out.select("ad_id", F.when(F.col("error").isNotNull(), matching.error_class(F.col("error"))).alias("error_class"))


ERRORS = ("1 validation error: ValidationError must keep at least 1", "ValidationError: keep indices must be 1-based", "ValidationError: other", "JSONDecodeError: line 1", "index 9 out of range", "Failed to extract valid JSON from text", "timeout")


@query(
    """SELECT CASE event_id % 7 WHEN 0 THEN 'empty_keep' WHEN 1 THEN 'zero_or_negative_index' WHEN 2 THEN 'validation_error' WHEN 3 THEN 'malformed_json'
WHEN 4 THEN 'index_out_of_range' WHEN 5 THEN 'no_json_in_reasoning' ELSE 'other' END AS error_class, count(*) AS n FROM events GROUP BY 1"""
)
def b20_error_classes(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.element_at(F.array(*[F.lit(x) for x in ERRORS]), (F.col("event_id") % 7 + 1).cast("int")).alias("error"))
    return e.groupBy(matching.error_class(F.col("error")).alias("error_class")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END AS found FROM events")
def k7_json_in_prose(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    said = F.when(F.col("event_id") % 3 == 0, F.lit("nothing { here }")).when(F.col("event_id") % 3 == 1, F.concat(F.lit("I think {so}: "), "props", F.lit(" is it }"))).otherwise(F.col("props"))
    return matching.json_in_prose(e.select("event_id", said.alias("found")), "found")


@query("SELECT event_id AS id FROM events WHERE event_id % 4 <> 0")
def k12_resume_remaining(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    done = e.filter("id % 2 = 0").withColumn("error", F.when(F.col("id") % 4 == 2, F.lit("bad")))
    return matching.remaining(e, done)


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def c10_semi_sample(spark, sf_dir):
    chosen = read(spark, sf_dir, "orders").filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").join(chosen, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("SELECT doc_id, lang FROM documents ORDER BY md5(doc_id::VARCHAR || '-42'), doc_id LIMIT 100")
def h1_hash_sample(spark, sf_dir):
    return matching.hash_sample(read(spark, sf_dir, "documents").select("doc_id", "lang"), 100, 42, "doc_id")


@query(
    """SELECT p_partkey, concat_ws(chr(10) || chr(10), 'Title: ' || p_name, 'Also known as: ' || p_brand || ', ' || p_type,
  'Key tasks: ' || CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand || ' of ' || p_size::VARCHAR END) AS document FROM part"""
)
def h3_document_text(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    tasks = F.when(F.col("p_size") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat("p_brand", F.lit(" of "), F.col("p_size").cast("string"))))
    return p.select("p_partkey", text.occupation_text(F.col("p_name"), F.lit(None).cast("string"), F.array("p_brand", "p_type"), tasks, 10, 5).alias("document"))


@query(
    """SELECT doc_id, 'Ad: ' || source || '. ' || trim(left(text, 6000), ' ') || chr(10) || 'Candidates:' || chr(10) || '1. ' || lang || chr(10) || '2. ' || source AS prompt FROM documents"""
)
def p_prompt_text(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    ad, listed = text.ad_text(F.col("source"), F.col("text"), 6000), text.numbered(F.array("lang", "source"))
    return d.select("doc_id", text.template("Ad: {ad}\nCandidates:\n{listed}", {"ad": ad, "listed": listed}).alias("prompt"))


@query("SELECT doc_id, CASE WHEN length(text) <= 40 THEN text ELSE left(text, 37) || '...' END AS short FROM documents")
def p_shortened_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.shortened(F.col("text"), 40).alias("short"))


@query("SELECT page_id, length(regexp_replace(html, '<[^>]+>', '', 'g')) AS n_chars, md5(regexp_replace(html, '<[^>]+>', '', 'g')) AS digest FROM pages")
def p_without_tags(spark, sf_dir):
    plain = text.without_tags(F.col("html"))
    return read(spark, sf_dir, "pages").select("page_id", F.length(plain).cast("long").alias("n_chars"), F.md5(plain.cast("binary")).alias("digest"))
