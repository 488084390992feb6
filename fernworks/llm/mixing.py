"""Mixing sources to target weights by a time-varying curriculum, in DataFrame operations alone.

Sources in code-point order (null last) get the weights in turn. A source's target is its share by weight of the words
of all documents, at most `max_repeats` times its own words; what is above that is shared anew by weight, until no
source is above (water filling, in closed form over the sorted sources).

Over training time u in [0, 1] a source's rate is target * (1 + g * (2u - 1)), with one tilt g for each source (the
early sources fall, the late ones rise; the tilts cancel out, so the rate over all sources is constant). The integral
of the rate is the source's cumulative demand; inverting it at the place of a document in its source's queue gives the
document's training position, and documents are range-sorted by position.

A queue is in the order of a hash of id and text. It is cut into hash buckets; a document's place is the sum of the
buckets before its own and of the documents before it there, so a source with most of all rows is in thousands of
groups. Only sums for each source and bucket meet, and in one task only one row for each source.

Defined cases. Null text or one without words: size 0, takes nothing. Null source: a source of its own, last. Repeated
rows and ids: each row is a document. A document at the edge of its source's target is taken in part (`taken` counts
its first words); `training_order` has it whole. Empty table: no rows. Extra columns are carried by `training_order`
and can have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

WORD = r"[^\x20\x09-\x0D]+"
#: Hash digits that cut each source's queue into buckets: 16**3 of them.
BUCKET_DIGITS = 3


def _base(docs: DataFrame, row: Column) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), text).cast("binary"))
    out = docs.select(row.alias("row"), F.coalesce(F.concat(F.lit("a"), F.col("source").cast("string")), F.lit("b")).alias("skey"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), key.alias("key"))
    return out.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_repeats: int = 3, slope: float = 0.8) -> DataFrame:
    """(skey, source_size, target, tilt) from (skey, source_size): one row for each source."""
    whole = Window.orderBy("skey")
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    number = F.row_number().over(whole)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.pmod(number - 1, F.lit(len(weights))) + 1)
    big = lambda c: c.cast("decimal(38,0)")
    s = sizes.withColumn("number", number).withColumn("w", big(weight)).withColumn("cap", big(F.col("source_size") * max_repeats))
    s = s.withColumn("n", F.count(F.lit(1)).over(every)).withColumn("all_size", F.sum("source_size").over(every)).withColumn("all_w", F.sum("w").over(every))
    fill = Window.orderBy(F.col("source_size").cast("double") / F.col("w").cast("double"), "skey").rowsBetween(Window.unboundedPreceding, -1)
    zero = big(F.lit(0))
    s = s.withColumn("num", big(F.col("all_size") - F.coalesce(F.sum("cap").over(fill), zero))).withColumn("den", big(F.col("all_w") - F.coalesce(F.sum("w").over(fill), zero)))
    s = s.withColumn("capped", F.col("cap").cast("double") * F.col("den").cast("double") <= F.col("w").cast("double") * F.col("num").cast("double"))
    level = F.max(F.when(~F.col("capped"), F.struct("den", "num"))).over(every)  # the first source under its cap
    s = s.withColumn("level", level)
    free = (F.col("w") * F.col("level.num")).cast("double") / F.col("level.den").cast("double")
    s = s.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(free))
    # the tilt runs from falling to rising over the sources and has mean 0 over the words
    lean = F.when(F.col("n") > 1, 2.0 * (F.col("number") - 1) / (F.col("n") - 1) - 1.0).otherwise(F.lit(0.0))
    s = s.withColumn("lean", lean)
    mean = F.coalesce(F.try_divide(F.sum(F.col("lean") * F.col("target")).over(every), F.sum("target").over(every)), F.lit(0.0))
    return s.select("skey", "source_size", "target", (F.lit(slope / 2) * (F.col("lean") - mean)).alias("tilt"))


def _at(offset: Column, target: Column, tilt: Column) -> Column:
    """The time at which a source's cumulative demand, target * (u + tilt * (u^2 - u)), reaches offset."""
    x = F.try_divide(offset, target)
    return F.try_divide(2.0 * x, (1.0 - tilt) + F.sqrt((1.0 - tilt) * (1.0 - tilt) + 4.0 * tilt * x))


def _placed(base: DataFrame, **how) -> DataFrame:
    """base with source_size, target, tilt, taken, wanted (whole words of target) and before (words before it in its source)."""
    sums = base.groupBy("skey", "bucket").agg(F.sum("size").alias("bucket_size"))
    source = targets(sums.groupBy("skey").agg(F.sum("bucket_size").alias("source_size")), **how)
    earlier = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = sums.withColumn("start", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0).cast("long"))).select("skey", "bucket", "start")
    inside = Window.partitionBy("skey", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    out = base.join(start.join(source, "skey"), ["skey", "bucket"])
    out = out.withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long")))
    out = out.withColumn("wanted", F.floor(F.col("target") + 0.5).cast("long"))
    rounds = F.when(F.col("source_size") > 0, F.expr("wanted div source_size")).otherwise(F.lit(0).cast("long"))
    out = out.withColumn("rounds", rounds)
    rest = F.least(F.greatest(F.col("wanted") - F.col("rounds") * F.col("source_size") - F.col("before"), F.lit(0).cast("long")), F.col("size"))
    return out.withColumn("rest", rest).withColumn("taken", F.col("rounds") * F.col("size") + F.col("rest"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", weights: tuple[int, ...] = (5, 2, 1), max_repeats: int = 3, slope: float = 0.8) -> DataFrame:
    """One row for each document: id, size, source_size, target, taken, position; range-sorted by position.

    position: of its first use, in [0, 1], rounded to six places, which the order is not; documents that are not taken come after 1, in the order of their queue.
    docs needs the columns text, source and id_col.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), "text", "source")
    base = written(_base(source, F.col("doc_id")), "mixing")
    out = _placed(base, weights=weights, max_repeats=max_repeats, slope=slope)
    first = _at(F.col("before") + F.when(F.col("rounds") > 0, F.col("size")).otherwise(F.col("rest")) / 2.0, F.col("target"), F.col("tilt"))
    waiting = 1.0 + F.coalesce(F.try_divide(F.col("before"), F.col("source_size")), F.lit(0.0))
    out = out.withColumn("position", F.when(F.col("taken") > 0, first).otherwise(waiting))
    return out.orderBy("position", "key").select(F.col("row").alias(id_col), "size", "source_size", "target", "taken", F.round("position", 6).alias("position"))


def training_order(docs: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1), max_repeats: int = 3, slope: float = 0.8) -> DataFrame:
    """The documents as training reads them: a row for each use, all columns of docs, range-sorted by position."""
    base = _base(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    out = _placed(base, weights=weights, max_repeats=max_repeats, slope=slope).filter(F.col("taken") > 0)
    uses = F.col("rounds") + F.when(F.col("rest") > 0, 1).otherwise(0)
    out = out.withColumn("use", F.explode(F.sequence(F.lit(0).cast("long"), uses - 1)))
    words = F.when(F.col("use") < F.col("rounds"), F.col("size")).otherwise(F.col("rest"))
    out = out.withColumn("position", _at(F.col("use") * F.col("source_size") + F.col("before") + words / 2.0, F.col("target"), F.col("tilt")))
    return out.orderBy("position", "key", "use").select("row.*")


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """The words that the mix takes from every document, in training order."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce('a' || source, 'b') AS skey,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')) AS k
  FROM documents),
s0 AS (SELECT skey, sum(size)::BIGINT AS source_size FROM d GROUP BY skey),
s1 AS (SELECT *, row_number() OVER (ORDER BY skey) AS number, count(*) OVER () AS n, sum(source_size) OVER () AS all_size FROM s0),
s2 AS (SELECT *, [5, 2, 1][((number - 1) % 3 + 1)::INT] AS w FROM s1),
s3 AS (SELECT *, sum(w) OVER () AS all_w,
    all_size - coalesce(sum(3 * source_size) OVER f, 0) AS num,
    sum(w) OVER () - coalesce(sum(w) OVER f, 0) AS den
  FROM s2 WINDOW f AS (ORDER BY source_size::DOUBLE / w, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, (3 * source_size)::DOUBLE * den::DOUBLE <= w::DOUBLE * num::DOUBLE AS capped FROM s3),
lv AS (SELECT arg_max(num, den) AS num, max(den) AS den FROM s4 WHERE NOT capped),
s5 AS (SELECT s4.*, CASE WHEN capped THEN (3 * source_size)::DOUBLE ELSE (w * lv.num)::DOUBLE / lv.den::DOUBLE END AS target,
    CASE WHEN n > 1 THEN 2.0::DOUBLE * (number - 1) / (n - 1) - 1 ELSE 0 END AS lean FROM s4, lv),
s6 AS (SELECT skey, source_size, target,
    0.4::DOUBLE * (lean - coalesce(sum(lean * target) OVER () / nullif(sum(target) OVER (), 0), 0)) AS g,
    floor(target + 0.5)::BIGINT AS wanted FROM s5),
p AS (SELECT d.doc_id, d.size, s6.*, coalesce(sum(d.size) OVER (PARTITION BY d.skey ORDER BY d.k, d.size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d JOIN s6 USING (skey)),
q AS (SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS rounds FROM p),
r AS (SELECT *, least(greatest(wanted - rounds * source_size - before, 0), size) AS rest FROM q),
x AS (SELECT *, (before + CASE WHEN rounds > 0 THEN size ELSE rest END / 2.0::DOUBLE) / nullif(target, 0) AS x FROM r)
SELECT doc_id, size, source_size, target, (rounds * size + rest)::BIGINT AS taken,
  round(CASE WHEN rounds * size + rest > 0 THEN 2 * x / ((1 - g) + sqrt((1 - g) * (1 - g) + 4 * g * x))
    ELSE 1 + coalesce(before::DOUBLE / nullif(source_size, 0), 0) END, 6) AS position
FROM x
"""
