"""Pairwise comparisons: the smallest and largest part of an order are compared; the order's key decides."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pairwise, stats
from .registry import query, read

PAIRS = """WITH x AS (SELECT l_orderkey AS k, min(l_partkey) AS a, max(l_partkey) AS b FROM lineitem GROUP BY l_orderkey),
c AS (SELECT k, a, b, CASE WHEN k % 5 = 0 THEN 'tie' WHEN k % 3 = 0 OR a < b AND k % 2 = 0 THEN 'A' ELSE 'B' END AS outcome FROM x WHERE a <> b)
"""


def _decided(x):
    a_wins = (F.col("k") % 3 == 0) | ((F.col("a") < F.col("b")) & (F.col("k") % 2 == 0))
    return x.filter("a <> b").withColumn("outcome", F.when(F.col("k") % 5 == 0, "tie").when(a_wins, "A").otherwise("B"))


def comparisons(spark, sf_dir):
    ends = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_partkey").alias("a"), F.max("l_partkey").alias("b"))
    return _decided(ends)


def items(spark, sf_dir):
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"))


@query()
def h15_bt_theta(spark, sf_dir):
    """Iterative, so without a DuckDB statement; the tests check the gradient."""
    return pairwise.bradley_terry(comparisons(spark, sf_dir), items(spark, sf_dir)).withColumn("theta", F.round("theta", 6))


WINS = "SELECT a AS item, k, CASE WHEN outcome = 'tie' THEN 0.5 WHEN outcome = 'A' THEN 1 ELSE 0 END AS w FROM c UNION ALL SELECT b, k, CASE WHEN outcome = 'tie' THEN 0.5 WHEN outcome = 'A' THEN 0 ELSE 1 END FROM c"


@query(PAIRS + f", w AS ({WINS}) SELECT p_partkey AS item, round(coalesce(sum(w), 0)::DOUBLE, 4) AS wins FROM part LEFT JOIN w ON item = p_partkey GROUP BY 1")
def h15_expected_wins(spark, sf_dir):
    """The wins that the fitted strengths lead one to expect: at the optimum, and nowhere else, they are the wins there are."""
    c = comparisons(spark, sf_dir)
    fitted = pairwise.expected_wins(c, pairwise.bradley_terry(c, items(spark, sf_dir)))
    return fitted.select("item", (F.round("expected", 4) + 0.0).alias("wins"))


@query(PAIRS + f""", w AS ({WINS}), q AS (SELECT unnest([1, 2, 3, 4]) AS round), l AS (SELECT max(k) AS last FROM c)
SELECT round, p_partkey AS item, round(coalesce(sum(w) FILTER (k <= last * round / 4), 0)::DOUBLE, 4) AS wins FROM part CROSS JOIN q CROSS JOIN l LEFT JOIN w ON item = p_partkey GROUP BY ALL""")
def i17_expected_wins(spark, sf_dir):
    """As h15_expected_wins, for each of the refits whose convergence is looked at."""
    c = comparisons(spark, sf_dir)
    last = c.agg(F.max("k")).first()[0] or 0
    out = None
    for q in (1, 2, 3, 4):
        some = c.filter(F.col("k") <= last * q / 4)
        e = pairwise.expected_wins(some, pairwise.bradley_terry(some, items(spark, sf_dir))).select(F.lit(q).alias("round"), "item", (F.round("expected", 4) + 0.0).alias("wins"))
        out = e if out is None else out.unionByName(e)
    return out


@query(
    """WITH i AS (SELECT p_partkey AS item, p_retailprice AS price, r, s FROM part, (SELECT unnest([1, 2]) AS r), (SELECT unnest([7, 8, 9]) AS s)),
n AS (SELECT item, r, s, row_number() OVER (PARTITION BY r, s ORDER BY md5(item || '-' || r || '-' || s), item) - 1 AS p FROM i),
t AS (SELECT DISTINCT s, a, b FROM (SELECT s, min(item) AS a, max(item) AS b FROM n GROUP BY s, r, p // 2 HAVING count(*) = 2))
SELECT a, b, sum(CASE WHEN x.p_retailprice > y.p_retailprice THEN 1 WHEN x.p_retailprice < y.p_retailprice THEN 0 ELSE 0.5 END)::DOUBLE AS wins_a,
sum(CASE WHEN x.p_retailprice > y.p_retailprice THEN 0 WHEN x.p_retailprice < y.p_retailprice THEN 1 ELSE 0.5 END)::DOUBLE AS wins_b
FROM t JOIN part x ON x.p_partkey = a JOIN part y ON y.p_partkey = b GROUP BY a, b"""
)
def f7_comparisons_of_rounds(spark, sf_dir):
    """Three rounds of random pairs, half of each shown the other way round, and their answers put together."""
    part = read(spark, sf_dir, "part")
    asked = None
    for seed in (7, 8, 9):
        pairs = pairwise.swapped(pairwise.shuffled_pairs(part.select(F.col("p_partkey").alias("item")), 2, seed), seed)
        said = pairwise.unswapped(_by_price(part, pairs)).select("a", "b", "outcome")
        asked = said if asked is None else asked.unionByName(said)
    return pairwise.collapsed(asked)


def _by_price(part, pairs):
    side = lambda s: part.select(F.col("p_partkey").alias(f"shown_{s}"), F.col("p_retailprice").alias(f"price_{s}")).hint("merge")
    p = pairs.join(side("a"), "shown_a").join(side("b"), "shown_b")
    return p.withColumn("outcome", F.when(F.col("price_a") > F.col("price_b"), "A").when(F.col("price_a") < F.col("price_b"), "B").otherwise("tie"))


@query()
def h14_task_exposure_bt(spark, sf_dir):
    """Parts as tasks, brands as occupations, sizes as importance; the dearer part wins. The tests check it."""
    part = read(spark, sf_dir, "part")
    tasks = part.select(F.col("p_partkey").alias("item"), F.col("p_brand").alias("onet_code"), F.col("p_size").cast("double").alias("importance"))
    scores = pairwise.in_rounds(tasks.select("item"), lambda pairs: _by_price(part, pairs), (4, 3, 3), 7)
    out = pairwise.by_occupation(scores, tasks, tasks.select("onet_code").distinct())
    return out.select("onet_code", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query()
def i17_convergence(spark, sf_dir):
    """Scores of refits on the first quarters of the comparisons, against the next refit and the last one."""
    c = comparisons(spark, sf_dir)
    last = c.agg(F.max("k")).first()[0] or 0
    wide = items(spark, sf_dir)
    for q in (1, 2, 3, 4):
        theta = pairwise.bradley_terry(c.filter(F.col("k") <= last * q / 4), items(spark, sf_dir))
        wide = wide.join(pairwise.floor_normalised(theta, "theta", 0.1).select("item", F.col("score").alias(f"s{q}")).hint("merge"), "item")
    wide = wide.persist()
    rows = []
    for against, q, other in [("next", q, q + 1) for q in (1, 2, 3)] + [("last", q, 4) for q in (1, 2, 3)]:
        r = wide.agg(F.corr(f"s{q}", f"s{other}"), F.avg(F.abs(F.col(f"s{q}") - F.col(f"s{other}")))).first()
        rows.append((against, q, *(round(float(x or 0), 6) for x in (stats.spearman(wide, f"s{q}", f"s{other}").first()[0], *r))))
    wide.unpersist()
    return spark.createDataFrame(rows, "against string, round int, spearman double, pearson double, mae double")


@query(PAIRS + "SELECT least(a, b) AS a, greatest(a, b) AS b, sum(CASE WHEN outcome = 'tie' THEN 0.5 WHEN (outcome = 'A') = (a <= b) THEN 1 ELSE 0 END)::DOUBLE AS wins_a, sum(CASE WHEN outcome = 'tie' THEN 0.5 WHEN (outcome = 'A') = (a <= b) THEN 0 ELSE 1 END)::DOUBLE AS wins_b FROM c GROUP BY 1, 2")
def h15_collapsed_pairs(spark, sf_dir):
    return pairwise.collapsed(comparisons(spark, sf_dir))


@query(
    """WITH n AS (SELECT p_partkey, (p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()) AS x FROM part)
SELECT p_partkey, round(CASE WHEN x <= 0.1 THEN 0 ELSE (x - 0.1) / 0.9 END, 6) AS score FROM n"""
)
def h18_floor_normalise(spark, sf_dir):
    out = pairwise.floor_normalised(read(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), "p_retailprice", 0.1)
    return out.select("p_partkey", F.round("score", 6).alias("score"))


@query(
    PAIRS + """, s AS (SELECT k, a, b, substr(md5(a::VARCHAR || '-' || b::VARCHAR || '-3'), 1, 1) >= '8' AS swap, outcome FROM c)
SELECT k, CASE WHEN swap THEN b ELSE a END AS shown_a, CASE WHEN swap THEN a ELSE b END AS shown_b, CASE WHEN swap AND outcome = 'A' THEN 'B' WHEN swap AND outcome = 'B' THEN 'A' ELSE outcome END AS outcome FROM s"""
)
def h19_unswap(spark, sf_dir):
    return pairwise.unswapped(pairwise.swapped(comparisons(spark, sf_dir), 3)).select("k", "shown_a", "shown_b", "outcome")


@query(
    """WITH i AS (SELECT p_partkey AS item, r.range AS rd FROM part, range(1, 4) r),
n AS (SELECT item, rd, row_number() OVER (PARTITION BY rd ORDER BY md5(item::VARCHAR || '-' || rd::VARCHAR || '-5'), item) - 1 AS p FROM i)
SELECT DISTINCT a, b FROM (SELECT min(item) AS a, max(item) AS b FROM n GROUP BY rd, p // 2 HAVING count(*) = 2)"""
)
def h16_random_pairs(spark, sf_dir):
    return pairwise.shuffled_pairs(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("item")), 3, 5)


@query("SELECT x.p_partkey AS a, y.p_partkey AS b FROM part x JOIN part y ON x.p_partkey < y.p_partkey AND abs(x.p_retailprice - y.p_retailprice) <= 0.15")
def h17_band_pairs(spark, sf_dir):
    return pairwise.band_pairs(read(spark, sf_dir, "part"), "p_retailprice", 0.15, "p_partkey")


@query(
    """WITH o AS (SELECT p_partkey AS a, p_retailprice AS x, row_number() OVER (ORDER BY p_retailprice, p_partkey) AS p FROM part),
n AS (SELECT u.a, v.a AS b, abs(u.x - v.x) AS apart FROM o u JOIN o v ON v.p BETWEEN u.p - 4 AND u.p + 4 AND v.p <> u.p WHERE abs(u.x - v.x) <= 0.15)
SELECT a, b, round(apart, 6) AS apart FROM n QUALIFY row_number() OVER (PARTITION BY a ORDER BY apart, b) <= 4"""
)
def c19_band_partners(spark, sf_dir):
    """The four parts nearest in price to each, within a width: a range join whose result doesn't grow with the square."""
    return pairwise.band_partners(read(spark, sf_dir, "part"), "p_retailprice", 0.15, 4, "p_partkey").withColumn("apart", F.round("apart", 6))


@query(
    """WITH RECURSIVE t AS (SELECT p_partkey AS item, p_retailprice AS v, (SELECT stddev_pop(p_retailprice) FROM part) AS w FROM part),
u AS (SELECT item, v - w AS v, 0 AS kind, 0 AS one FROM t UNION ALL SELECT item, v, 1, 1 FROM t UNION ALL SELECT item, v + w, 2, 0 FROM t),
p AS (SELECT item, kind, coalesce(sum(one) OVER (ORDER BY v, kind, item ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place FROM u),
o AS (SELECT item, max(place) FILTER (kind = 0) AS low, max(place) FILTER (kind = 1) AS own, max(place) FILTER (kind = 2) AS high FROM p GROUP BY item),
q AS (SELECT *, high - low - 1 AS m, ('0x' || substr(md5(item || '-1'), 1, 12))::BIGINT AS h FROM o),
c AS (SELECT item, own, low + (h + j * greatest(m // 12, 1)) % m AS place FROM q, range(12) r(j) WHERE j < m),
f AS (SELECT DISTINCT c.item AS x, least(c.item, o.item) AS a, greatest(c.item, o.item) AS b FROM c JOIN o ON o.own = CASE WHEN c.place >= c.own THEN c.place + 1 ELSE c.place END),
e AS (SELECT DISTINCT a, b FROM f),
-- the room that is left at both ends goes along; an edge with a full end is dropped
rounds AS (SELECT a, b, substr(md5(a || '-' || b || '-1'), 1, 12) AS h, 3::BIGINT AS room_a, 3::BIGINT AS room_b, false AS taken FROM e
  UNION ALL (
  WITH l AS (SELECT * FROM rounds WHERE NOT taken),
  n AS (SELECT a, b, h, room_a AS room, a AS item FROM l UNION ALL SELECT a, b, h, room_b, b FROM l),
  k AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY h, a, b) <= room AS first FROM n),
  g AS (SELECT a, b, bool_and(first) AS got FROM k GROUP BY a, b),
  s AS (SELECT item, any_value(room) - count(*) FILTER (got) AS room FROM k JOIN g USING (a, b) GROUP BY item)
  SELECT l.a, l.b, l.h, x.room, y.room, g.got FROM l JOIN g USING (a, b) JOIN s x ON x.item = l.a JOIN s y ON y.item = l.b WHERE g.got OR x.room > 0 AND y.room > 0)),
got AS (SELECT a, b FROM rounds WHERE taken),
lack AS (SELECT item AS x, 3 - count(a) AS lack FROM o LEFT JOIN got ON item = a OR item = b GROUP BY item HAVING count(a) < 3),
more AS (SELECT a, b, lack, row_number() OVER (PARTITION BY x ORDER BY substr(md5(a || '-' || b || '-1'), 1, 12), a, b) AS place FROM f JOIN lack USING (x) WHERE (a, b) NOT IN (SELECT (a, b) FROM got))
SELECT a, b FROM got UNION SELECT a, b FROM more WHERE place <= lack"""
)
def h17_adaptive_pairs(spark, sf_dir):
    """Three comparisons of a part; every part has enough others within the width, so none is paired besides."""
    return pairwise.adaptive_pairs(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"), F.col("p_retailprice").alias("theta")), 3, 1)


@query(PAIRS + "SELECT item, count(*) AS n FROM (SELECT a AS item FROM c UNION ALL SELECT b FROM c) GROUP BY item")
def d31_appearances(spark, sf_dir):
    return _appearances(comparisons(spark, sf_dir))


def _appearances(c):
    return c.select(F.col("a").alias("item")).union(c.select("b")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))


@query(PAIRS + "SELECT least(a, b) AS a, greatest(a, b) AS b, count(*) AS n, round(avg((outcome = 'tie')::INT::DOUBLE), 6) AS tie_rate FROM c GROUP BY 1, 2")
def d32_pair_counts(spark, sf_dir):
    return _pair_counts(comparisons(spark, sf_dir))


def _pair_counts(c):
    return c.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("outcome") == "tie").cast("double")), 6).alias("tie_rate"))
