"""What is written and read again: loads, files, markers, stores, runs; and the surface around them.

Each query writes to a new folder of the shared one and gives back what it reads there.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns
from ..operators import agreement, matching
from ..sources import ads, files, results, workbook
from . import cost, providers, stages
from .registry import query, read


def _raw(spark, sf_dir, where="true"):
    """Orders as ads in JSON lines by year and month: the customer is the ad, so ids are repeated."""
    base = files.scratch(spark)
    o = read(spark, sf_dir, "orders").filter(where)
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    o = o.select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("title"), day.alias("date_created"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    o.repartition("year").write.mode("append").partitionBy("year", "month").json(base)
    return base


@query("SELECT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, count(*) AS n, count(DISTINCT o_custkey) AS n_ids FROM orders GROUP BY 1, 2")
def a1_json_partitions(spark, sf_dir):
    return ads.read_json(spark, _raw(spark, sf_dir)).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"))


@query("SELECT year(o_orderdate)::INT AS year, o_orderpriority AS title, count(*) AS n FROM orders WHERE year(o_orderdate) IN (1995, 1997) GROUP BY 1, 2")
def a2_years_asked_for(spark, sf_dir):
    return ads.read_json(spark, _raw(spark, sf_dir), [1995, 1997]).groupBy("year", "title").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderpriority AS title, count(*) AS n FROM orders WHERE year(o_orderdate) <> 1996 GROUP BY 1")
def a3_only_json_files(spark, sf_dir):
    """A file of another kind in a month's folder is not read."""
    base = _raw(spark, sf_dir, "year(o_orderdate) <> 1996")
    read(spark, sf_dir, "orders").filter("year(o_orderdate) = 1996").select(F.to_json(F.struct(F.col("o_orderpriority").alias("title")))).write.text(f"{base}/year=1996/month=1")
    return ads.read_json(spark, base).groupBy("title").agg(F.count(F.lit(1)).alias("n"))


FIRST = "SELECT o_custkey AS id, min(strftime(o_orderdate, '%Y-%m-%d')) AS date_created, min(year(o_orderdate))::INT AS year"


@query(FIRST + " FROM orders GROUP BY 1")
def a5_store_of_ads(spark, sf_dir):
    """Loaded in two goes, partitioned by month; the earliest row of each id stays, wherever it comes from."""
    base, store = _raw(spark, sf_dir), files.scratch(spark)
    years = [r[0] for r in ads.read_json(spark, base).select("year").distinct().collect()]
    ads.load(spark, base, store, [y for y in years if y % 2])
    ads.load(spark, base, store)
    return spark.read.schema(ads.ADS).parquet(store).select("id", "date_created", "year")


@query(
    """WITH o AS (SELECT o_custkey, year(o_orderdate) % 2 = 1 AS odd FROM orders)
SELECT 'first' AS load, count(DISTINCT o_custkey) AS n FROM o WHERE odd UNION ALL
SELECT 'second', count(DISTINCT o_custkey) FROM o WHERE o_custkey NOT IN (SELECT o_custkey FROM o WHERE odd) UNION ALL SELECT 'third', 0"""
)
def f2_months_are_loaded_once(spark, sf_dir):
    base, store = _raw(spark, sf_dir), files.scratch(spark)
    years = [r[0] for r in ads.read_json(spark, base).select("year").distinct().collect()]
    n = [ads.load(spark, base, store, [y for y in years if y % 2]), ads.load(spark, base, store), ads.load(spark, base, store)]
    return spark.createDataFrame(list(zip(("first", "second", "third"), n, strict=True)), "load string, n long")


@query("SELECT DISTINCT year(d)::INT AS year, month(d)::INT AS month FROM (SELECT min(o_orderdate) AS d FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)")
def a8_loaded_months(spark, sf_dir):
    store = files.scratch(spark)
    ads.load(spark, _raw(spark, sf_dir, "o_orderstatus = 'F'"), store)
    return ads.loaded_months(spark, store)


@query("SELECT 'n' AS key, count(*)::VARCHAR AS value FROM orders UNION ALL SELECT 'status', 'second' UNION ALL SELECT 'latest', max(strftime(o_orderdate, '%Y-%m-%d')) FROM orders")
def a10_marker(spark, sf_dir):
    """Written twice: the last values hold."""
    folder = files.scratch(spark)
    o = read(spark, sf_dir, "orders")
    files.write_marker(spark, folder, {"status": "first", "gone": 1})
    n, latest = o.agg(F.count(F.lit(1)), F.max(F.date_format("o_orderdate", "yyyy-MM-dd"))).first()
    files.write_marker(spark, folder, {"status": "second", "n": n, "latest": latest})
    return spark.createDataFrame([(k, str(v)) for k, v in files.read_marker(spark, folder).items()], "key string, value string")


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey, c_mktsegment FROM customer")
def a13_tab_separated(spark, sf_dir):
    """Every column is text."""
    path = files.scratch(spark)
    read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").write.csv(path, sep="\t", header=True, quote="")
    return files.read_tsv(spark, path)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def a15_csv(spark, sf_dir):
    path = files.scratch(spark)
    files.write_csv(read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal"), path)
    return files.read_csv(spark, path, "s_suppkey long, s_name string, s_acctbal double")


@query("SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1")
def a16_parquet_columns(spark, sf_dir):
    path = files.scratch(spark)
    read(spark, sf_dir, "lineitem").write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path).select("l_returnflag", "l_quantity").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("SELECT p_partkey, p_brand, p_size FROM part WHERE p_size IN (1, 5, 9, 50)")
def a17_pushed_list(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size").filter(F.col("p_size").isin(1, 5, 9, 50))


@query("SELECT n_name, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1")
def a18_views(spark, sf_dir):
    """Tables as views, another one beside them, and rows from memory."""
    files.register(spark, {"fw_customer": f"{sf_dir}/customer.parquet", "fw_nation": f"{sf_dir}/nation.parquet"})
    spark.createDataFrame([("BUILDING",), ("MACHINERY",)], "segment string").createOrReplaceTempView("fw_asked")
    return spark.sql("SELECT n_name, count(*) AS n FROM fw_customer JOIN fw_nation ON n_nationkey = c_nationkey LEFT SEMI JOIN fw_asked ON segment = c_mktsegment GROUP BY n_name")


@query(r"UNPIVOT (SELECT count(COLUMNS('(.*)')) AS '\1' FROM lineitem) ON COLUMNS(*) INTO NAME column_name VALUE n")
def a21_columns_of_a_table(spark, sf_dir):
    """The columns that a table turns out to have, and how many values are in each."""
    li = read(spark, sf_dir, "lineitem")
    counts = li.agg(*[F.count(c).alias(c) for c in li.columns])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in li.columns])))


@query("SELECT o_orderpriority AS g, count(*) AS n, 1 AS runs FROM orders GROUP BY 1")
def a22_step_is_kept(spark, sf_dir):
    """A step's output is written under its schema; asked for again with the same configuration it is read, not made."""
    runner = stages.Runner(spark, files.scratch(spark), "r")
    step = lambda s, i, c: i["orders"].groupBy(F.col("o_orderpriority").alias("g")).agg(F.count(F.lit(1)).alias("n"))
    for _ in range(2):
        out = runner.step("counted", step, {"orders": read(spark, sf_dir, "orders")}, config={"k": 1})
    return out.withColumn("runs", F.lit(len(runner.ran)))


@query(
    """SELECT 'counted' AS step, 2 AS runs, o_orderpriority AS g, 2 * count(*) AS value FROM orders GROUP BY ALL
UNION ALL SELECT 'doubled', 2, o_orderpriority, 4 * count(*) FROM orders GROUP BY ALL UNION ALL SELECT 'apart', 1, o_orderpriority, max(o_orderkey) FROM orders GROUP BY ALL"""
)
def k2_steps_run_again(spark, sf_dir):
    """A changed configuration makes a step and all after it run again, and no other; what is read is of the last run."""
    runner = stages.Runner(spark, files.scratch(spark), "r")
    inputs = {"orders": read(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "g")}
    by_group = lambda i, value: i["orders"].groupBy("g").agg(value.alias("value"))
    for k in (1, 1, 2):
        runner.step("apart", lambda s, i, c: by_group(i, F.max("o_orderkey")), inputs)
        runner.step("counted", lambda s, i, c: by_group(i, F.count(F.lit(1)) * c["k"]), inputs, config={"k": k})
        runner.step("doubled", lambda s, i, c: i["counted"].withColumn("value", F.col("value") * 2), after=("counted",))
    out = [runner.read(x).select(F.lit(x).alias("step"), F.lit(runner.ran.count(x)).alias("runs"), "g", "value") for x in ("counted", "doubled", "apart")]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT vec_id, len(embedding)::INT AS d, embedding[1]::DOUBLE AS first, embedding[len(embedding)]::DOUBLE AS last FROM embeddings")
def a26_vectors(spark, sf_dir):
    path = files.scratch(spark)
    read(spark, sf_dir, "embeddings").select("vec_id", "embedding").write.parquet(path)
    e = F.col("embedding")
    return spark.read.parquet(path).select("vec_id", F.size(e).alias("d"), F.element_at(e, 1).cast("double").alias("first"), F.element_at(e, -1).cast("double").alias("last"))


@query("SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def a27_map_file(spark, sf_dir):
    path = files.scratch(spark)
    files.write_map(read(spark, sf_dir, "nation"), path, "n_nationkey", "n_name")
    table = files.read_map(spark, path, lines=True)
    c = read(spark, sf_dir, "customer").withColumn("key", F.col("c_nationkey").cast("string"))
    return c.join(table, "key", "left").select("c_custkey", F.col("value").alias("nation"))


def _tried(spark, sf_dir, when):
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("s"))
    return o.select("id", F.when(~when, F.col("s")).alias("data"), F.when(when, F.lit("failed")).alias("error"))


@query(
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 <> 0 OR o_orderstatus = 'O' THEN o_orderstatus END AS data, CASE WHEN o_orderkey % 7 = 0 AND o_orderstatus <> 'O' THEN 'failed' END AS error
FROM orders WHERE o_orderkey % 11 <> 0"""
)
def a28_result_store(spark, sf_dir):
    """A first try, a second one of what failed, and every eleventh id removed."""
    store = results.ResultStore(spark, files.scratch(spark))
    store.add(_tried(spark, sf_dir, F.col("id") % 7 == 0))
    store.add(_tried(spark, sf_dir, (F.col("id") % 7 == 0) & (F.col("s") != "O")).join(store.failed(), "id", "left_semi"))
    store.remove(store.rows().filter("id % 11 = 0"))
    return store.rows()


@query("SELECT count(*) FILTER (o_orderkey % 7 <> 0) AS done, count(*) FILTER (o_orderkey % 7 = 0) AS failed, 0::BIGINT AS left_after_clear FROM orders")
def a28_store_counts(spark, sf_dir):
    store = results.ResultStore(spark, files.scratch(spark))
    store.add(_tried(spark, sf_dir, F.col("id") % 7 == 0))
    done, failed = store.counts()
    store.clear()
    return spark.createDataFrame([(done, failed, store.rows().count())], "done long, failed long, left_after_clear long")


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderstatus = 'F'")
def c13_rows_without_ids(spark, sf_dir):
    store = results.ResultStore(spark, files.scratch(spark))
    store.add(_tried(spark, sf_dir, F.lit(False)))
    store.remove(store.rows().filter("id % 3 = 0 and data <> 'F'"))
    return store.done()


@query("SELECT count(*) AS n_total, count(*) AS n_success, 0::BIGINT AS n_failed, 2 AS waves FROM orders")
def k11_resume_and_retry(spark, sf_dir):
    """Every fifth call fails at first; only those are tried again."""
    store = results.ResultStore(spark, files.scratch(spark))
    waves = []

    def work(ids):
        waves.append(1)
        bad = (F.col("id") % 5 == 0) & F.lit(len(waves) == 1)
        return ids.select("id", F.when(~bad, "ok").alias("data"), F.when(bad, "failed").alias("error"))

    ids = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    r = results.run(ids, store, work, retries=3)
    return spark.createDataFrame([(r["n_total"], r["n_success"], r["n_failed"], len(waves))], "n_total long, n_success long, n_failed long, waves int")


@query("SELECT o_orderkey AS id, o_orderstatus AS data, CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS tries FROM orders")
def k11_batches_kept(spark, sf_dir):
    """Batches of a quarter of the orders, two at a time. The job of one of them fails, so a second call does what is
    left; the calls for every seventh order have errors at first. tries: how often an id has been answered for, so no
    batch that has ended is worked on again."""
    folder = files.scratch(spark)
    store = results.ResultStore(spark, f"{folder}/store")
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("data"))
    ids, (n, last) = o.select("id"), o.agg(F.count(F.lit(1)), F.max("id")).first()

    def work(batch, breaks=False):
        before = store.failed().withColumn("before", F.lit(True))
        rows = o.join(batch, "id", "left_semi").join(before, "id", "left")
        bad = (F.col("id") % 7 == 0) & F.col("before").isNull()
        broken = F.when(F.col("id") == last, F.raise_error(F.lit("the call broke off")).cast("string")) if breaks else F.lit(None).cast("string")
        return rows.select("id", F.when(~bad, F.col("data")).alias("data"), F.coalesce(broken, F.when(bad, F.lit("no answer"))).alias("error"))

    how = {"scratch": folder, "batch_size": max(1, n // 4), "concurrent": 2}
    try:
        results.run_batched(ids, store, lambda batch: work(batch, breaks=True), **how)
    except RuntimeError:
        pass
    results.run_batched(ids, store, work, retries=2, **how)
    tries = store.attempts().groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("tries"))
    return store.rows().select("id", "data").join(tries, "id")


@query("SELECT p_partkey AS id, upper(p_name) AS data FROM part")
def k3_work_by_batches(spark, sf_dir):
    """The plug-in is a function over Arrow-fed pandas frames."""
    store = results.ResultStore(spark, files.scratch(spark))
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_name")

    def shouted(frames):
        for f in frames:
            yield f.assign(data=f.p_name.str.upper(), error=None)[["id", "data", "error"]]

    results.run(part.select("id"), store, lambda ids: part.join(ids, "id", "left_semi").mapInPandas(shouted, "id long, data string, error string"))
    return store.rows().select("id", "data")


@query("SELECT 'val__d__m' || n_regionkey || '__x__y' AS run, 'd' AS definition, 'm' || n_regionkey AS llm, 'x' AS embedding, 'y' AS reranker, count(*) AS n FROM nation WHERE n_regionkey % 2 = 0 GROUP BY ALL")
def a29_runs_found(spark, sf_dir):
    """Folders with all the tables needed and a name in five parts, and how many rows their first table has: a run for each
    region, of which the odd ones have only one of two tables."""
    root, nation = files.scratch(spark), read(spark, sf_dir, "nation")
    regions = [r[0] for r in nation.select("n_regionkey").distinct().orderBy("n_regionkey").collect()]
    for k in regions:
        for name, made in ((f"val__d__m{k}__x__y", ("a", "b") if k % 2 == 0 else ("a",)), (f"val__d__m{k}", ("a", "b")), (f"other__d__m{k}__x__y", ("a", "b"))):
            for m in made:
                nation.filter(F.col("n_regionkey") == k).write.parquet(f"{root}/{name}/{m}")
    found = files.discover_runs(spark, root, ("a", "b"))
    rows = [spark.read.parquet(f"{root}/{r['run']}/a").agg(F.count(F.lit(1)).alias("n")).select(*[F.lit(v).alias(k) for k, v in r.items()], "n") for r in found]
    return reduce(DataFrame.unionByName, rows)


@query("SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def a30_output_of_a_run(spark, sf_dir):
    root = files.scratch(spark)
    stages.Runner(spark, root, "r").step("nations", lambda s, i, c: i["nation"].groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n")), {"nation": read(spark, sf_dir, "nation")})
    return stages.Runner(spark, root, "r").read("nations")


@query("SELECT step, state, removed, CASE WHEN step = 'whole' THEN (SELECT count(*) FROM supplier) ELSE 0 END AS n FROM (VALUES ('whole', 'COMPLETE', false), ('broken', 'INCOMPLETE', true), ('unmarked', 'INCOMPLETE', true), ('absent', 'MISSING', false)) AS t(step, state, removed)")
def a31_integrity(spark, sf_dir):
    """Unreadable files, a marker that lacks and a folder that lacks; what is not complete is removed, and what is complete
    has its rows still (n)."""
    root, supplier = files.scratch(spark), read(spark, sf_dir, "supplier")
    runner = stages.Runner(spark, root, "r")
    for name in ("whole", "broken"):
        runner.step(name, lambda s, i, c: i["supplier"], {"supplier": supplier})
    files._put(spark, f"{root}/r/broken/data/part-99999.parquet", "not parquet")
    supplier.write.parquet(f"{root}/r/unmarked/data")
    names = ["whole", "broken", "unmarked", "absent"]
    found = files.incomplete(spark, f"{root}/r", names, check_files=True)
    files.clean(spark, f"{root}/r", names, dry_run=True, check_files=True)
    assert files.incomplete(spark, f"{root}/r", names, check_files=True) == found  # a dry run removes nothing
    gone = files.clean(spark, f"{root}/r", names, dry_run=False, check_files=True)
    states = spark.createDataFrame([(k, found.get(k, "COMPLETE"), k in gone) for k in names], "step string, state string, removed boolean")
    left = runner.read("whole").agg(F.count(F.lit(1)).alias("n")).select(F.lit("whole").alias("step"), "n")
    return states.join(left, "step", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("SELECT n_name AS name, n_regionkey::BIGINT AS region, round(avg(c_acctbal), 4) AS score FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_mktsegment = 'BUILDING' GROUP BY n_nationkey, n_name, n_regionkey")
def c21_boundaries_with_scores(spark, sf_dir):
    """Attributes of a GeoJSON file's features (A35), each with its score if there is one."""
    import json

    path = files.scratch(spark)
    box = lambda k: {"type": "Polygon", "coordinates": [[[k, 0], [k + 1, 0], [k + 1, 1], [k, 0]]]}
    rows = read(spark, sf_dir, "nation").collect()
    files._put(spark, path, json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": box(r["n_nationkey"]), "properties": {"code": r["n_nationkey"], "name": r["n_name"], "region": r["n_regionkey"]}} for r in rows]}, indent=1))
    b = files.boundary_attributes(spark, path)
    c = read(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").groupBy(F.col("c_nationkey").alias("code")).agg(F.round(F.avg("c_acctbal"), 4).alias("score"))
    return b.join(c, "code", "left").select("name", "region", "score")


@query(
    """WITH RECURSIVE r AS (SELECT vec_id AS v, k, 1000 * CASE WHEN k < n THEN k WHEN k = n THEN n - 1 ELSE 0 END AS x,
  CASE WHEN k < n THEN floor(10000 * e[k + 1]::DOUBLE)::BIGINT WHEN k < n + 2 THEN -100000 ELSE floor(10000 * e[1]::DOUBLE)::BIGINT END AS y, n + 2 AS last
  FROM (SELECT vec_id, embedding AS e, len(embedding) AS n, unnest(range(0, len(embedding) + 3)) AS k FROM embeddings)),
kept AS (SELECT v, 0::BIGINT AS i, max(last) AS j, NULL::BIGINT AS put FROM r GROUP BY v
  UNION ALL (WITH f AS (SELECT s.v, s.i, s.j, max({'d': CASE
      WHEN a.x = b.x AND a.y = b.y OR (p.x - a.x) * (b.x - a.x) + (p.y - a.y) * (b.y - a.y) <= 0 THEN ((p.x - a.x) * (p.x - a.x) + (p.y - a.y) * (p.y - a.y))::DOUBLE
      WHEN (p.x - a.x) * (b.x - a.x) + (p.y - a.y) * (b.y - a.y) >= (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) THEN ((p.x - b.x) * (p.x - b.x) + (p.y - b.y) * (p.y - b.y))::DOUBLE
      ELSE pow(((p.x - a.x) * (b.y - a.y) - (p.y - a.y) * (b.x - a.x))::DOUBLE, 2) / ((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y))::DOUBLE END, 'k': -p.k}) AS m
    FROM kept s JOIN r a ON a.v = s.v AND a.k = s.i JOIN r b ON b.v = s.v AND b.k = s.j JOIN r p ON p.v = s.v AND p.k > s.i AND p.k < s.j GROUP BY ALL)
  SELECT v, CASE WHEN h = 0 THEN i ELSE -m.k END, CASE WHEN h = 0 THEN -m.k ELSE j END, -m.k FROM f, (SELECT unnest([0, 1]) AS h) WHERE m.d > 300 * 300)),
points AS (SELECT DISTINCT v, put AS k FROM kept WHERE put IS NOT NULL UNION SELECT v, 0 FROM r UNION SELECT v, last FROM r)
SELECT v AS vec_id, count(*)::INT AS n, string_agg(x || ' ' || y, ',' ORDER BY k) AS ring FROM points JOIN r USING (v, k) GROUP BY v"""
)
def a35_simplified_boundaries(spark, sf_dir):
    """A polygon for each vector, its components as heights over a base line, written as GeoJSON and read simplified."""
    path = files.scratch(spark)
    e, n = F.col("embedding"), F.size("embedding")
    point = lambda x, y: F.array(x.cast("double"), y.cast("double"))
    height = lambda x: F.floor(x.cast("double") * 10000)
    base = F.lit(-100000)
    ring = F.concat(F.transform(e, lambda x, k: point(k * 1000, height(x))), F.array(point((n - 1) * 1000, base), point(F.lit(0), base), point(F.lit(0), height(e[0]))))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct("vec_id").alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    read(spark, sf_dir, "embeddings").select(F.to_json(feature)).write.text(path)
    b = files.boundaries(spark, path, tolerance=300, lines=True)
    points = F.from_json("geometry.coordinates", "array<array<array<double>>>")[0]
    return b.select("vec_id", F.size(points).alias("n"), F.array_join(F.transform(points, lambda p: F.concat_ws(" ", p[0].cast("long"), p[1].cast("long"))), ",").alias("ring"))


@query("SELECT c_custkey AS key, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS balance, c_custkey % 2 = 0 AS even, TIMESTAMP '2020-01-31 06:30:00' + to_days((c_custkey % 1000)::INT) AS since FROM customer")
def a14_workbooks(spark, sf_dir):
    """Customers as workbooks of 500 rows, and read again: whole numbers, numbers, truth values, dates, text, empty cells."""
    folder, k = files.scratch(spark), F.col("c_custkey")
    since = F.timestamp_add("DAY", (k % 1000).cast("int"), F.lit("2020-01-31 06:30:00").cast("timestamp"))
    c = read(spark, sf_dir, "customer").select(k.alias("key"), F.col("c_name").alias("name"), F.when(k % 3 != 0, F.col("c_acctbal")).alias("balance"), (k % 2 == 0).alias("even"), since.alias("since"))
    workbook.write_workbooks(c, folder, "Customers", 500)
    return workbook.read_workbook(spark, folder, "Customers").withColumn("since", F.col("since").cast("timestamp_ntz"))


@query("SELECT count(*) AS n, count(DISTINCT o_orderkey) AS n_ids, min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders")
def a37_ids(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"), F.min("id").alias("first"), F.max("id").alias("last"))


@query("SELECT s_suppkey AS id, 's_name: ' || left(s_name, 12) || CASE WHEN length(s_name) > 12 THEN '...' ELSE '' END || chr(10) || 's_nationkey: ' || s_nationkey AS shown FROM supplier")
def a38_shown(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), "s_name", F.col("s_nationkey").cast("string").alias("s_nationkey"))
    return ads.as_lines(s, 12)


@query("SELECT o_orderkey, o_orderpriority AS name_order, c_mktsegment AS name_customer FROM orders JOIN customer ON c_custkey = o_custkey")
def b18_suffixes(spark, sf_dir):
    """Columns of one name on both sides get a suffix each."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("name"))
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("name"))
    return columns.joined(o, c, "k", ("_order", "_customer")).drop("k")


MODELS = """WITH m AS (SELECT DISTINCT l_returnflag AS l, l_linestatus AS e, l_linenumber::VARCHAR AS r FROM lineitem),
l AS (SELECT DISTINCT l FROM m), e AS (SELECT DISTINCT e FROM m), r AS (SELECT DISTINCT r FROM m), f AS (SELECT min(l) AS l, min(e) AS e, min(r) AS r FROM m)
"""


def models(spark, sf_dir):
    """The models of each kind that the table names, in order."""
    li = read(spark, sf_dir, "lineitem").agg(F.array_sort(F.collect_set("l_returnflag")).alias("llm"), F.array_sort(F.collect_set("l_linestatus")).alias("embedding"), F.array_sort(F.collect_set(F.col("l_linenumber").cast("string"))).alias("reranker"))
    return li.first().asDict()


@query(
    MODELS + """, n AS (SELECT unnest(range(1, greatest((SELECT count(*) FROM l), (SELECT count(*) FROM e), (SELECT count(*) FROM r)) + 1)) AS i)
SELECT coalesce(a.l, f.l) AS llm, coalesce(b.e, f.e) AS embedding, coalesce(c.r, f.r) AS reranker FROM n CROSS JOIN f LEFT JOIN (SELECT l, row_number() OVER (ORDER BY l) AS i FROM l) a USING (i)
LEFT JOIN (SELECT e, row_number() OVER (ORDER BY e) AS i FROM e) b USING (i) LEFT JOIN (SELECT r, row_number() OVER (ORDER BY r) AS i FROM r) c USING (i)"""
)
def f10_job_plan(spark, sf_dir):
    plan = cost.job_plan(models(spark, sf_dir))
    return spark.createDataFrame([(p["llm"], p["embedding"], p["reranker"]) for p in plan], "llm string, embedding string, reranker string")


@query(MODELS + "SELECT l.l AS llm, f.e AS embedding, f.r AS reranker FROM l, f UNION SELECT f.l, e.e, f.r FROM e, f UNION SELECT f.l, f.e, r.r FROM r, f")
def f8_planned_runs(spark, sf_dir):
    """Each kind of model varied over those that the table names, with the first of the other kinds."""
    found = models(spark, sf_dir)
    plan = cost.planned_runs({k: v[:1] for k, v in found.items()}, found)
    return spark.createDataFrame([(p["llm"], p["embedding"], p["reranker"]) for p in plan], "llm string, embedding string, reranker string")


@query(
    """SELECT '' AS step, r_name AS name, (r_regionkey + CASE WHEN r_regionkey % 2 = 1 THEN 100 ELSE 0 END)::VARCHAR AS value FROM region
UNION ALL SELECT 'step' || n_regionkey, n_name, (n_nationkey + CASE WHEN n_nationkey % 3 = 0 THEN 100 ELSE 0 END)::VARCHAR FROM nation"""
)
def k10_resolved_values(spark, sf_dir):
    """Defaults, overridden by the run; a table is a step's own. Regions are values of all steps, nations of one; the run
    has others for every second region and every third nation."""
    regions = [(r["r_name"], r["r_regionkey"]) for r in read(spark, sf_dir, "region").collect()]
    nations = [(f"step{r['n_regionkey']}", r["n_name"], r["n_nationkey"]) for r in read(spark, sf_dir, "nation").collect()]
    steps = {s for s, _, _ in nations}
    defaults = {**dict(regions), **{s: {n: k for t, n, k in nations if t == s} for s in steps}}
    run = {**{n: k + 100 for n, k in regions if k % 2}, **{s: {n: k + 100 for t, n, k in nations if t == s and k % 3 == 0} for s in steps}}
    common, own = stages.resolve({"defaults": defaults, "runs": {"r": run}}, "r")
    rows = [("", k, str(v)) for k, v in common.items()] + [(s, k, str(v)) for s, d in own.items() for k, v in d.items()]
    return spark.createDataFrame(rows, "step string, name string, value string")


@query("SELECT p_partkey AS id, (len(regexp_extract_all(p_name, '[0-9A-Za-z_]+')) + 1)::DOUBLE AS words, 64 AS d FROM part")
def h4_embedded(spark, sf_dir):
    """The stand-in's vectors count words (one more for the prefix), so their sums are known."""
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_name")
    out = providers.embedded(part, "p_name", {"mode": "standin", "prefix": "query "})
    return out.select("id", F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x).alias("words"), F.size("embedding").alias("d"))


class Lengths:
    """A provider that says how long a text is, for the registry's query."""

    def embed(self, texts):
        return np.array([[len(t)] for t in texts], np.float32)


@query("SELECT s_suppkey AS id, length(s_name)::DOUBLE AS n FROM supplier")
def k4_registered_provider(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), "s_name")
    with providers.registered("lengths", Lengths):
        return providers.embedded(s, "s_name", {"mode": "lengths"}).select("id", F.col("embedding")[0].cast("double").alias("n"))


@query(
    """SELECT p_partkey, round(exp(-p_size / 10.0::DOUBLE) / (exp(-p_size / 10.0::DOUBLE) + exp(-p_retailprice / 1000)), 6) AS yes,
round(list_sum(list_transform(range(1, 8), lambda i: i * exp(-abs(i - p_size % 8)))) / list_sum(list_transform(range(1, 8), lambda i: exp(-abs(i - p_size % 8)))), 6) AS rating FROM part"""
)
def h8_from_log_probabilities(spark, sf_dir):
    """A pair's score from the log-probabilities of yes and no, and from those of the ratings 1 to 7."""
    ratings = F.transform(F.sequence(F.lit(1), F.lit(7)), lambda i: -F.abs(i - F.col("p_size") % 8).cast("double"))
    p = read(spark, sf_dir, "part")
    return p.select("p_partkey", F.round(columns.yes_probability(-F.col("p_size") / 10.0, -F.col("p_retailprice") / 1000), 6).alias("yes"), F.round(columns.expected_rating(ratings), 6).alias("rating"))


@query(
    """WITH r AS (SELECT p_partkey AS id, p_size % 4 AS e, (p_size % 13) / 10.0::DOUBLE AS c FROM part)
SELECT id, CASE WHEN e > 2 THEN 'exposure must be 0, 1, or 2, got ' || e WHEN c > 1 THEN 'confidence must be in [0, 1], got ' || c END AS error FROM r"""
)
def k6_rated_tasks(spark, sf_dir):
    """Answers on a task's exposure, with what is wrong with each."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.to_json(F.struct(F.lit("o").alias("occupation"), F.lit("t").alias("task"), F.lit("r").alias("reasoning"), (F.col("p_size") % 4).alias("exposure"), (F.col("p_size") % 13 / 10.0).alias("confidence_0to1"))).alias("data"))
    return matching.rated_tasks(p).select("id", "error")


@query("SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'B' END AS outcome, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'ValidationError: more_exposed must be A, B or tie' END AS error FROM orders")
def k6_pair_answers(spark, sf_dir):
    said = F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "B").otherwise("C")
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.to_json(F.struct(said.alias("more_exposed"))).alias("data"))
    return matching.pair_answers(o).select("id", "outcome", "error")


@query("SELECT p_partkey, sha256('{\"brand\": \"' || p_brand || '\", \"size\": ' || p_size || '}') AS digest FROM part WHERE p_size <= 50")
def k_config_digest(spark, sf_dir):
    """SHA-256 of a configuration in sorted keys, as files.digest has it for one on the driver."""
    text = F.concat(F.lit('{"brand": "'), F.col("p_brand"), F.lit('", "size": '), F.col("p_size").cast("string"), F.lit("}"))
    out = read(spark, sf_dir, "part").filter("p_size <= 50").select("p_partkey", "p_brand", "p_size", F.sha2(text, 256).alias("digest"))
    one = out.first()
    assert one is None or one["digest"] == files.digest({"size": one["p_size"], "brand": one["p_brand"]})
    return out.select("p_partkey", "digest")


@query(
    """WITH r AS (SELECT l_linenumber % 2 = 0 AS first, l_orderkey AS ad, l_partkey AS code, l_partkey % 5 + 1 AS rating FROM lineitem)
SELECT CASE WHEN first THEN 'first' ELSE 'second' END AS ranking, rating, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY first)::DOUBLE, 6) AS share FROM (SELECT DISTINCT * FROM r) GROUP BY first, rating"""
)
def i18_rating_distribution(spark, sf_dir):
    r = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("ad"), F.col("l_partkey").alias("code"), "l_linenumber").distinct()
    ratings = r.select("ad", "code", (F.col("code") % 5 + 1).alias("rating")).distinct()
    side = lambda k: r.filter(F.col("l_linenumber") % 2 == k).select("ad", "code").distinct()
    out = agreement.rating_distribution({"first": side(0), "second": side(1)}, ratings)
    return out.withColumn("share", F.round("share", 6))


