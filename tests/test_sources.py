"""Sources, results, the stage runner and the stream."""

import json
import os

import pytest
from pyspark.sql import functions as F

from fernworks.functions import columns, geometry
from fernworks.plans import cost, providers, stages
from fernworks.sources import ads, files, results, workbook
from fernworks.streaming import ingest


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)


def test_loading_keeps_the_earliest_and_skips_months(spark, tmp_path):
    base, store = str(tmp_path / "raw"), str(tmp_path / "ads")
    put(f"{base}/year=2024/month=1", "a.json", [{"id": 1, "title": "late", "date_created": "2024-01-09"}, {"id": 1, "title": "early", "date_created": "2024-01-02"}, {"id": 2, "title": "undated"}, {"id": 2, "title": "dated", "date_created": "2024-01-03"}])
    put(f"{base}/year=2023/month=12", "b.jsonl", [{"id": 3, "title": "old", "SIC1": "7"}])
    put(f"{base}/year=2023/month=12", "c.txt", [{"id": 4}])
    assert ads.load(spark, base, store, [2024]) == 2
    assert sorted((r["id"], r["title"]) for r in spark.read.parquet(store).collect()) == [(1, "early"), (2, "dated")]
    assert ads.load(spark, base, store) == 1 and ads.load(spark, base, store) == 0
    assert ads.loaded_months(spark, store).count() == 2
    assert ads.by_id(spark.read.parquet(store), spark.createDataFrame([(3,)], "id long"), ["title"]).first().asDict() == {"id": 3, "title": "old"}


def test_an_earlier_row_replaces_the_stored_one(spark, tmp_path):
    base, store = str(tmp_path / "raw"), str(tmp_path / "ads")
    put(f"{base}/year=2024/month=2", "a.json", [{"id": 5, "title": "february", "date_created": "2024-02-03"}, {"id": 6, "title": "undated"}, {"id": 7, "title": "stays", "date_created": "2024-01-01"}])
    put(f"{base}/year=2024/month=3", "a.json", [{"id": 8, "title": "march", "date_created": "2024-03-03"}])
    assert ads.load(spark, base, store) == 4
    put(f"{base}/year=2024/month=1", "a.json", [{"id": 5, "title": "january", "date_created": "2024-01-03"}, {"id": 6, "title": "dated", "date_created": "2024-01-09"}, {"id": 7, "title": "equal", "date_created": "2024-01-01"}, {"id": 8, "title": "sooner", "date_created": "2024-01-02"}, {"id": 9, "title": "new"}])
    assert ads.load(spark, base, store) == 1
    rows = spark.read.parquet(store).collect()
    assert sorted((r["id"], r["title"], r["month"]) for r in rows) == [(5, "january", 1), (6, "dated", 1), (7, "stays", 2), (8, "sooner", 1), (9, "new", 1)]
    assert sorted(os.listdir(tmp_path)) == ["ads", "raw"]


def test_schema(spark):
    assert len(ads.ADS) == 33
    h = ads.harmonised(spark.createDataFrame([(1, 5, "x")], "id long, SIC1 int, salary_min string"), year=2024, month=2)
    assert h.schema.simpleString() == ads.ADS.simpleString() and h.first()["SIC1"] == "5" and h.first()["salary_min"] is None


def test_result_store(spark, tmp_path):
    s = results.ResultStore(spark, str(tmp_path / "r"))
    assert s.counts() == (0, 0)
    s.add(spark.createDataFrame([(1, "a", None), (2, None, "bad"), (3, "c", None)], "id long, data string, error string"))
    assert s.counts() == (2, 1) and s.failed().first()[0] == 2
    s.add(spark.createDataFrame([(2, "b", None)], "id long, data string, error string"))
    assert s.counts() == (3, 0)
    s.remove(spark.createDataFrame([(1,)], "id long"))
    assert s.counts() == (2, 0)
    s.clear()
    assert s.counts() == (0, 0)


def test_resume_and_retry(spark, tmp_path):
    tried = []

    def work(ids):
        n = len(tried)
        tried.append(sorted(r[0] for r in ids.collect()))
        return ids.select("id", F.lit("ok").alias("data"), F.when(F.lit(n == 0) & (F.col("id") == 2), "bad").alias("error"))

    s = results.ResultStore(spark, str(tmp_path / "r"))
    ids = spark.range(1, 4)
    assert results.run(ids, s, work, retries=2)["n_success"] == 3 and tried == [[1, 2, 3], [2]]
    assert results.run(spark.range(1, 5), s, work)["n_total"] == 4 and tried[-1] == [4]
    with pytest.raises(RuntimeError):
        results.run(spark.range(9, 10), s, lambda i: i.select("id", F.lit(None).cast("string").alias("data"), F.lit("no").alias("error")))


def test_digest():
    assert files.digest({"a": 1, "b": 2}) == files.digest({"b": 2, "a": 1}) != files.digest({"a": 1})
    assert files.digest({"a": 1, "jobs": 9}, ("jobs",)) == files.digest({"a": 1})


def test_run_definitions():
    d = {"defaults": {"k": 5, "embed": {"model": "x", "batch": 1}}, "runs": {"r": {"k": 7, "embed": {"model": "y"}}}}
    assert stages.resolve(d, "r") == ({"k": 7}, {"embed": {"model": "y", "batch": 1}})
    for bad in (None, "", "zz"):
        with pytest.raises(ValueError):
            stages.resolve(d, bad)


def test_chain_runs_once(spark, tmp_path):
    a = spark.createDataFrame([(100, "CEO", "leads the company"), (200, "Python Developer", None)], "id long, title string, description string")
    o = spark.createDataFrame([("1", "Chief executives", "leads", ["CEO"], ["plan"]), ("2", "Software developers", "python", [], ["code"]), ("3", "Nurses", "care", [], ["care"])], "onet_code string, title string, description string, alternate_titles array<string>, top_tasks array<string>")
    s = spark.createDataFrame([("1", 0.2), ("2", 0.9), ("3", 0.1)], "onet_code string, score double")
    out = stages.match_ads(spark, a, o, s, str(tmp_path), "r", {"k": 3})
    assert out.count() == 2 and out.filter("n_matches = 2").count() == 2
    assert files.incomplete(spark, f"{tmp_path}/r", ["embed_ads", "reranked", "nothing"]) == {"nothing": "MISSING"}
    os.remove(tmp_path / "r" / "reranked" / files.MARKER)
    assert files.clean(spark, f"{tmp_path}/r", ["reranked"]) == ["reranked"] and (tmp_path / "r" / "reranked").exists()
    assert files.clean(spark, f"{tmp_path}/r", ["reranked"], dry_run=False) == ["reranked"] and not (tmp_path / "r" / "reranked").exists()
    runner = stages.Runner(spark, str(tmp_path), "q")
    one = lambda s, i, c: s.range(c["n"])
    runner.step("x", one, config={"n": 2})
    runner.step("x", one, config={"n": 2})
    assert runner.ran == ["x"] and runner.step("x", one, config={"n": 3}).count() == 3 and runner.ran == ["x", "x"]


def test_provider_failures_are_rows(spark, monkeypatch):
    p = providers.Standin(8)
    assert (p.embed(["a b", ""]).sum(1) == [2, 0]).all() and p.rerank(["a b"], ["b c"]) == [1 / 3] and p.rerank([""], [""]) == [0.0]
    both = spark.createDataFrame([(0.0, [0.0] * 7)], "x double, r array<double>").select(columns.yes_probability(F.col("x"), F.col("x")), columns.expected_rating(F.col("r"))).first()
    assert tuple(both) == (0.5, 4.0)
    out = providers.generated(spark.createDataFrame([(1, "1. a\n2. b")], "id long, prompt string"), "prompt", {"mode": "standin"})
    assert out.first().asDict() == {"id": 1, "data": '{"keep": [1]}', "error": None}


def test_cost():
    e = cost.estimate({"filter": 3600.0, "rerank": 1800.0}, 10)
    assert e["total"] == {"hours": 15.0, "node_hours": 3.75}
    assert cost.job_plan({"llm": ["a", "b"], "embed": ["x"], "rerank": []}) == [{"llm": "a", "embed": "x", "rerank": None}, {"llm": "b", "embed": "x", "rerank": None}]


def test_runs_and_files(spark, tmp_path):
    for n in ("val__d__l__e__r", "val__d__l__e", "val__d__l2__e__r"):
        os.makedirs(tmp_path / n)
    (tmp_path / "val__d__l__e__r" / "x").touch()
    assert [r["llm"] for r in files.discover_runs(spark, str(tmp_path), ("x",))] == ["l"]
    (tmp_path / "t.txt").write_text('a\tb\n1\tsay "x"\n')
    assert files.read_tsv(spark, str(tmp_path / "t.txt")).first().asDict() == {"a": "1", "b": 'say "x"'}
    (tmp_path / "m.json").write_text('{"b": "2", "a": "1"}')
    assert sorted(tuple(r) for r in files.read_map(spark, str(tmp_path / "m.json")).collect()) == [("a", "1"), ("b", "2")]
    entries = [("k\n", 'a "b"'), ("ü", ""), ("x", None)]
    files.write_map(spark.createDataFrame(entries, "key string, value string"), str(tmp_path / "m"))
    assert sorted(tuple(r) for r in files.read_map(spark, str(tmp_path / "m"), lines=True).collect()) == sorted(entries)
    (tmp_path / "g.json").write_text(json.dumps({"features": [{"properties": {"LAD22CD": "E09"}, "geometry": None}]}))
    assert files.boundary_attributes(spark, str(tmp_path / "g.json")).first()["LAD22CD"] == "E09"
    files.write_csv(spark.range(8).repartition(3), str(tmp_path / "c"))
    assert sorted(r[0] for r in files.read_csv(spark, str(tmp_path / "c"), "id long").collect()) == list(range(8))
    assert len([x for x in os.listdir(tmp_path / "c") if x.endswith(".csv")]) == 3
    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert files.readable(spark, str(tmp_path / "p")) and not files.readable(spark, str(tmp_path / "none"))


def test_stream(spark, tmp_path):
    put(str(tmp_path / "in"), "a.json", [{"id": 1, "title": "x", "date_created": "2024-01-01 00:00:00"}, {"id": 1, "title": "y", "date_created": "2024-01-01 01:00:00"}, {"id": 2, "title": "z", "date_created": "2024-01-01 00:00:00"}])
    q = ingest.write(ingest.first_arrived(ingest.read_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_planned_runs():
    fixed, models = {"llm": ["a"], "embedding": ["x"]}, {"llm": ["a", "b"], "embedding": ["x", "y"]}
    assert cost.planned_runs(fixed, models) == [{"llm": "a", "embedding": "x"}, {"llm": "b", "embedding": "x"}, {"llm": "a", "embedding": "y"}]


def test_prompts():
    assert providers.prompt_options({"supports_prompt": True, "query_prompt_name": "q", "query_prefix": "p: "}, "task") == ("p: ", {"prompt": "task"})
    assert providers.prompt_options({"query_prompt_name": "q"}, "task") == ("", {"prompt_name": "q"}) and providers.prompt_options({}) == ("", {})


def test_views(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "v"))
    files.register(spark, {"three": str(tmp_path / "v")})
    assert spark.sql("SELECT count(*) FROM three").first()[0] == 3


def test_fixed_arms(spark):
    from fernworks.operators import agreement

    runs = spark.createDataFrame([("val__d__a__x__r",), ("val__d__b__x__r",), ("val__d__b__y__r",), ("other",)], "run string")
    assert agreement.arms(runs).count() == 4
    only = agreement.arms(runs, {"llm": ["a"], "embedding": ["x"], "reranker": ["r"]}).collect()
    assert sorted((r["arm"], r["fixed"], r["run"]) for r in only) == [("llm", "x + r", "val__d__a__x__r"), ("llm", "x + r", "val__d__b__x__r")]


def _failing(bad):
    return lambda batch: batch.select("id", F.when(~bad, "ok").alias("data"), F.when(bad, "no").alias("error"))


def test_batches_are_kept_as_they_end(spark, tmp_path):
    """The worker of one batch dies: the others' results stay, and a second call does the rest."""
    s = results.ResultStore(spark, str(tmp_path / "r"))
    ids = spark.range(40).union(spark.range(5)).union(spark.createDataFrame([(None,)], "id long"))
    dies = tmp_path / "dies"
    dies.write_text("")

    def called(frames):
        for f in frames:
            if dies.exists() and (f.id == 17).any():
                os._exit(1)
            yield f.assign(data="ok", error=None)

    how = {"scratch": str(tmp_path / "b"), "batch_size": 10}
    work = lambda batch: batch.mapInPandas(called, "id long, data string, error string")
    with pytest.raises(RuntimeError, match="what has ended is kept"):
        results.run_batched(ids, s, work, concurrent=2, **how)
    kept = {r[0] for r in s.done().collect()}
    assert 17 not in kept and len(kept) < 40
    dies.unlink()
    assert results.run_batched(ids, s, work, concurrent=3, **how)["n_success"] == 40
    assert s.attempts().count() == 40  # nothing was worked on twice
    assert results.run_batched(ids, s, work, **how)["batches"] == 0
    assert results.run_batched(ids, s, work, resume=False, **how)["batches"] == 4


def test_batches_run_at_the_same_time(spark, tmp_path):
    """Two batches that each wait for the other end only if both are under way."""
    s = results.ResultStore(spark, str(tmp_path / "r"))
    here = str(tmp_path)

    def called(frames):
        import time

        for f in frames:
            if len(f):
                open(f"{here}/began-{f.id.min()}", "w").close()
                until = time.time() + 60
                while len([x for x in os.listdir(here) if x.startswith("began")]) < 2:
                    assert time.time() < until
                    time.sleep(0.05)
            yield f.assign(data="ok", error=None)

    r = results.run_batched(spark.range(16), s, lambda b: b.coalesce(1).mapInPandas(called, "id long, data string, error string"), scratch=f"{here}/b", batch_size=8, concurrent=2, pool="calls")
    assert r["batches"] == 2 and r["n_success"] == 16


def test_batches_try_again_and_keep_faults_as_rows(spark, tmp_path):
    how = {"scratch": str(tmp_path / "b"), "batch_size": 4}
    s = results.ResultStore(spark, str(tmp_path / "r"))
    seen = []

    def work(batch):
        seen.append(sorted(r[0] for r in batch.collect()))
        return _failing((F.col("id") % 5 == 0) & F.lit(len(seen) <= 3))(batch)

    r = results.run_batched(spark.range(1, 13), s, work, retries=2, **how)
    assert (r["n_total"], r["n_success"], r["n_failed"]) == (12, 12, 0) and sorted(x for b in seen[3:] for x in b) == [5, 10]
    with pytest.raises(RuntimeError, match="have failed"):
        results.run_batched(spark.range(20, 22), s, _failing(F.lit(True)), **how)
    t = results.ResultStore(spark, str(tmp_path / "t"))

    def breaks(batch):
        if batch.filter("id = 7").count():
            raise ValueError("broke off")
        return _failing(F.lit(False))(batch)

    r = results.run_batched(spark.range(16), t, breaks, faults="rows", must_succeed=False, concurrent=2, **how)
    assert 0 < r["n_failed"] < 16 and 7 in r["first_failed"] and {x["error"] for x in t.rows().filter("error is not null").collect()} == {"broke off"}
    assert results.run_batched(spark.range(16), t, _failing(F.lit(False)), **how)["n_success"] == 16
    assert results.run_batched(spark.range(0), t, breaks, **how)["n_total"] == 0
    for bad in ({"faults": "x"}, {"concurrent": 0}):
        with pytest.raises(ValueError):
            results.run_batched(spark.range(3), t, breaks, **how | bad)


def test_attempts_do_not_follow_a_clock(spark, tmp_path, monkeypatch):
    s = results.ResultStore(spark, str(tmp_path / "r"))
    for n in range(3):
        monkeypatch.setattr("time.time_ns", lambda n=n: -n)
        s.add(spark.createDataFrame([(1, f"v{n}", None)], "id long, data string, error string"))
    assert s.rows().first()["data"] == "v2" and s.next_attempt() == 4


def test_kept_tables(spark):
    a = files.kept(spark.range(3).withColumn("x", F.rand()))
    assert a.collect() == a.collect()
    files.forget(spark)
    with pytest.raises(Exception, match="PATH|FILE|exist"):
        a.count()


def _workbook(sheets, shared=(), formats=(), since_1904=False):
    """A workbook of given sheets' XML rows, with shared strings and the number formats of its styles."""
    import io
    import zipfile

    m, o = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"', "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {m} xmlns:r="{o}"><workbookPr date1904="{int(since_1904)}"/><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="/xl/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f"<sst {m}>" + "".join(shared) + "</sst>")
        z.writestr("xl/styles.xml", f"<styleSheet {m}><numFmts>" + "".join(f'<numFmt numFmtId="{170 + i}" formatCode="{c}"/>' for i, c in enumerate(formats)) + "</numFmts><cellXfs><xf/><xf numFmtId=\"14\"/>" + "".join(f'<xf numFmtId="{170 + i}"/>' for i in range(len(formats))) + "</cellXfs></styleSheet>")
        for i, rows in enumerate(sheets.values()):
            z.writestr(f"xl/s{i}.xml", f"<worksheet {m}><sheetData>{rows}</sheetData></worksheet>")
    return out.getvalue()


def test_cells_of_a_workbook(spark, tmp_path):
    rows = (
        '<row r="2"><c r="B2" t="s"><v>0</v></c><c r="C2" t="inlineStr"><is><t>when</t></is></c><c r="D2" t="s"><v>0</v></c><c r="E2" t="str"><v>f</v></c></row><row r="3"/>'
        '<row r="5"><c r="A5"><v>1</v></c><c r="B5" t="s"><v>1</v></c><c r="C5" s="1"><v>43861.25</v></c><c r="D5" t="b"><v>1</v></c><c r="E5"><v>2.5</v></c><c r="AB5"><v>9</v></c></row>'
        '<row><c><v>-3</v></c><c r="C6" s="2"><v>1</v></c><c r="D6" t="e"><v>#N/A</v></c><c r="E6"><v>1E3</v></c></row>'
    )
    shared = ["<si><r><t>na</t></r><r><t>me</t></r><rPh><t>no</t></rPh></si>", "<si><t>a_x000A_b &amp; c</t></si>"]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.xlsx").write_bytes(_workbook({"first": "", "Appendix D": rows}, shared, ["yyyy\\-mm"]))
    out = workbook.read_workbook(spark, str(tmp_path / "w"), "Appendix D")
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [("Unnamed: 0", "bigint"), ("name", "string"), ("when", "timestamp"), ("name.1", "boolean"), ("f", "double")]
    got = sorted((tuple(r) for r in out.withColumn("when", F.col("when").cast("string")).collect()), reverse=True)
    assert got == [(1, "a\nb & c", "2020-01-31 06:00:00", True, 2.5), (-3, None, "1900-01-01 00:00:00", None, 1000.0)]
    assert workbook.read_workbook(spark, str(tmp_path / "w")).columns == []  # an empty sheet
    with pytest.raises(Exception, match="no sheet 'other'"):
        workbook.read_workbook(spark, str(tmp_path / "w"), "other")
    (tmp_path / "w" / "b.xlsx").write_bytes(_workbook({"Appendix D": '<row r="1"><c r="A1" t="inlineStr"><is><t>x</t></is></c></row>'}))
    with pytest.raises(ValueError, match="differ"):
        workbook.read_workbook(spark, str(tmp_path / "w"), "Appendix D")
    assert list(workbook.rows_of(_workbook({"s": '<row r="1"><c r="A1" s="1"><v>0</v></c></row>'}, since_1904=True))) == [(1, ["1904-01-01 00:00:00"], "d")]
    assert [workbook._shows_dates(c) for c in ("0.00", "[Red]0", '"day" 0', "h:mm", "[h]:mm", "General")] == [False, False, False, True, True, False]


def test_workbooks_there_and_back(spark, tmp_path):
    rows = [(1, "a <b> & \"c\" _x0041_ \x01 é\n", 0.1, True, None), (None, "", -1e-300, None, None), (2**40, None, None, False, None)]
    d = spark.createDataFrame(rows, "k long, `t x` string, v double, b boolean, none string").coalesce(1)
    assert workbook.write_workbooks(d, str(tmp_path / "w"), "S & S", 2) == 2
    out = workbook.read_workbook(spark, str(tmp_path / "w"), "S & S")
    assert out.columns == d.columns
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted(rows, key=key)
    assert workbook.write_workbooks(d.limit(0), str(tmp_path / "none")) == 0
    with pytest.raises(ValueError):
        workbook.write_workbooks(d, str(tmp_path / "x"), rows_each=1 << 21)


def _plain_kept(points, tolerance):
    """Which points stay, by recursion."""
    import math

    def away(p, a, b):
        size = (b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2
        along = (p[0] - a[0]) * (b[0] - a[0]) + (p[1] - a[1]) * (b[1] - a[1])
        t = 0 if not size else min(1, max(0, along / size))
        return math.dist(p, (a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))

    def go(i, j):
        if j - i < 2:
            return []
        k = max(range(i + 1, j), key=lambda k: (round(away(points[k], points[i], points[j]), 9), -k))
        return [*go(i, k), k, *go(k, j)] if away(points[k], points[i], points[j]) > tolerance + 1e-9 else []

    return [0, *go(0, len(points) - 1), len(points) - 1]


def test_simplified_lines():
    import numpy as np

    rng = np.random.default_rng(0)
    for n in (2, 3, 10, 60):
        for tolerance in (0.5, 2.0, 7.0):
            line = np.cumsum(rng.normal(size=(n, 2)), axis=0)
            ring = np.vstack([line, line[:1]])
            for points in (line, ring):
                assert np.flatnonzero(geometry.kept_points(points, tolerance)).tolist() == _plain_kept(points.tolist(), tolerance)


def test_simplified_rings_stay_rings():
    import numpy as np

    angle = np.linspace(0, 2 * np.pi, 401)
    circle = np.column_stack([np.cos(angle), np.sin(angle)]) * 100
    circle[-1] = circle[0]
    few = geometry.simple_ring(circle, 1.0)
    assert 4 < len(few) < 60 and (few[0] == few[-1]).all()
    assert len(geometry.simple_ring(circle, 1000.0)) == 4  # never under four
    inner = circle * 0.995  # with the same tolerance the rings would cross
    assert not geometry.crosses([circle, inner])
    both = geometry.simple_polygon([circle, inner[:, :] * [1, 1]], 3.0)
    assert not geometry.crosses(both) and all((r[0] == r[-1]).all() for r in both)
    assert geometry.crosses([np.array([[0, 0], [2, 2], [2, 0], [0, 2], [0, 0.0]])])
    square = np.array([[0, 0], [2, 0], [2, 2], [0, 2], [0, 0.0]])
    assert not geometry.crosses([square]) and geometry.crosses([square, square + 1]) and not geometry.crosses([square, square / 2 + 0.5])
    assert geometry.simple_polygon([square], 0)[0] is square


def test_boundaries(spark, tmp_path):
    n = 50
    ring = [[float(i), (i % 2) * 0.01] for i in range(n)] + [[n - 1.0, 40.0], [0.0, 40.0], [0.0, 0.0]]
    shapes = [{"type": "Polygon", "coordinates": [ring]}, {"type": "MultiPolygon", "coordinates": [[ring], [[[0, 50], [9, 50], [9, 59], [0, 50]]]]}, {"type": "Point", "coordinates": [1, 2]}, None, {"type": "Polygon", "coordinates": []}]
    features = [{"type": "Feature", "properties": {"code": i, "name": f"n{i}"}, "geometry": g} for i, g in enumerate(shapes)]
    (tmp_path / "g.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    (tmp_path / "g.jsonl").write_text("\n".join(map(json.dumps, features)))
    for name, lines in (("g.json", False), ("g.jsonl", True)):
        same = {r["code"]: r for r in files.boundaries(spark, str(tmp_path / name), lines=lines).collect()}
        assert [json.loads(same[i]["geometry"]["coordinates"]) if shapes[i] else same[i]["geometry"] for i in range(5)] == [g and g["coordinates"] for g in shapes]
        less = {r["code"]: r["geometry"] for r in files.boundaries(spark, str(tmp_path / name), 0.1, lines=lines).collect()}
        corners = [[0, 0], [49, 0.01], [49, 40], [0, 40], [0, 0]]
        assert json.loads(less[0]["coordinates"]) == [corners] and json.loads(less[1]["coordinates"])[0] == [corners]
        assert json.loads(less[2]["coordinates"]) == [1, 2] and less[3] is None and json.loads(less[4]["coordinates"]) == []
    (tmp_path / "bad.json").write_text('{"features": [{"x": 1}]}')
    with pytest.raises(ValueError):
        files.boundaries(spark, str(tmp_path / "bad.json"))


def _ads_of(spark, store):
    return sorted((r["id"], r["title"], r["year"], r["month"]) for r in spark.read.parquet(store).collect())


@pytest.mark.parametrize("at", ["marker", "first write", "second write", "clean up"])
def test_a_load_that_stops_is_finished_by_the_next(spark, tmp_path, monkeypatch, at):
    """Whatever step it stops at, the next load leaves what one load without a stop would have."""
    base, store = str(tmp_path / "raw"), str(tmp_path / "ads")
    put(f"{base}/year=2024/month=2", "a.json", [{"id": 5, "title": "february", "date_created": "2024-02-03"}, {"id": 7, "title": "stays", "date_created": "2024-01-01"}])
    put(f"{base}/year=2024/month=3", "a.json", [{"id": 8, "title": "march", "date_created": "2024-03-03"}])
    ads.load(spark, base, store)
    put(f"{base}/year=2024/month=1", "a.json", [{"id": 5, "title": "january", "date_created": "2024-01-03"}, {"id": 7, "title": "equal", "date_created": "2024-01-01"}, {"id": 8, "title": "sooner", "date_created": "2024-01-02"}, {"id": 9, "title": "new"}])
    calls = []

    def stops(name, number):
        real = getattr(ads, name)

        def stopping(*a, **k):
            calls.append(name)
            if calls.count(name) == number:
                raise KeyboardInterrupt
            return real(*a, **k)

        monkeypatch.setattr(ads, name, stopping)

    stops(*{"marker": ("write_marker", 1), "first write": ("spread", 1), "second write": ("spread", 2), "clean up": ("_delete", 2)}[at])
    before = _ads_of(spark, store)
    with pytest.raises(KeyboardInterrupt):
        ads.load(spark, base, store)
    monkeypatch.undo()
    if at in ("marker", "first write"):
        assert _ads_of(spark, store) == before
    ads.load(spark, base, store)
    assert _ads_of(spark, store) == [(5, "january", 2024, 1), (7, "stays", 2024, 2), (8, "sooner", 2024, 1), (9, "new", 2024, 1)]
    assert not ads.finish(spark, store) and ads.load(spark, base, store) == 0


def test_a_month_of_most_rows_is_many_files(spark, tmp_path):
    rows = [(i, 2024, 1 if i % 10 else 2) for i in range(2000)]
    a = ads.harmonised(spark.createDataFrame(rows, "id long, year int, month int"))
    out = str(tmp_path / "out")
    ads.spread(a, file_rows=300).write.partitionBy("year", "month").parquet(out)
    files_of = {m: [x for x in os.listdir(f"{out}/year=2024/month={m}") if x.endswith(".parquet")] for m in (1, 2)}
    assert 4 <= len(files_of[1]) <= 7 and len(files_of[2]) == 1 and spark.read.parquet(out).count() == 2000
