"""Invariants and edge cases of the operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fernworks.functions import columns, text
from fernworks.operators import agreement, exposure, matching, pairwise, scoring, stats, vectors


def got(df, *names):
    return sorted(tuple(r[n] for n in (names or df.columns)) for r in df.collect())


@pytest.fixture(scope="module")
def occupations(spark):
    return spark.createDataFrame([("11-1011.00", [1.0, 0.0, 0.0, 0.0]), ("15-1252.00", [0.0, 1.0, 0.0, 0.0]), ("29-1141.00", [0.0, 0.0, 1.0, 0.0])], "onet_code string, embedding array<float>")


@pytest.fixture(scope="module")
def ads(spark):
    return spark.createDataFrame([(100, [0.9, 0.1, 0.0, 0.0]), (200, [0.1, 0.8, 0.2, 0.0]), (300, [0.0, 0.1, 0.9, 0.1])], "ad_id long, embedding array<float>")


@pytest.mark.parametrize("part_bytes", [1 << 20, 40])
def test_cosine(spark, ads, occupations, part_bytes):
    t = vectors.cosine_topk(ads, occupations, 2, part_bytes=part_bytes)
    best = {r["ad_id"]: r["onet_code"] for r in t.filter("rank = 0").collect()}
    assert best == {100: "11-1011.00", 200: "15-1252.00", 300: "29-1141.00"}
    assert t.count() == 6 and {r[0] for r in t.select("rank").collect()} == {0, 1}
    assert vectors.cosine_topk(ads, occupations, 99, part_bytes=part_bytes).count() == 9
    assert all(-1 <= r["cosine_score"] <= 1 for r in t.collect())


def test_cosine_edges(spark, occupations):
    odd = spark.createDataFrame([(1, [0.0, 0.0, 0.0, 0.0]), (2, None), (3, [1.0, 1.0, 0.0, 0.0])], "ad_id long, embedding array<float>")
    t = vectors.cosine_topk(odd, occupations, 1)
    assert got(t, "ad_id", "onet_code") == [(1, "11-1011.00"), (3, "11-1011.00")]  # ties by code
    with pytest.raises(Exception, match="components"):
        vectors.cosine_topk(spark.createDataFrame([(1, [1.0])], "ad_id long, embedding array<float>"), occupations, 1).collect()
    assert vectors.cosine_topk(odd, occupations.limit(0), 1).count() == 0


@pytest.fixture(scope="module")
def candidates(spark):
    return spark.createDataFrame([(a, r, f"c{r + 1}", s) for a, ss in ((100, (0.95, 0.85, 0.75)), (200, (0.9, 0.8, 0.7))) for r, s in enumerate(ss)], "ad_id long, rank int, onet_code string, cosine_score double")


def test_keep_and_drop(spark, candidates):
    said = spark.createDataFrame([(100, '{"keep": [1, 3]}', None), (200, '{"keep": [1, 2, 3]}', None)], "ad_id long, data string, error string")
    kept, dropped = matching.split_by_response(candidates, said)
    assert got(kept.filter("ad_id = 100"), "onet_code", "rank", "cosine_score") == [("c1", 0, 0.95), ("c3", 1, 0.75)]
    assert got(dropped, "ad_id", "onet_code", "original_rank") == [(100, "c2", 1)]


@pytest.mark.parametrize("data, bad", [('{"keep": []}', "at least 1"), ('{"keep": [0]}', "1-based"), ('{"keep": [-1]}', "1-based"), ("{}", "malformed"), ("not json", "malformed"), ('{"keep": [99]}', "out of range")])
def test_bad_responses(spark, candidates, data, bad):
    said = spark.createDataFrame([(100, data, None), (200, '{"keep": [2, 2]}', None)], "ad_id long, data string, error string")
    kept, dropped = matching.split_by_response(candidates, said)
    assert got(kept, "ad_id", "onet_code", "rank") == [(200, "c2", 0)] and dropped.count() == 2
    sizes = candidates.groupBy("ad_id").agg(F.count("*").alias("n"))
    assert bad in matching.validated(said, sizes).filter("ad_id = 100").first()["error"]


def test_json_in_prose():
    assert matching.first_json('so {x} then {"a": {"b": 1}} end }') == '{"a": {"b": 1}}'
    assert matching.first_json("none") is None and matching.first_json(None) is None
    assert matching.first_json('{"a": 1} {"b": 2}', lambda d: "b" in d) == '{"b": 2}'


def test_sample(spark):
    ids = spark.range(50)
    assert got(matching.hash_sample(ids, 7, 1)) == got(matching.hash_sample(ids.orderBy(F.desc("id")), 7, 1))
    assert matching.hash_sample(ids, -1, 1).count() == 50
    with pytest.raises(ValueError):
        matching.hash_sample(ids, -2, 1)


def test_exposure_edges(spark):
    m = spark.createDataFrame([(1, "a", 0.5), (2, "a", 0.4), (2, "b", 0.4), (3, "a", -1.0), (4, "zz", 0.9), (5, "a", 1.0), (5, "b", 0.0)], "ad_id long, onet_code string, rerank_score double")
    s = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "onet_code string, s double")
    e = exposure.ad_exposure(m, s)
    w = math.exp(1 / 0.7)
    assert [(a, n, round(x, 9)) for a, n, x in got(e)] == [(1, 1, 1.0), (2, 2, 0.5), (5, 2, round(w / (w + 1), 9))]
    full = exposure.all_ads(spark.range(1, 7).withColumnRenamed("id", "ad_id"), e)
    assert got(full.filter("error is not null"), "ad_id", "n_matches", "s") == [(3, 0, None), (4, 0, None), (6, 0, None)]


def test_presence(spark):
    r = spark.createDataFrame(
        [("work_context", "x", "w1", "CX", "5"), ("gwas", "x", "g1", "IM", "3"), ("gwas", "x", "g1", "LV", "7"), ("gwas", "x", "g2", "IM", "5"), ("gwas", "y", "g1", "LV", "7"), ("work_context", "z", "w1", "CX", "n/a")],
        "source string, onet_code string, element_id string, scale string, value string",
    )
    e = scoring.element_table(spark, {"one": {"work_context": ("w1",), "gwas": ("g1", "g2")}})
    out = scoring.presence(r, e, spark.createDataFrame([("x",), ("y",), ("z",)], "onet_code string"))
    # g1: (.5 + 1) / 2, g2: (1 + 0) / 2; y has no importance, z no number
    assert got(out, "onet_code", "presence_one") == [("x", (1 + (0.75 + 0.5) / 2) / 2), ("y", None), ("z", None)]


def test_presence_elements():
    assert [sum(len(v) for v in d.values()) for d in scoring.PRESENCE_ELEMENTS.values()] == [22, 30, 5]
    assert len(scoring.PUBLIC_SECTOR_TITLES) == 33


def test_weights_of_zero(spark):
    t = spark.createDataFrame([("a", 2, 0.0, 0.5), ("a", 0, 0.0, 0.5), ("b", 2, 3.0, 0.5), ("b", 0, 1.0, 0.5)], "onet_code string, exposure int, task_importance double, confidence double")
    assert got(scoring.task_exposure(t), "onet_code", "task_exposure_weighted", "binary_exposure") == [("a", 0.5, 0.5), ("b", 0.75, 0.5)]


def test_score_sets(spark):
    good = spark.createDataFrame([("a", 0.5), ("b", 1.0005)], "onet_code string, s double")
    assert scoring.check_scores(good).count() == 2
    for rows in ([("a", 0.5), ("a", 0.5)], [("a", 1.1)], [("a", None)], [(None, 0.1)], [("a", float("nan"))]):
        with pytest.raises(ValueError):
            scoring.check_scores(spark.createDataFrame(rows, "onet_code string, s double"))
    with pytest.raises(ValueError, match="1 keys"):
        scoring.combine({"x": good, "y": good.limit(1)})
    with pytest.raises(ValueError):
        scoring.check_scores(good.select("onet_code"))


def test_public_sector_is_left_out(spark):
    occ = spark.createDataFrame([("1", " Coroners "), ("2", "Bakers"), ("3", "Idle")], "onet_code string, title string")
    tasks = spark.createDataFrame([(c, t, f"do {t}") for c in ("1", "2") for t in ("1", "2", "3")], "onet_code string, task_id string, task string")
    ratings = spark.createDataFrame([("2", "1", "IM", "2"), ("2", "2", "IM", "5"), ("2", "3", "IM", "x"), ("1", "1", "IM", "5")], "onet_code string, task_id string, scale string, value string")
    titles = spark.createDataFrame([("2", "Cook")], "onet_code string, alternate_title string")
    assert got(scoring.targets(occ, tasks, ratings, titles), "onet_code", "top_tasks", "alternate_titles") == [("2", ["do 2", "do 1", "do 3"], ["Cook"])]
    assert scoring.targets(occ, tasks, ratings, titles, leave_out=()).count() == 2


def test_bradley_terry_gradient(spark):
    rng = np.random.default_rng(0)
    rows = [(int(a), int(b), str(rng.choice(["A", "B", "tie"], p=[0.6, 0.3, 0.1]))) for a, b in rng.integers(0, 20, (400, 2)) if a != b] + [(1, 2, "bad")]
    c = spark.createDataFrame(rows, "a int, b int, outcome string")
    theta = {r["item"]: r["theta"] for r in pairwise.bradley_terry(c, spark.createDataFrame([(i,) for i in range(21)], "item int")).collect()}
    assert len(theta) == 21 and abs(sum(theta.values())) < 1e-6
    g = dict.fromkeys(theta, 0.0)
    for a, b, o in rows:
        if o in ("A", "B", "tie"):
            y = {"A": 1.0, "B": 0.0, "tie": 0.5}[o]
            d = y - 1 / (1 + math.exp(theta[b] - theta[a]))
            g[a] += d
            g[b] -= d
    shift = np.mean([g[i] / 1e-4 - theta[i] for i in theta])
    assert max(abs(g[i] - 1e-4 * (theta[i] + shift)) for i in theta) < 1e-6


def test_bradley_terry_spread(spark, monkeypatch):
    rng = np.random.default_rng(1)
    c = spark.createDataFrame([(int(a), int(b), str(rng.choice(["A", "B", "tie"], p=[0.5, 0.3, 0.2]))) for a, b in rng.integers(0, 12, (300, 2))], "a int, b int, outcome string")
    items = spark.createDataFrame([(i,) for i in range(12)], "item int")
    near = {r[0]: r[1] for r in pairwise.bradley_terry(c, items).collect()}
    monkeypatch.setattr(pairwise, "DRIVER_PAIRS", 0)
    far = {r[0]: r[1] for r in pairwise.bradley_terry(c, items).collect()}
    assert max(abs(near[i] - far[i]) for i in near) < 1e-5


def test_a_fit_that_has_not_settled_is_an_error(spark):
    edges = spark.createDataFrame([(0, 1, 5.0, 2.0), (1, 2, 3.0, 4.0)], "ia long, ib long, wins_a double, wins_b double")
    with pytest.raises(RuntimeError, match="not settled"):
        pairwise.solve_spread(edges, 3, rounds=1)


def test_bradley_terry_one_sided():
    theta = pairwise.solve(np.array([0, 1]), np.array([1, 2]), np.array([5.0, 5.0]), np.zeros(2), 3)
    assert theta[0] > theta[1] > theta[2] and np.isfinite(theta).all()


def test_pairs(spark):
    items = spark.createDataFrame([(i, float(i % 7)) for i in range(31)], "item int, theta double")
    p = pairwise.shuffled_pairs(items, 2)
    assert all(a < b for a, b in got(p)) and p.distinct().count() == p.count() and 15 <= p.count() <= 30
    a = got(pairwise.adaptive_pairs(items, 3))
    count = {i: sum(i in x for x in a) for i in range(31)}
    assert min(count.values()) >= 3 and all(x < y for x, y in a) and len(set(a)) == len(a)
    assert pairwise.adaptive_pairs(items.withColumn("theta", F.lit(1.0)), 2).count() > 0


def test_floor(spark):
    d = spark.createDataFrame([(0.0,), (0.05,), (1.0,)], "x double")
    assert got(pairwise.floor_normalised(d, "x", 0.1), "score") == [(0.0,), (0.0,), (1.0,)]
    assert got(pairwise.floor_normalised(d.filter("x = 1"), "x", 0.1), "score") == [(0.5,)]


@pytest.fixture(scope="module")
def runs(spark):
    rows = [("a", 1, c, s) for c, s in zip("pqrs", (4.0, 3.0, 2.0, 1.0), strict=True)] + [("b", 1, c, s) for c, s in zip("pqrt", (1.0, 2.0, 3.0, 9.0), strict=True)]
    rows += [("a", 2, "p", 1.0), ("b", 2, "q", -1.0), ("a", 3, "p", 1.0)]
    return spark.createDataFrame(rows, "run string, ad int, code string, score double")


def test_agreement(runs):
    assert got(agreement.jaccard(runs), "jaccard") == [((3 / 5 + 0) / 2,)]
    assert got(agreement.spearman(runs), "spearman") == [(-1.0,)]  # ad 2 shares too few
    a, b = {"p": 0.4, "q": 0.3, "r": 0.2, "s": 0.1}, {"p": 1 / 15, "q": 2 / 15, "r": 3 / 15, "t": 9 / 15}
    i = sum(min(a.get(c, 0), b.get(c, 0)) for c in "pqrst")
    assert got(agreement.ruzicka(runs), "ruzicka")[0][0] == pytest.approx((i / (2 - i) + 0) / 2)
    assert got(agreement.at_least(runs, 5), "at_least") == [(0.0,)] and got(agreement.at_least(runs, 3), "at_least") == [(0.5,)]


def test_missing_tops_agree(spark):
    tops = spark.createDataFrame([("a", 1, "p"), ("b", 1, "p"), ("a", 2, "p")], "run string, ad int, top1 string")
    ads = spark.createDataFrame([(1,), (2,), (3,)], "ad int")
    assert got(agreement.top1(tops, ads), "top1") == [(2 / 3,)]


def test_subsets(spark):
    p = spark.createDataFrame([("a", "b", 0.9), ("a", "c", 0.1), ("b", "c", 0.2)], "run_a string, run_b string, v double")
    assert agreement.best_subsets(p, "v")[1] == (2, 0.9, ["a", "b"])
    assert agreement.pruned_subset(p, "v")[1] == ["c"]


@pytest.mark.parametrize("kind", ["noise", "alike", "negative", "structure"])
def test_best_subsets_are_those_of_all(spark, kind):
    """Branch and bound against all subsets; of equal ones the first."""
    from itertools import combinations

    rng = np.random.default_rng(7)
    n = 11
    w = {"noise": 0.9 + rng.normal(0, 0.02, (n, n)), "alike": np.round(rng.random((n, n)), 1) * 0 + 0.5, "negative": rng.normal(size=(n, n)), "structure": 0.5 + np.outer(*[rng.random(n)] * 2)}[kind]
    names = [f"r{i:02d}" for i in range(n)]
    p = spark.createDataFrame([(names[i], names[j], float(w[i, j])) for i, j in combinations(range(n), 2)], "run_a string, run_b string, v double")
    found = agreement.best_subsets(p, "v")
    assert [k for k, _, _ in found] == list(range(n, 1, -1))
    for k, mean, runs in found:
        best = max(combinations(range(n), k), key=lambda s: (round(sum(w[i, j] for i, j in combinations(s, 2)), 9), [-x for x in s]))
        assert runs == [names[i] for i in best] and mean == pytest.approx(sum(w[i, j] for i, j in combinations(best, 2)) / (k * (k - 1) / 2))


def test_best_subsets_of_forty_runs(spark):
    from itertools import combinations

    rng = np.random.default_rng(8)
    q = rng.uniform(0.6, 1, 40)
    rows = [(f"r{i:02d}", f"r{j:02d}", float(0.5 + 0.4 * q[i] * q[j] + rng.normal(0, 0.02))) for i, j in combinations(range(40), 2)]
    found = agreement.best_subsets(spark.createDataFrame(rows, "run_a string, run_b string, v double"), "v")
    assert len(found) == 39 and all(len(r) == k for k, _, r in found)
    assert all(a[1] <= b[1] + 1e-12 for a, b in zip(found, found[1:], strict=False))  # a smaller best subset is never worse
    assert agreement.best_subsets(spark.createDataFrame([], "run_a string, run_b string, v double"), "v") == []


def test_template():
    with pytest.raises(KeyError):
        text.template("{a} {b}", {"a": F.lit(1)})
    with pytest.raises(KeyError):
        text.template("{a}", {"a": F.lit(1), "b": F.lit(2)})


def test_texts(spark):
    d = spark.createDataFrame([("Nurse", None), (None, " x ")], "t string, d string")
    assert got(d.select(text.ad_text(F.col("t"), F.col("d")).alias("x"))) == [(".  x ",), ("Nurse. ",)]
    assert got(d.select(columns.clip01(F.lit(None).cast("double")).alias("x")).distinct()) == [(None,)]
    assert d.select(columns.number(F.lit("abc"))).first()[0] is None


def test_histogram_of_one_value(spark):
    assert got(stats.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", 5)) == [(0, 2)]


def test_shared_fraction_of_all_candidates(spark, tmp_path):
    from fernworks.plans import catalogue

    rows = [(f, ad, part, 1000.0) for f, ad, part in [("A", 1, 3), ("A", 1, 40), ("A", 1, 7), ("N", 1, 7), ("N", 1, 40), ("N", 2, 5), ("R", 2, 5), ("R", 2, 80), ("A", 3, 40)]]
    spark.createDataFrame(rows, "l_returnflag string, l_suppkey long, l_partkey long, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    have = {}
    for f, ad, part, _ in rows:
        have.setdefault(f, {}).setdefault(ad, set()).add(part)
    want = []
    for a, b in (("A", "N"), ("A", "R"), ("N", "R")):
        ads = have[a].keys() | have[b].keys()
        x, y = have[a], have[b]
        want.append((a, b, round(sum(len(x.get(i, set()) & y.get(i, set())) / len(x.get(i, set()) | y.get(i, set())) for i in ads) / len(ads), 6)))
    assert got(catalogue.QUERIES["i19_shared_fraction"](spark, str(tmp_path)), "run_a", "run_b", "shared_fraction") == want


def test_pairs_of_all_parts(spark, tmp_path):
    from fernworks.plans import catalogue

    parts = [(i, 1 + i % 50, 900 + (i * 37 % 60) / 10) for i in range(120)]
    spark.createDataFrame(parts, "p_partkey long, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    near = lambda width: {(a, b) for a, _, x in parts for b, _, y in parts if a < b and abs(x - y) <= width}
    assert got(catalogue.QUERIES["h17_band_pairs"](spark, str(tmp_path)), "a", "b") == sorted(near(0.15))
    adaptive = got(catalogue.QUERIES["h17_adaptive_pairs"](spark, str(tmp_path)), "a", "b")
    assert set(adaptive) <= near(np.std([x for _, _, x in parts])) and min(sum(i in p for p in adaptive) for i, _, _ in parts) >= 3


def test_parts_are_items(spark, tmp_path):
    from collections import Counter, defaultdict

    from fernworks.plans import catalogue

    orders = {k: (k * 7 % 150, k * 11 % 150) for k in range(1, 400)}
    orders |= {400: (5, 65), 401: (9, 129)}  # equal modulo 60
    spark.createDataFrame([(k, p) for k, two in orders.items() for p in two], "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(150).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    run = lambda name, *c: got(catalogue.QUERIES[name](spark, str(tmp_path)), *c)
    c = [(k, min(p), max(p), "tie" if k % 5 == 0 else "A" if k % 3 == 0 or k % 2 == 0 else "B") for k, p in orders.items() if p[0] != p[1]]
    pairs, seen, theta = defaultdict(list), Counter(), dict(run("h15_bt_theta", "item", "theta"))
    for _, a, b, o in c:
        pairs[a, b].append(o)
        seen.update((a, b))
    win = {"A": 1.0, "B": 0.0, "tie": 0.5}
    assert run("h15_collapsed_pairs", "a", "b", "wins_a") == sorted((a, b, sum(win[o] for o in v)) for (a, b), v in pairs.items())
    assert run("d31_appearances", "item", "n") == sorted(seen.items())
    assert run("d32_pair_counts", "a", "b", "n", "tie_rate") == sorted((a, b, len(v), round(v.count("tie") / len(v), 6)) for (a, b), v in pairs.items())
    unswapped = run("h19_unswap", "k", "shown_a", "shown_b")
    assert [(k, *sorted(p)) for k, *p in unswapped] == sorted((k, a, b) for k, a, b, _ in c) and any(a > b for _, a, b in unswapped)
    assert set(theta) == set(range(150))
    g = dict.fromkeys(theta, 0.0)
    for _, a, b, o in c:
        d = win[o] - 1 / (1 + math.exp(theta[b] - theta[a]))
        g[a] += d
        g[b] -= d
    shift = np.mean([g[i] / 1e-4 - theta[i] for i in theta])
    assert max(abs(g[i] - 1e-4 * (theta[i] + shift)) for i in theta) < 1e-4


def test_rounds(spark):
    n, shown = 40, []
    items = spark.range(n).withColumnRenamed("id", "item")

    def judge(pairs):  # the larger number wins; what is shown first must not matter
        shown.append(pairs.filter("swap").count())
        return pairs.withColumn("outcome", F.when(F.col("shown_a") > F.col("shown_b"), "A").otherwise("B"))

    out = {r["item"]: (r["theta"], r["score"]) for r in pairwise.in_rounds(items, judge, (4, 3, 3), 1).collect()}
    assert len(shown) == 3 and min(shown) > 0 and len(out) == n
    assert stats.spearman(spark.createDataFrame([(i, out[i][0]) for i in range(n)], "i int, t double"), "i", "t").first()[0] > 0.95
    lo, hi = min(t for t, _ in out.values()), max(t for t, _ in out.values())
    want = {i: max(0.0, ((t - lo) / (hi - lo) - 0.1) / 0.9) for i, (t, _) in out.items()}
    assert max(abs(want[i] - out[i][1]) for i in out) < 1e-9


def test_by_occupation(spark):
    s = spark.createDataFrame([(1, 0.2), (2, 0.8), (3, 0.5), (4, 0.7)], "item int, score double")
    t = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, "b", 0.0), (4, "b", 0.0)], "item int, onet_code string, importance double")
    out = pairwise.by_occupation(s, t, spark.createDataFrame([("a",), ("b",), ("c",)], "onet_code string"))
    assert [tuple(None if x is None else x if isinstance(x, str) else round(x, 9) for x in r) for r in got(out)] == [("a", 0.5, 0.65), ("b", 0.6, 0.6), ("c", None, None)]


def test_convergence_columns(spark):
    from helpers import SMALL

    from fernworks.plans import catalogue

    out = catalogue.QUERIES["i17_convergence"](spark, SMALL)
    assert got(out, "against", "round") == [(a, q) for a in ("last", "next") for q in (1, 2, 3)]
    rows = {(r["against"], r["round"]): r for r in out.collect()}
    assert all(-1 <= r["spearman"] <= 1 and 0 <= r["mae"] <= 1 for r in rows.values())
    assert rows["last", 3][2:] == rows["next", 3][2:]


def test_spread_fit_sends_one_vector_at_a_time(spark, monkeypatch):
    """The strengths go to the tasks once a Newton step, not again with each product, and nothing shared is left over."""
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 60, 400), rng.integers(0, 60, 400)
    rows = [(int(i), int(j), float(w), 1.0 - float(w)) for i, j, w in zip(a, b, rng.integers(0, 3, 400) / 2, strict=True) if i != j]
    sent, left = [], []
    broadcast = type(spark.sparkContext).broadcast

    def counted(sc, value):
        out = broadcast(sc, value)
        sent.append(np.shape(value))
        left.append(out)
        destroy = out.destroy
        out.destroy = lambda *args: (left.remove(out), destroy(*args))
        return out

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", counted)
    theta = pairwise.solve_spread(spark.createDataFrame(rows, "ia long, ib long, wins_a double, wins_b double"), 60)
    assert set(sent) == {(60,)} and not left
    i, j, x, y = (np.array(c) for c in zip(*rows, strict=True))
    assert np.abs(theta - pairwise.solve(i, j, x, y, 60)).max() < 1e-6


@pytest.mark.parametrize("shift", [0.0, 0.25])
def test_spread_fit_of_few_comparisons_takes_few_passes(spark, monkeypatch, shift):
    """With 3.5 comparisons an item many hang on few: the diagonal alone takes 247 passes, with the forest they are few."""
    rng = np.random.default_rng(1)
    pairs = sorted({(min(p), max(p)) for p in rng.integers(0, 400, (700, 2)).tolist() if p[0] != p[1]})
    rows = [(i, j, float(w) + shift, 1.0 - float(w)) for (i, j), w in zip(pairs, rng.integers(0, 3, len(pairs)) / 2, strict=True)]
    edges = spark.createDataFrame(rows, "ia long, ib long, wins_a double, wins_b double")
    passes, to_arrow = [], type(edges).toArrow
    monkeypatch.setattr(type(edges), "toArrow", lambda df: passes.append(1) or to_arrow(df))
    theta = pairwise.solve_spread(edges, 400)
    i, j, x, y = (np.array(c) for c in zip(*rows, strict=True))
    assert len(passes) < 100
    assert np.abs(theta - pairwise.solve(i, j, x, y, 400)).max() < 1e-4


def test_forest_is_solved_exactly():
    rng = np.random.default_rng(4)
    i = np.arange(1, 200, dtype=np.int32)
    j = (i - rng.integers(1, 4, 199)).clip(0).astype(np.int32)  # a tree, with pairs of the same weight
    t, theta = rng.integers(1, 3, 199).astype(np.float32), rng.integers(0, 2, 200) * 1.0
    a = 0.01 * np.eye(200)
    w = pairwise._weight(t, theta[i] - theta[j])
    for u, v, x in zip(i, j, w, strict=True):
        a[[u, v, u, v], [u, v, v, u]] += [x, x, -x, -x]
    trees, taken = np.arange(200, dtype=np.int32), []
    while len(set(trees)) > 1:
        out = np.flatnonzero(trees[i] != trees[j])
        trees, e = pairwise._joined(trees, i[out], j[out], w[out])
        taken += out[e].tolist()
    assert sorted(taken) == list(range(199))
    r = rng.normal(size=200)
    z = pairwise._eased(np.diag(a).copy(), theta, pairwise._levels(i, j, t, 200))(r)
    assert np.abs(a @ z - r).max() < 1e-5
    ring = np.arange(9, dtype=np.int32)
    trees, e = pairwise._joined(ring, np.r_[ring, (ring + 1) % 9].astype(np.int32), np.r_[(ring + 1) % 9, ring].astype(np.int32), np.ones(18))
    assert len(e) == 9 - len(set(trees))  # no circle of equal weights


@pytest.mark.parametrize("shared, suppliers", [(2, 3), (2, 0), (4, 1), (0, 2)])
def test_benchmark_row_without_measures(spark, tmp_path, shared, suppliers):
    """With two shared candidates no ad has a rank correlation, without suppliers none has a mean: SQL's row is still there."""
    from helpers import database, same

    from fernworks.plans import catalogue

    rows = [(f, ad, 100 * ad + k + (0 if k < shared else 50 * (f == "N")), 35000.0 + 1000 * ((ad + 3 * k) % 7) + 500 * (f == "N") * k) for f in "ANR" for ad in (1, 2, 3) for k in range(5)]
    spark.createDataFrame(rows, "l_returnflag string, l_suppkey long, l_partkey long, l_extendedprice double").coalesce(1).write.parquet(f"{tmp_path}/l")
    spark.createDataFrame([(i + 1, i) for i in range(suppliers)], "s_suppkey long, s_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/s")
    for short, name in (("l", "lineitem"), ("s", "supplier")):
        next((tmp_path / short).glob("*.parquet")).rename(tmp_path / f"{name}.parquet")
    same(catalogue.QUERIES["i13_benchmark_row"](spark, str(tmp_path)), database(str(tmp_path)), catalogue.SQL["i13_benchmark_row"])


def test_benchmark_row(spark, tmp_path):
    from fernworks.plans import catalogue

    rows = [(f, ad, 10 * ad + k, 100000 * (0.35 + 0.01 * ((ad * 3 + k * (7 if f == "A" else 4)) % 11))) for f in "ANR" for ad in (1, 2, 3) for k in range(4) if (f, ad, k) != ("N", 2, 0) and (f, ad) != ("R", 3)]
    spark.createDataFrame(rows, "l_returnflag string, l_suppkey long, l_partkey long, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, i) for i in (1, 2, 3)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    row = catalogue.QUERIES["i13_benchmark_row"](spark, str(tmp_path)).collect()
    have = {}
    for f, ad, part, x in rows:
        have.setdefault(f, {}).setdefault(ad, {})[part] = x / 100000 - 0.3
    jac, top, ruz, rho = [], [], [], []
    for ad in (1, 2, 3):
        a, b = have["A"][ad], have["N"][ad]
        both = sorted(a.keys() & b.keys())
        jac.append(len(both) / len(a.keys() | b.keys()))
        best = lambda d: min(d, key=lambda c: (-d[c], c))
        top.append(float(best(a) == best(b)))
        i = sum(min(a.get(c, 0) / sum(a.values()), b.get(c, 0) / sum(b.values())) for c in a.keys() | b.keys())
        ruz.append(i / (2 - i))
        place = lambda d: np.argsort(np.argsort([d[c] for c in both]))
        rho.append(np.corrcoef(place(a), place(b))[0, 1])
    assert len(row) == 1 and row[0]["n"] == 3
    assert [row[0][c] for c in ("jaccard", "top1", "ruzicka", "spearman")] == pytest.approx([np.mean(x) for x in (jac, top, ruz, rho)], abs=2e-6)


@pytest.mark.parametrize("parts", [1, 20])
def test_a_right_side_in_parts(spark, parts):
    """Twenty parts of the right side give what one gives, and the ads are read once."""
    rng = np.random.default_rng(3)
    a, o = rng.normal(size=(60, 5)), rng.normal(size=(100, 5))
    o[7] = o[8]  # a tie
    left = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(a)], "ad_id long, embedding array<double>").repartition(3)
    right = spark.createDataFrame([(i, x.tolist(), i % 4) for i, x in enumerate(o)], "onet_code long, embedding array<double>, major_group int")
    out = vectors.cosine_topk(left, right, 4, part_bytes=100 * 5 * 8 // parts)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    scores = unit(a) @ unit(o).T
    want = [(i, r, c) for i, s in enumerate(scores) for r, c in enumerate(sorted(range(100), key=lambda c: (-round(s[c], 12), c))[:4])]
    assert got(out, "ad_id", "rank", "onet_code") == want
    if parts > 1:
        assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    residual = lambda **k: [(i, r, c, round(s, 9)) for i, r, c, s in got(vectors.residual_topk(left, right, 4, **k))]
    assert residual(part_bytes=100 * 5 * 8 // parts) == residual()


@pytest.mark.parametrize("part_bytes", [1 << 20, 200])
def test_inside_groups(spark, part_bytes):
    """Groups of any size, one with most of all occupations, cut on both sides; no row holds two vectors."""
    rng = np.random.default_rng(4)
    a, o = rng.normal(size=(50, 4)), rng.normal(size=(90, 4))
    group = ["x|1" if i % 10 else "y" if i % 20 else "z" for i in range(90)]
    left = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(a)] + [(99, None)], "ad_id long, embedding array<double>")
    right = spark.createDataFrame([(i, x.tolist(), group[i]) for i, x in enumerate(o)] + [(999, [1.0, 0.0, 0.0, 0.0], None)], "onet_code long, embedding array<double>, major_group string")
    cos = lambda x, y: float(x @ y / np.linalg.norm(x) / np.linalg.norm(y))
    middle = {g: np.mean([x for x, h in zip(o, group, strict=True) if h == g], axis=0) for g in set(group)}
    want = []
    for i, x in enumerate(a):
        near = sorted(middle, key=lambda g: -cos(x, middle[g]))[:2]
        best = sorted((c for c in range(90) if group[c] in near), key=lambda c: -cos(x, o[c]))[:6]
        want += [(i, r, c) for r, c in enumerate(best)]
    out = vectors.hierarchical_topk(left, right.filter("major_group is not null"), 2, 6, part_bytes=part_bytes)
    assert got(out, "ad_id", "rank", "onet_code") == sorted(want)


def _odd_values(rng):
    return [
        [3.0], [1.0, 2.0], [5.0] * 9, [0.0, -0.0, 0.0], [float("inf")] * 3 + [-float("inf"), 1.0, 2.0], [float("nan"), 1.0, 7.0, float("nan")], [1e308, -1e308, 5e307, 0.0, 1.0],
        [*rng.normal(size=500)], [*rng.exponential(size=300) ** 9, 1e300, -1e300], [7.0] * 900 + [*rng.normal(size=100)], [float(x) for x in rng.integers(0, 5, 400)], [1.0 + k * 2.0**-52 for k in range(50)],
    ]


@pytest.mark.parametrize("few", [10_000, 3])
def test_order_statistics(spark, monkeypatch, few):
    """The values at all places are those of a sorted list, whatever the values are."""
    monkeypatch.setattr(stats, "FEW", few)
    monkeypatch.setattr(stats, "CELLS", 4096 if few > 3 else 8)
    for values in _odd_values(np.random.default_rng(0)):
        d = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").coalesce(2)
        n = len(values)
        places = sorted({0, 1 % n, n // 3, n // 2, n - 1})
        found = stats.order_statistics(d, "v", places)
        want = sorted((float(v) for v in values), key=lambda v: (v != v, v))
        assert [found[k] for k in places] == pytest.approx([want[k] for k in places], rel=0, abs=0, nan_ok=True)
        with pytest.raises(ValueError):
            stats.order_statistics(d, "v", [n])


def test_quantiles(spark):
    d = spark.createDataFrame([(float(v),) for v in (4, 1, 3, 2)] + [(None,)], "v double")
    assert stats.quantiles(d, "v", [0, 0.5, 0.25, 1]) == [1, 2.5, 1.75, 4]
    assert stats.quantiles(d.filter("v is null"), "v", [0.5]) == [None]
    runs = spark.createDataFrame([(r, n) for r, ns in (("a", [1, 2, 9]), ("b", [4, 4, 1, 2]), ("c", [5])) for n in ns], "run string, n long")
    assert got(stats.median_by(runs, "run", "n")) == [("a", 2.0), ("b", 3.0), ("c", 5.0)]


def test_no_exact_percentile_in_a_plan(spark):
    """No aggregation holds a column: percentiles are made by counts."""
    from helpers import SMALL

    from fernworks.plans import catalogue

    for name in ("d19_quantiles", "d20_summary", "h22_quadrants", "i8_matrix_summary", "i10_selectivity", "d25_matrix_summary"):
        if name in catalogue.QUERIES:
            assert "percentile(" not in catalogue.QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()


def test_ranks_where_one_value_has_most_rows(spark):
    """Average ranks are right, and the common value's rows aren't joined by value: no task has more than its share."""
    rng = np.random.default_rng(1)
    values = [None] * 5 + [3.0] * 9000 + [float(x) for x in rng.normal(size=600)] + [float(x) for x in rng.integers(0, 4, 395)]
    rng.shuffle(values)
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v double").repartition(8)
    out = stats.ranks(d, "v", "r")
    order = sorted(range(len(values)), key=lambda i: (values[i] is not None, values[i] or 0))
    place = {}
    for k, i in enumerate(order, 1):
        place.setdefault(values[i], []).append(k)
    assert got(out, "i", "r") == [(i, float(np.mean(place[v]))) for i, v in enumerate(values)]
    from pyspark.sql.functions import spark_partition_id

    tasks = [r["count"] for r in out.filter("v = 3.0").groupBy(spark_partition_id()).count().collect()]
    assert len(tasks) >= 8 and max(tasks) < 2000


def test_spearman_with_ties_and_weights(spark):
    import pandas as pd

    rng = np.random.default_rng(2)
    a = rng.integers(0, 4, 300).astype(float)
    b = np.where(rng.random(300) < 0.8, 1.0, a + rng.normal(size=300))
    d = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b, strict=True)] + [(None, 1.0), (2.0, None)], "a double, b double")
    assert stats.spearman(d, "a", "b").first()[0] == pytest.approx(pd.Series(a).rank().corr(pd.Series(b).rank()))
    assert stats.spearman(d.withColumn("b", F.lit(1.0)), "a", "b").first()[0] is None
    assert stats.spearman(d.limit(0), "a", "b").first()[0] is None


@pytest.mark.parametrize("capacity", [1, 3])
def test_matching_is_greedy(spark, capacity):
    """Rounds of edges that are first at both ends give what taking one after another gives, hubs included."""
    import hashlib

    rng = np.random.default_rng(5)
    edges = {tuple(sorted(map(int, rng.choice(60, 2, replace=False)))) for _ in range(400)} | {(0, k) for k in range(1, 60)}
    order = sorted((hashlib.md5(f"{a}-{b}-9".encode()).hexdigest()[:12], a, b) for a, b in edges)
    used, want = dict.fromkeys(range(60), 0), []
    for _, a, b in order:
        if used[a] < capacity and used[b] < capacity:
            want.append((a, b))
            used[a] += 1
            used[b] += 1
    assert got(pairwise.matched(spark.createDataFrame(list(edges), "a long, b long"), capacity, 9)) == sorted(want)
    assert pairwise.matched(spark.createDataFrame([], "a long, b long"), capacity).count() == 0


def test_counters_on_both_sides(spark):
    """An item is asked for as often as wanted; more often only as a partner of one that would have had too few."""
    from collections import Counter

    rng = np.random.default_rng(6)
    theta = [(i, float(x)) for i, x in enumerate(rng.normal(size=400))]
    n = Counter(x for p in got(pairwise.adaptive_pairs(spark.createDataFrame(theta, "item long, theta double"), 3)) for x in p)
    assert min(n.values()) == 3 and max(n.values()) <= 5 and sum(k > 3 for k in n.values()) < 0.1 * 400
    far = spark.createDataFrame([*theta, (1000, 50.0), (1001, -70.0)], "item long, theta double")
    n = Counter(x for p in got(pairwise.adaptive_pairs(far, 3, width=0.5)) for x in p)
    assert n[1000] >= 3 and n[1001] >= 3  # far from all others: partners at random


def test_answers_are_asked_for_once(spark):
    """A judge that answers otherwise each time is asked once for each round, though the fit reads its answers often."""
    asked = spark.sparkContext.accumulator(0)
    items = spark.range(24).select(F.col("id").alias("item"))

    def judge(pairs):
        def said(frames):
            for f in frames:
                asked.add(len(f))
                yield f.assign(outcome=np.where(np.random.random(len(f)) < 0.5, "A", "B"))

        return pairs.mapInPandas(said, "a long, b long, swap boolean, shown_a long, shown_b long, outcome string")

    out = pairwise.in_rounds(items, judge, (2, 2), seed=1)
    before = asked.value
    assert out.count() == 24 and out.collect() and asked.value == before <= 24 * 4


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().sparkPlan().toString()


def test_partners_of_many_items_are_not_broadcast(spark):
    """A numbered table is small in files and large in memory: it is joined by a shuffle."""
    items = spark.range(60_000).select(F.col("id").alias("item"), (F.col("id") % 1000 / 10).alias("value"))
    near = pairwise.band_partners(items, "value", 0.15, 4)
    assert "Broadcast" not in plan(near) and near.count() == 240_000


def test_adaptive_pairs_of_many_items_are_not_broadcast(spark, monkeypatch):
    from fernworks.sources import files

    monkeypatch.setattr(files, "MERGED_ROWS", 300)
    theta = spark.range(400).select(F.col("id").alias("item"), (F.col("id") % 50 / 10).alias("theta"))
    plans, first = [], pairwise.matched
    monkeypatch.setattr(pairwise, "matched", lambda edges, *a: plans.append(plan(edges)) or first(edges, *a))
    assert pairwise.adaptive_pairs(theta, 3).count() > 500
    assert len(plans) == 1 and "Broadcast" not in plans[0]


def test_adaptive_pairs_send_no_table_of_items_to_all_tasks(spark, monkeypatch):
    """Neither the candidates nor the partners of items that lack some: the result's own plan has no broadcast."""
    from fernworks.sources import files

    monkeypatch.setattr(files, "MERGED_ROWS", 300)
    theta = spark.range(400).select(F.col("id").alias("item"), (F.col("id") % 50 / 10).alias("theta"))
    out = pairwise.adaptive_pairs(theta, 3)
    assert "Broadcast" not in plan(out) and out.count() > 500


def test_band_pairs_of_common_values(spark, monkeypatch):
    """Values that many items share are met block by block: each pair once, also of items that come twice; no pair without a number."""
    import duckdb
    import pandas as pd

    from fernworks.plans.catalogue import SQL

    monkeypatch.setattr(pairwise, "BLOCK_ITEMS", 4)
    rng = np.random.default_rng(5)
    values = [*rng.choice([900.0, 900.1, 900.15, 900.3, -0.0, 0.0, 0.15, 1e300], 150).tolist(), *rng.normal(900, 1, 60).tolist(), math.inf, math.inf, -math.inf, math.nan, math.nan, None]
    rows = [(i - 3 if i % 40 == 7 else i, v) for i, v in enumerate(values)]
    out = pairwise.band_pairs(spark.createDataFrame(rows, "p_partkey long, p_retailprice double"), "p_retailprice", 0.15, "p_partkey")
    con = duckdb.connect()
    con.execute("CREATE TABLE part (p_partkey BIGINT, p_retailprice DOUBLE)")
    con.executemany("INSERT INTO part VALUES (?, ?)", rows)
    want = con.execute(SQL["h17_band_pairs"]).fetchall()
    assert got(out, "a", "b") == sorted(want) and len(want) > 3000
    assert pairwise.band_pairs(spark.createDataFrame(pd.DataFrame({"item": [1], "v": [1.0]})), "v", 0.15).count() == 0


def test_residuals_of_groups_of_one_and_of_copies(spark):
    """Nothing is left of the only occupation of a group: NaN, before all numbers, as DuckDB has it. Copies tie by code."""
    import duckdb

    from fernworks.plans.catalogue import SQL

    rng = np.random.default_rng(3)
    x = rng.normal(size=(190, 64)).astype("float32")
    label = [i % 9 for i in range(190)]
    label[7] = 77
    for i in range(10, 90):
        if i % 9 == 1:
            x[i] = x[1 if i < 50 else 91]
    x[150] = x[7]
    embeddings = spark.createDataFrame([(i, v.tolist(), g) for i, (v, g) in enumerate(zip(x, label, strict=True))], "vec_id long, embedding array<float>, label int")
    ads = embeddings.filter("vec_id >= 100").select(F.col("vec_id").alias("ad_id"), "embedding")
    occupations = embeddings.filter("vec_id < 100").select(F.col("vec_id").alias("onet_code"), "embedding", F.col("label").alias("major_group"))
    con = duckdb.connect()
    con.register("e", embeddings.toPandas())
    con.execute("CREATE VIEW embeddings AS SELECT vec_id, embedding::FLOAT[] AS embedding, label FROM e")
    want = con.execute(SQL["h25_centroid_residual_topk"]).fetchall()
    out = vectors.residual_topk(ads, occupations, 5).withColumn("cosine_score", F.round("cosine_score", 6))
    assert {(a, r): (c, str(s)) for a, r, c, s in got(out, "ad_id", "rank", "onet_code", "cosine_score")} == {(a, r): (c, str(s)) for a, r, c, s in want}
    assert sum(math.isnan(r[3]) for r in want) >= 90
