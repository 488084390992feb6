"""Jaccard join, components, mixing, revisits, URL filters, searches and the pipeline, against plain versions and SQL."""

import gzip
import random

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import SMALL, database, same
from pyspark.sql import functions as F

from fernworks.llm import ann, components, jaccard, mixing, registry, topk, url_filter, vectors, warc


@pytest.fixture(scope="module")
def con():
    return database()


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_as_duckdb(spark, con, name):
    same(registry.QUERIES[name](spark, SMALL), con, registry.SQL[name])


def near_copies(seed=0, n=60):
    """Texts in groups whose members differ by a few words, with copies, shared passages, blanks and short ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    passage = [word() for _ in range(55)]
    texts = [None, "", "  \n", "one", "One", "two words", "two  words", "a b c d e", "A B c d e"]
    for g in range(12):
        base = [word() for _ in range(rng.choice((8, 40, 120)))]
        for _ in range(rng.choice((1, 3, n // 3))):
            t = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 4))):
                t[rng.randrange(len(t))] = word()
            texts.append(" ".join(t))
    for _ in range(40):
        texts.append(" ".join(passage + [word() for _ in range(rng.choice((2, 10, 60)))]))
    texts += texts[20:25] * 3
    rng.shuffle(texts)
    return [(None if i % 50 == 7 else i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("chunks", [None, (8, 5)])
def test_jaccard(spark, monkeypatch, chunks):
    if chunks:
        monkeypatch.setattr(jaccard, "BUCKET_CHUNK", chunks[0])
        monkeypatch.setattr(jaccard, "GROUP_CHUNK", chunks[1])
    rows = near_copies()
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("root", F.lit("clash")).repartition(5)
    got = [tuple(r) for r in jaccard.jaccard_classes(d).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    want = [(k, c if brute.shingle_set(t) else k, *rest) if brute.shingle_set(t) else (k, k, 0, 0, 1) for (k, t), (_, c, *rest) in zip(rows, brute.jaccard_classes(rows), strict=True)]
    assert sorted(got, key=key) == sorted(map(tuple, want), key=key)
    kept = jaccard.one_of_each(d)
    assert kept.columns == d.columns
    with_words = {r[1] for r in want if brute.shingle_set(dict(rows).get(r[0]) if r[0] is not None else "x")}
    ids = [r["doc_id"] for r in kept.collect()]
    assert {i for i in ids if i is not None} >= {c for c in with_words if c is not None} and len(ids) < len(rows)


def test_jaccard_edges(spark):
    d = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "x"), (2, "a b c d e f g")], "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard.jaccard_classes(d).collect()) == [(1, 1, 0, 0, 1), (1, 1, 2, 0, 3), (1, 1, 2, 0, 3), (2, 1, 2, 0, 3)]
    assert jaccard.one_of_each(d).count() == 2
    assert jaccard.jaccard_classes(d.limit(0)).count() == 0 and jaccard.one_of_each(d.limit(0)).count() == 0


def test_exact_threshold():
    a, b = np.arange(9, dtype=np.uint64), np.arange(1, 10, dtype=np.uint64)  # 8 of 10
    sets = jaccard.Sets([a, b, a[:7]])
    for at_once in (1, 1 << 20):
        assert sets.verified(np.array([0, 0]), np.array([1, 2]), 0.8, at_once).tolist() == [True, False]


def test_long_near_copies(spark, monkeypatch):
    """Long texts that are nearly alike are cut into chunks by their bytes, and none is cut short."""
    monkeypatch.setattr(jaccard, "GROUP_BYTES", 200_000)
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(15_000)]
    rows = []
    for i in range(9):
        t = list(base)
        t[-1] = f"end{i}"  # only the last word differs
        rows.append((i, " ".join(t)))
    rows.append((9, " ".join(base[:9_000])))
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in jaccard.jaccard_classes(d).collect()) == [(i, 0, 8, 8, 1) for i in range(9)] + [(9, 9, 0, 0, 1)]


def test_pruning_keeps_links():
    """Pairs at the threshold are practically never dropped, dissimilar ones early."""
    rng = np.random.default_rng(0)
    same_ = rng.random((20000, jaccard.VALUES)) < 0.8
    sig = np.zeros((2, jaccard.VALUES), np.uint16)
    kept = sum(len(jaccard.survivors(np.stack([sig[0], (~row).astype(np.uint16)]), np.array([0]), np.array([1]), 0.8, 1e-6)) for row in same_[:3000])
    assert kept == 3000
    assert len(jaccard.survivors(rng.integers(0, 2**16, (2, jaccard.VALUES), dtype=np.uint16), np.array([0]), np.array([1]), 0.8, 1e-6)) == 0


def test_minhash_estimates():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    same_ = np.mean([(jaccard.minhash(x[:900]) == jaccard.minhash(np.concatenate([x[:800], rng.integers(0, 2**63, 100, dtype=np.uint64)]))).mean() for _ in range(5)])
    assert abs(same_ - 0.8) < 0.12


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 150)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)] + [(7, 7), (300, 300), (None, 3)]
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        if a is not None:
            p, q = root(a), root(b)
            label[max(p, q)] = min(p, q)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {x: root(x) for x in label}
    assert components.components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_components_of_hubs(spark, monkeypatch):
    monkeypatch.setattr(components, "HUB", 3)
    edges = [(0, x) for x in range(1, 30)] + [(99, x) for x in range(20, 60)] + [(200, 201), (201, 202), (202, 203)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**{x: 0 for x in [*range(60), 99]}, 200: 200, 201: 200, 202: 200, 203: 200}


def filled(sizes, weights, most=3):
    """Targets by repeated resharing."""
    total, fixed = sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left = total - sum(fixed.values())
        w = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / w > most * sizes[i]] if free else []
        if not over:
            return [fixed.get(i, left * weights[i] / w if free else 0.0) for i in range(len(sizes))]
        fixed |= {i: float(most * sizes[i]) for i in over}


@pytest.mark.parametrize("seed", range(3))
def test_mixing(spark, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.choice((1, 5, 50, 400))), rng.choice(["a", "b", "b", "b", "ü", "Z", None])) for i in range(150)] + [(500, None, "a"), (501, " \x0b", "empty"), (None, "w w", None), (1, "w", "a"), (1, "w", "a")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("taken", F.lit("clash"))
    out = [r.asDict() for r in mixing.mix(d).collect()]
    assert len(out) == len(rows) and [r["position"] for r in out] == sorted(r["position"] for r in out)
    names = sorted({s for *_, s in rows if s is not None}) + [None]
    size = {n: sum(len((t or "").split()) for _, t, s in rows if s == n) for n in names}
    want = dict(zip(names, filled([size[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))]), strict=True))
    of = {}
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        key = (r["source_size"], round(r["target"], 6))
        of[key] = of.get(key, 0) + r["taken"]
    for n in names:
        assert any(s == size[n] and abs(t - want[n]) < 1e-3 and abs(v - want[n]) <= 1 for (s, t), v in of.items())
    again = [r.asDict() for r in mixing.mix(d.repartition(7)).collect()]
    assert sorted(map(str, out)) == sorted(map(str, again))
    order = mixing.training_order(d)
    assert order.columns == d.columns
    uses = [r["doc_id"] for r in order.collect()]
    assert max(uses.count(i) for i in range(2, 150)) <= 3 and 501 not in uses and 500 not in uses


def test_mixing_edges(spark):
    kind = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], kind)).count() == 0
    assert [(r["taken"], r["target"]) for r in mixing.mix(spark.createDataFrame([(1, None, None), (2, "", "x")], kind)).collect()] == [(0, 0.0)] * 2
    assert mixing.mix(spark.createDataFrame([(1, "a b c", "x")], kind)).first()["taken"] == 3


def test_curriculum():
    """Positions follow the integral of the rate."""
    con = duckdb.connect()
    for tilt in (-0.4, 0.0, 0.3):
        for u in (0.1, 0.5, 0.9):
            x = u + tilt * (u * u - u)
            assert con.execute(f"select 2.0 * {x} / ((1 - ({tilt})) + sqrt((1 - ({tilt})) ** 2 + 4.0 * ({tilt}) * {x}))").fetchall()[0][0] == pytest.approx(u)


CAPTURES = [
    ("r1", "http://www.Example.com/a/?utm_source=x#f", 10, "response", {"etag": "1", "content-type": "t", "date": "10"}), ("r2", "https://example.com/a", 20, "response", {"etag": "2", "last-modified": "m"}),
    ("v1", "example.com/a", 15, "revisit", {"etag": "1", "date": "15", "content-length": "0", "expires": "e"}), ("v2", "http://example.com:80/a", 25, "revisit", {"etag": "1"}), ("v3", "http://example.com/a", 30, "revisit", {"last-modified": "m"}),
    ("v4", "http://example.com/a", 10, "revisit", {}), ("v5", "http://example.com/b", 99, "revisit", {}), ("v6", None, 99, "revisit", {}), ("v7", "http://example.com/a", None, "revisit", {"etag": "2"}), ("v8", "http://example.com/a", 40, "revisit", {}),
    ("v8", "http://example.com/a", 40, "revisit", {}), ("r3", "http://example.com/a", None, "response", {"etag": "9"}),
]


@pytest.mark.parametrize("buckets", [2, 256])
def test_revisits(spark, buckets):
    c = spark.createDataFrame(CAPTURES, "id string, url string, time long, kind string, headers map<string,string>")
    out = sorted((r["id"], r["response_id"], r["status"], r["headers"]) for r in warc.resolve_revisits(c, buckets).collect())
    assert out[0] == ("v1", "r1", "resolved", {"etag": "1", "content-type": "t", "date": "15", "expires": "e"})
    assert [o[:3] for o in out[1:]] == [("v2", "r2", "mismatch"), ("v3", "r2", "resolved"), ("v4", None, "missing"), ("v5", None, "missing"), ("v6", None, "missing"), ("v7", None, "missing"), ("v8", "r2", "resolved"), ("v8", "r2", "resolved")]
    assert warc.resolve_revisits(c.limit(0), buckets).count() == 0


def test_many_revisits(spark):
    """One URL with most captures, against a plain as-of search."""
    rng = random.Random(5)
    rows = [(f"{i}", "http://a/x" if rng.random() < 0.8 else f"http://a/{rng.randrange(5)}", rng.randrange(200), rng.choice(["response", "revisit"]), {"etag": str(rng.randrange(2))}) for i in range(400)]
    c = spark.createDataFrame(rows, "id string, url string, time long, kind string, headers map<string,string>")
    got = {r["id"]: (r["response_id"], r["status"]) for r in warc.resolve_revisits(c, 16).collect()}
    for i, u, t, k, h in rows:
        if k == "revisit":
            before = max(((tt, ii, hh["etag"]) for ii, uu, tt, kk, hh in rows if kk == "response" and uu == u and tt < t), default=None)
            assert got[i] == ((before[1], "resolved" if before[2] == h["etag"] else "mismatch") if before else (None, "missing"))


def test_reading_warc(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nETag: \"x\"\r\nContent-Type: text/html\r\n\r\n<p>body</p>"
    rec = lambda kind, block: b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Record-ID: <u>\r\nWARC-Target-URI: http://a/\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: " + str(len(block)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(rec(b"warcinfo", b"x") + rec(b"response", http))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(rec(b"revisit", b"HTTP/1.1 304 Not Modified\r\nETag: \"x\"\r\n\r\n")) + gzip.compress(rec(b"response", http)))
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted(r["kind"] for r in rows) == ["response", "response", "revisit"]
    assert {bytes(r["body"]) for r in rows if r["kind"] == "response"} == {b"<p>body</p>"} and rows[0]["headers"]["etag"] == '"x"' and rows[0]["time"] == 1704067200


def test_reading_damaged_warc(spark, tmp_path):
    """What is whole is read: bad lengths, bad dates, cut off blocks and members."""
    rec = lambda n, date=b"2024-01-01T00:00:00Z", length=None: b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: " + n + b"\r\nWARC-Date: " + date + b"\r\nContent-Length: " + (length or b"9") + b"\r\n\r\nHTTP\r\n\r\nx\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(rec(b"1", b"yesterday") + rec(b"2", length=b"x9") + rec(b"3", length=b"-1") + rec(b"4", b"2024-01-01") + rec(b"5", length=b"999"))
    whole = gzip.compress(rec(b"6")) + gzip.compress(rec(b"7") * 50)
    (tmp_path / "b.warc.gz").write_bytes(whole[:-30])
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(rec(b"8")) + b"no gzip member")
    (tmp_path / "d.warc").write_bytes(b"")
    got = {(r["id"], r["time"]) for r in warc.read_warc(spark, str(tmp_path)).collect()}
    assert {("1", None), ("4", 1704067200), ("6", 1704067200), ("8", 1704067200)} <= got and not {"2", "3", "5"} & {i for i, _ in got}


def test_url_filter_where_most_have_no_host(spark):
    """Rows without host and path need no join by key; a rule for nothing fits them."""
    pages = spark.createDataFrame([(i, None if i % 2 else "nothing") for i in range(50)] + [(99, "http://a.com/x")], "page_id long, url string")
    rules = spark.createDataFrame([("a.com", "/", "block"), ("", "", "block")], "host string, path string, action string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, rules).collect()}
    assert len(got) == 51 and got[99] == ("a.com/", "block") and got[3] == got[4] == ("", "block")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, rules.filter("host <> ''")).collect()}
    assert len(got) == 51 and got[3] == (None, "allow")


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "http://example.com/en/", "http://example.com/en", "http://a.b.example.com/en/?q", "http://example.com", "http://x.net/es/1#f", "http://net/fr/", "http://notnet/fr/", "ftp://e.org/en/", "http://com?x", "http://x.com:80/en/", "x://a.net?://y/es/", "http://" + "a." * 300 + "net/fr/" + "b/" * 300, "http://example.com/en/", "http://example.com/EN/"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(None, "http://x.net/es/")], "page_id long, url string").withColumn("rule", F.lit("clash"))
    con = duckdb.connect()
    table = pages.toPandas()
    con.register("pages", table)
    same(url_filter.filter_urls(pages, url_filter.rule_table(spark)), con, url_filter.SQL)
    out = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, url_filter.rule_table(spark)).collect()}
    assert out[4] == ("www.example.com/en/", "allow") and out[7] == ("example.com/en/", "block") and out[8] == (None, "allow") and out[16] == ("net/fr/", "block")
    both = url_filter.rule_table(spark, (("a", "/x", "allow"), ("a", "/x", "block"), ("a", "/", "allow")))
    assert [r["verdict"] for r in url_filter.filter_urls(spark.createDataFrame([(1, "h://a/xyz")], "page_id long, url string"), both).collect()] == ["block"]
    assert {r["verdict"] for r in url_filter.filter_urls(pages, both.limit(0)).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.limit(0), both).count() == 0


def odd_vectors(spark, n=700, d=64, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[200:420] = x[200] + rng.normal(size=(220, d)).astype(np.float32) * 1e-3
    x[500:520] = x[500]  # ties
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    bad = [(n, None), (n + 1, [0.0] * d), (n + 2, [float("nan")] * d), (n + 3, [1.0] * (d - 1) + [None]), (n + 4, [float("inf")] * d), (None, [1.0] * d), (n + 5, [1.0] * 3)]
    return x, spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))


def brute_nearest(x, q, k=10):
    dist = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
    dist[q] = np.inf
    return np.lexsort((np.arange(len(x)), dist))[:k], dist


@pytest.mark.parametrize("n", [700, 6000])
def test_ann(spark, monkeypatch, n):
    """Recall, exact scores, and how many rows have been compared exactly."""
    x, t = odd_vectors(spark, n)
    monkeypatch.setattr(vectors, "SHARD_BYTES", 1 << 20)
    counted = spark.sparkContext.accumulator(0)
    out = {}
    for r in ann.nearest(t, t.filter("vec_id % 100 = 0"), reranked=counted).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(out) == list(range(0, n, 100))
    hit = 0
    for q, found in out.items():
        want, dist = brute_nearest(x, q)
        assert [f[0] for f in sorted(found)] == list(range(1, 11)) and all(abs(dist[i] - s) < 1e-9 for _, i, s in found)
        hit += len(set(want) & {i for _, i, _ in found})
    assert hit / (n / 10) >= 0.9
    assert 0 < counted.value <= len(out) * (ann.RERANK + 250)  # 220 rows are nearly alike
    if n >= 5000:
        assert counted.value < 0.05 * len(out) * n


def test_ann_beyond_the_sample(spark, monkeypatch):
    """The codebooks and limits of a small sample serve an index that is many times as large."""
    monkeypatch.setattr(ann, "SAMPLE", 600)
    x, t = odd_vectors(spark, 6000, 16)
    out = {}
    for r in ann.nearest(t, t.filter("vec_id % 100 = 0")).collect():
        out.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert all(len(v) == 10 for v in out.values()) and len(out) == 60
    assert sum(len(out[q] & set(brute_nearest(x, q)[0].tolist())) for q in out) / 600 >= 0.9


@pytest.mark.parametrize("kind", ["lengths that differ much", "half in narrow groups"])
def test_ann_of_rows_approximated_unequally(spark, kind):
    """No neighbour is lost where some rows are approximated much worse than others."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 64))
    if kind == "lengths that differ much":
        x *= np.exp(rng.normal(size=(4000, 1)) * 2)
    else:
        inside = rng.random(4000) < 0.5
        x[inside] = rng.normal(size=(4, 64))[rng.integers(0, 4, inside.sum())] + x[inside] * 1e-3
    x = x.astype("float32")
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    out = {}
    for r in ann.nearest(t, t.filter("vec_id % 100 = 0")).collect():
        out.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert len(out) == 40 and sum(len(out[q] & set(brute_nearest(x, q)[0].tolist())) for q in out) >= 0.99 * 400


def test_ann_where_most_rows_share_a_vector(spark, monkeypatch):
    """Rows with one vector are found by their ids, and cost a query few distances; shards hold no vectors."""
    monkeypatch.setattr(vectors, "SHARD_BYTES", 1 << 16)
    rng = np.random.default_rng(9)
    common = rng.normal(size=8).astype("float32")
    x = np.where(rng.random(3000)[:, None] < 0.7, common, rng.normal(size=(3000, 8)).astype("float32"))
    t = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(rng.permutation(3000), x, strict=True)], "vec_id long, embedding array<float>").repartition(4)
    by_id = {r["vec_id"]: np.array(r["embedding"]) for r in t.collect()}
    counted = spark.sparkContext.accumulator(0)
    out = {}
    for r in ann.nearest(t, t.filter("vec_id % 100 = 0"), reranked=counted).collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    shared = sorted(i for i, v in by_id.items() if (v == common.astype(float)).all())
    hit = 0
    for q, found in out.items():
        if q in shared:
            assert sorted(found) == [(0.0, i) for i in [i for i in shared if i != q][:10]]
        want = sorted((float(np.linalg.norm(by_id[q] - v)), i) for i, v in by_id.items() if i != q)[:10]
        hit += len({i for _, i in found} & {i for _, i in want})
    assert len(out) == 30 and hit >= 270 and counted.value < 30 * 700
    assert ann._first_twins(np.array([5, 3, 9, 1]), [b"a" * 16, b"b" * 16, b"a" * 16, b"a" * 16], 2).tolist() == [0, 1, 3]
    assert ann._first_twins(np.zeros(0, np.int64), [], 2).tolist() == []


def test_ann_hands_on_the_nearest_of_a_shard_only(spark, monkeypatch):
    """Rows are measured where they lie: what is moved doesn't grow with the number of rows that are reranked."""
    x = np.random.default_rng(12).normal(size=(3000, 16)).astype(np.float32)
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    counted, moved = spark.sparkContext.accumulator(0), []
    merged = ann.merged
    monkeypatch.setattr(ann, "merged", lambda found, k: moved.append(found.count()) or merged(found, k))
    out = {}
    for r in ann.nearest(t, t.filter("vec_id % 100 = 0"), k=3, reranked=counted).collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert moved[0] <= 30 * 3 * spark.sparkContext.defaultParallelism < counted.value
    want = {q: [(i, d) for d, i in sorted((float(np.sqrt(((x[q].astype(float) - x[i]) ** 2).sum())), i) for i in range(3000) if i != q)[:3]] for q in out}
    assert len(out) == 30 and sum(len({i for i, _ in out[q]} & {i for i, _ in want[q]}) for q in out) >= 0.9 * 90
    assert all(abs(d - float(np.sqrt(((x[q].astype(float) - x[i]) ** 2).sum()))) < 1e-12 for q in out for i, d in out[q])


def test_ann_of_odd_sizes(spark):
    """Large, small and far-off components; doubles keep their precision."""
    rows = [(i, [1e300 * (i + 1), 1.0]) for i in range(4)] + [(10 + i, [1e8 + i * 1e-3, 5.0]) for i in range(5)] + [(20, [1e-200, 0.0]), (21, [2e-200, 0.0])]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {}
    for r in ann.nearest(t, t, k=10).collect():
        out.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    assert all(len(v) == 10 for v in out.values())
    assert out[0][1] == pytest.approx(1e300) and out[10][12] == pytest.approx(2e-3, rel=1e-4) and out[20][21] == pytest.approx(1e-200)


def test_small_searches(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.1]), (2, [1.0, 0.1])], "vec_id long, embedding array<float>")
    assert [(r["vec_id"], r["rank"]) for r in ann.nearest(few, few.filter("vec_id = 0")).collect()] == [(2, 1), (2, 2), (1, 3)]
    assert ann.nearest(few.limit(0), few.limit(0)).count() == 0 and ann.nearest(few, few.limit(0)).count() == 0
    codes = topk.codes_of(vectors.valid(few, "vec_id", "embedding")[0])
    assert [(r["vec_id"], r["score"]) for r in topk.top_k(codes, codes.filter("id = 2")).collect()] == [(0, 1.0), (1, 1.0)]
    assert topk.top_k(codes.limit(0), codes.limit(0)).count() == 0


@pytest.mark.parametrize("d", [1, 64, 65, 128, 200])
def test_codes_are_of_whole_vectors(spark, d):
    """Any dimension, against the query's SQL: signs beyond the first 64 count too."""
    rng = np.random.default_rng(d)
    rows = [(i, [float(x) for x in np.where(rng.random(d) < 0.1, 0, rng.normal(size=d))]) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(20)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    t = t.filter(F.exists("embedding", lambda x: x != 0))
    codes = topk.codes_of(vectors.valid(t, "vec_id", "embedding")[0])
    out = topk.top_k(codes, codes.filter("id % 100 = 0")).select("query_id", "rank", "vec_id", F.col("score").cast("int").alias("distance"))
    con = duckdb.connect()
    con.register("embeddings", pa.Table.from_pylist([{"vec_id": r["vec_id"], "embedding": list(r["embedding"])} for r in t.collect()]))
    same(out, con, topk.SQL)


def test_the_mix_is_in_exact_order(spark):
    """Positions that are equal to six places are still in the order of the curriculum."""
    d = spark.createDataFrame([(i, "w " * (1 + i % 3), "ab"[i % 2]) for i in range(3000)], "doc_id long, text string, source string")
    rows = mixing.mix(d, slope=0.8).collect()
    order = [r["doc_id"] for r in rows if r["taken"] > 0 and d is not None]
    exact = mixing._placed(mixing._base(d, F.col("doc_id")))
    first = mixing._at(F.col("before") + F.when(F.col("rounds") > 0, F.col("size")).otherwise(F.col("rest")) / 2.0, F.col("target"), F.col("tilt"))
    place = {r["row"]: (r["p"], r["key"]) for r in exact.withColumn("p", first).filter("taken > 0").collect()}
    assert order == sorted(place, key=place.get)


@pytest.mark.parametrize("rows", [1 << 16, 50])
def test_exact_top_k(spark, monkeypatch, rows):
    monkeypatch.setattr(vectors, "SHARD_BYTES", rows * 512)
    monkeypatch.setattr(topk, "SAMPLE", rows)
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 2**63, 600, dtype=np.uint64)
    codes[100:300] = codes[100]
    codes[300:400] = codes[300] ^ (np.uint64(1) << rng.integers(0, 63, 100).astype(np.uint64))
    t = spark.createDataFrame([(i, int(c)) for i, c in enumerate(codes)], "id long, code long").repartition(3)
    out = {}
    for r in topk.top_k(t, t.filter("id % 50 = 0"), 10).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], int(r["score"])))
    for q in range(0, 600, 50):
        dist = np.bitwise_count(codes ^ codes[q]).astype(int)
        dist[q] = 999
        want = np.lexsort((np.arange(600), dist))[:10]
        assert [(i, s) for _, i, s in sorted(out[q])] == [(int(i), int(dist[i])) for i in want]


def test_pipeline(spark):
    """Each stage on its own input: what it must keep, and what must be gone."""
    import corpus_pipeline as c
    from fernworks.llm.common import written

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = {}
    for name, stage in c.STAGES:
        before, docs = docs, written(stage(spark, docs, SMALL), "test")
        seen[name] = (before, docs)
    before, after = seen["toxicity"]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    assert after.columns == before.columns and before.join(labels.filter("toxic = 0"), "doc_id", "left_semi").join(after, "doc_id", "left_anti").count() <= 2
    before, after = seen["n-gram Jaccard join"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    classes = brute.jaccard_classes(rows)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({k if not brute.shingle_set(t) else cl for (k, t), (_, cl, *_) in zip(rows, classes, strict=True)})
    before, after = seen["mixing sources to target weights"]
    assert after.columns == before.columns and 0.8 < sum(len(r["text"].split()) for r in after.collect()) / sum(len(r["text"].split()) for r in before.collect()) < 1.5
    before, after = seen["BPE encoding and decoding"]
    assert after.count() == before.count()


def test_pipeline_keeps_the_training_order(spark):
    """The last stage's rows, read in any way, stand in the order that the mix has made."""
    import corpus_pipeline as c
    from fernworks.llm.common import written

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    wanted = mixing.training_order(docs)
    order = [r["doc_id"] for r in wanted.select("doc_id").collect()]
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # several files
    try:
        mixed = written(mixing.training_order(docs), "mixed")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(mixed.inputFiles()) > 1
    for given in (mixed, wanted):  # read from files, and not yet written
        rows = c.encode(spark, given, SMALL).collect()
        assert [r["doc_id"] for r in rows] == order and [r["position"] for r in rows] == list(range(len(order)))
    assert c.encode(spark, mixed.limit(0), SMALL).count() == 0
    final = c.run(spark, SMALL)
    assert [r["position"] for r in final.collect()] == list(range(final.count()))


def test_pipeline_edges(spark, tmp_path):
    """Nulls, blanks, repeated rows, clashing columns and empty tables go through every stage."""
    import corpus_pipeline as c
    from fernworks.llm import common

    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").filter("false").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "s", 1), (2, None, None, None, 0), (3, "", "en", "s", 0), (None, "x y", "de", None, 3), (4, "long " * 50000, "en", "t", 9)]
    full = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("clash")).withColumn("row", F.lit(1)).withColumn("position", F.lit(0.5)).withColumn("k0", F.lit("k"))
    for docs in (full, full.limit(0)):
        for _, stage in c.STAGES[:-1]:
            out = common.written(stage(spark, docs, str(tmp_path)), "edges")
            assert sorted(out.columns) == sorted(docs.columns)
            docs = out
        last = c.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert {r["doc_id"] for r in last} <= {1, None, 4}
    assert {r["doc_id"] for r in c.one_of_each(spark, full, "").collect()} == {1, 2, 3, 4, None} and c.one_of_each(spark, full, "").count() == 5
    common.clean(spark)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace as N

    from fernworks.llm import common

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(N(conf=N(get=lambda *_: None), sparkContext=N(getCheckpointDir=lambda: None, master="spark://x:7077")))
