"""Packing, spelling variants and vector codes against plain versions."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fernworks.llm import compression, ids, packing, registry, spelling

WORD = public_tokenizers.path("word_bpe_49k.json")
SIGNS = ["t", "A", "é", "É", "'s", "'", "S", "'LL", ".", " ", "\n", "<|endoftext|>", "<|", "|>", "%", "7", "ß", "İ", "́", "̸", "=", "数", "\x01", "\x85", "\xa0", "_", "ﬀ", "µ", "Σ", "  "]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(WORD)
    t.no_truncation()
    t.no_padding()
    return t


@given(st.lists(st.lists(st.sampled_from(SIGNS), max_size=25).map("".join), max_size=6))
@settings(max_examples=200, deadline=None)
def test_ids_are_the_librarys(texts):
    own = ids.ids_of(WORD)
    assert own.joins and own.set_off
    flat, counts = own.of(pa.array(texts, pa.string()))
    ends = np.cumsum(counts).tolist()
    got = [flat[e - n : e].tolist() for e, n in zip(ends, counts.tolist(), strict=True)]
    assert got == [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_with_few_words_held(tokenizer):
    own, rng = ids.Ids(WORD, held=8), random.Random(0)
    for k in range(30):
        texts = [" ".join(rng.choices(["common", "also", *(f"rare{i}x" for i in range(40)), "plainword" + "abc"[k % 3]], k=9)) for _ in range(4)]
        flat, counts = own.of(pa.array(texts))
        assert flat.tolist() == [i for t in texts for i in tokenizer.encode(t, add_special_tokens=False).ids] and len(own.number) < 200


def test_ids_refuse_a_tokenizer_that_sees_spaces():
    with pytest.raises(ValueError):
        ids.Ids(public_tokenizers.path("byte_bpe_50k.json"))


@given(st.lists(st.integers(1, 63), max_size=200))
@settings(max_examples=100, deadline=None)
def test_windows_are_full(lengths):
    out = packing.fill(lengths, (64, 32, 16, 8))
    sizes = [sum(n for _, _, n in s) for s in out]
    assert all(n & (n - 1) == 0 and 0 < n <= 64 for n in sizes) and sum(sizes) == sum(lengths)
    assert sum(n < 8 for n in sizes) <= 3 and sizes == sorted(sizes, reverse=True)  # what is under the shortest context is the end
    held = defaultdict(list)
    for s in out:
        for i, at, n in s:
            held[i].append((at, n))
    for i, n in enumerate(lengths):
        at = 0
        for a, m in sorted(held[i]):
            assert a == at and m > 0
            at += m
        assert at == n
    assert sum(map(len, out)) <= len(lengths) + len(out)  # a cut for each window


def test_chunks_that_fit_stay_whole():
    assert packing.fill([40, 24, 20, 12, 64 - 1, 1], (64, 32, 16, 8)) == [[(4, 0, 63), (5, 0, 1)], [(0, 0, 40), (1, 0, 24)], [(2, 0, 20), (3, 0, 12)]]


def test_steps_are_even():
    rng = random.Random(1)
    sequences = [[(0, 0, n)] for n in rng.choices([4096, 2048, 1024, 512, 256], k=3000)]
    group = packing.steps(sequences, 64 * 4096)
    sums = Counter()
    for s, g in zip(sequences, group, strict=True):
        sums[g] += s[0][2]
    assert len(sums) == round(sum(s[0][2] for s in sequences) / (64 * 4096)) and max(sums.values()) - min(sums.values()) <= 256


def packed_rows(rng, n=120):
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.choice((2, 5, 9))))
    texts = [" ".join(word() for _ in range(rng.choice((0, 1, 3, 20, 90, 400)))) for _ in range(n)]
    return [*enumerate(texts), (None, None), (None, "a b"), (5, "again"), (5, "again"), (7, "x" * 700), (8, "<|endoftext|> it's\x01 数学 é")]


@pytest.mark.parametrize("how", [{"cell_ids": 3000, "pack_bytes": 300, "step_windows": 4}, {}])
def test_packing_holds_each_id_once(spark, tokenizer, how):
    rows = packed_rows(random.Random(3))
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("start", F.lit(1)).repartition(6)
    contexts = (128, 64, 32, 16)
    out = packing.pack(d, WORD, contexts=contexts, **how)
    got = [r.asDict() for r in out.collect()]
    assert out.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "context", "step"]
    want = Counter((k, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])) for k, t in rows)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"], r["doc_tokens"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
        by_sequence[r["sequence_id"]].append(r)
        assert len(r["ids"]) == 4 * r["length"] > 0
    all_of = Counter()
    for (k, t), times in want.items():
        all_of[k, len(t)] += times * len(t)
    assert Counter({key: sum(len(x) for _, x in v) for key, v in by_doc.items()}) == all_of
    for (k, t), times in want.items():
        if times == 1 and sum(x == (k, len(t)) for x in ((a, len(b)) for a, b in want)) == 1:
            pieces = sorted(by_doc[k, len(t)])
            assert [s for s, _ in pieces] == np.cumsum([0, *(len(x) for _, x in pieces[:-1])]).tolist() and tuple(i for _, x in pieces for i in x) == t
    for s in by_sequence.values():
        s.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in s] == np.cumsum([0, *(r["length"] for r in s[:-1])]).tolist()
        size = sum(r["length"] for r in s)
        assert size <= 128 and size & (size - 1) == 0 and {r["context"] for r in s} == {size} and len({r["step"] for r in s}) == 1
    total, cuts = sum(map(len, (t for (_, t), n in want.items() for _ in range(n)))), len(got) - sum(math.ceil(len(t) / 128) * n for (_, t), n in want.items())
    assert cuts <= len(by_sequence) and total == sum(r["length"] for r in got)
    whole = {r["sequence_id"]: r for r in packing.sequences(out).collect()}
    assert {k: b"".join(bytes(r["ids"]) for r in s) for k, s in by_sequence.items()} == {k: bytes(r["ids"]) for k, r in whole.items()}
    assert all([p["doc_id"] for p in whole[k]["pieces"]] == [r["doc_id"] for r in s] for k, s in by_sequence.items())


def test_packing_is_alike_again_and_of_nothing(spark):
    d = spark.createDataFrame(packed_rows(random.Random(4)), "doc_id long, text string").repartition(4)
    key = lambda r: tuple((x is None, x) for x in r)
    a, b = (sorted((tuple(r) for r in packing.pack(d, WORD, contexts=(64, 32), cell_ids=2000).drop("ids").collect()), key=key) for _ in range(2))
    assert a == b
    assert packing.pack(d.limit(0), WORD).count() == 0
    with pytest.raises(ValueError):
        packing.pack(d, WORD, contexts=(100, 50))


def test_op11_digests(spark, tokenizer):
    from helpers import SMALL

    out = registry.op11_packing(spark, SMALL).toPandas()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert set(out.doc_id) == set(texts)
    for r in out.sample(200, random_state=0).itertuples():
        t = np.array([*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 2], "<u4")
        assert r.doc_tokens == len(t) and r.ids_crc32 == zlib.crc32(t[r.start : r.start + r.length].tobytes())
    sizes = out.groupby("sequence_id").length.sum()
    assert (sizes & (sizes - 1) == 0).all() and sizes.max() == 4096 and out.length.sum() == out.drop_duplicates("doc_id").doc_tokens.sum()


def plain_counts(rows, modulus=97):
    out = Counter()
    for k, text in rows:
        for w in spelling.RUN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            h = zlib.crc32(f"{'' if k is None else k}:{w}".encode())
            out[w[: h % len(w)] + w[h % len(w) + 1 :] if modulus and h % modulus == 0 else w] += 1
    return out


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_variants(n: dict, factor=2):
    others = {w: [x for x in n if near(w, x)] for w in n}
    best = {w: min(xs, key=lambda x: (-n[x], x)) for w, xs in others.items() if xs}
    form = {w: best.get(w) if w in best and n[best[w]] >= factor * n[w] else None for w in n}
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(others[w]), n[form[w]] if form[w] else None))
    return sorted(out)


@given(st.dictionaries(st.text("abé", min_size=1, max_size=5), st.integers(1, 40), max_size=40))
@settings(max_examples=12, deadline=None)
def test_variants_against_all_pairs(spark, n):
    d = spark.createDataFrame(list(n.items()), "word string, n long")
    assert sorted(tuple(r) for r in spelling.variants(d).collect()) == plain_variants(n)


def test_variants_of_texts(spark, monkeypatch):
    rng = random.Random(2)
    base = ["".join(rng.choices("abcdé", k=rng.choice((4, 5, 6)))) for _ in range(40)]
    texts = [" ".join(rng.choice((str.upper, str.title, str))(rng.choice(base[: rng.choice((3, 40))])) for _ in range(60)) for _ in range(80)]
    rows = [*enumerate(texts), (None, texts[0]), (3, texts[3]), (3, texts[3]), (4, None), (5, ""), (6, "×÷ÿ-Ünder_score x" + "y" * 3000)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit("clash")).repartition(5)
    for held in (spelling.HELD, 10):
        assert {r["word"]: r["n"] for r in spelling.counts(d, modulus=7, held=held).collect()} == plain_counts(rows, 7)
    want = plain_variants({w: c for w, c in plain_counts(rows).items() if len(w) >= 5 and c >= 3})
    assert any(r[1] for r in want) and sorted(tuple(r) for r in spelling.variants(spelling.vocabulary(d)).collect()) == want
    assert spelling.variants(spelling.vocabulary(d.limit(0))).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(spelling.vocabulary(d), factor=1)


def test_roots_of_long_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}" if i < 37 else None) for i in range(38)]
    out = dict(tuple(r) for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect())
    assert out == {f"w{i}": "w37" for i in range(37)}


def test_no_row_holds_a_pair_of_a_wild_group(spark):
    plan = spelling.nearest(spark.createDataFrame([("a", 1)], "word string, n long"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def plain_codes(rows, scale=4096, positions=8, entries=16, rounds=6):
    kept = [(k, v, label) for k, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [[math.floor(scale * x) for x in v] for _, v, _ in kept]
    if not kept:
        return [], []
    width = len(whole[0]) // positions
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, whole[i]))[:entries]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(whole[i], p) for i in order] for p in range(positions)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [[min((away(cut(v, p), e), k) for k, e in enumerate(books[p])) for p in range(positions)] for v in whole]
    for _ in range(rounds):
        found = assign()
        for p in range(positions):
            for e in range(len(books[p])):
                own = [cut(v, p) for v, f in zip(whole, found, strict=True) if f[p][1] == e]
                if own:
                    books[p][e] = [math.floor(sum(c) / len(own)) for c in zip(*own, strict=True)]
    found = assign()
    by_label = Counter()
    for (_, _, label), f in zip(kept, found, strict=True):
        by_label[label] += sum(d for d, _ in f)
    return [(k, [c for _, c in f], sum(d for d, _ in f), by_label[label]) for (k, _, label), f in zip(kept, found, strict=True)], books


def code_rows(n=150, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(size=16).astype("float32")], [None, 1, 2][i % 3]) for i in rng.permutation(n)]
    common = rows[0][1]
    rows += [(1000 + i, common, 1) for i in range(n // 2)] + [(3, rows[1][1], 2), (3, rows[1][1], 2), (None, rows[2][1], None), (2000, [0.0] * 16, 5)]
    return rows + [(2001, None, 1), (2002, [float("nan"), *[0.0] * 15], 1), (2003, [None, *[0.0] * 15], 1), (2004, [float("inf"), *[0.0] * 15], None), (2005, [-1e-9] * 16, 7)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_codes_are_lloyds(spark, kind):
    rows = code_rows()
    d = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").withColumn("part", F.lit(1)).withColumn("row", F.lit("clash")).repartition(5)
    out, books = compression.compress(d)
    want, plain = plain_codes(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(((r[0], list(r[1]), r[2], r[3]) for r in out.collect()), key=key) == sorted(want, key=key)
    assert [b.tolist() for b in books] == plain


def test_codes_of_few_and_of_bad_vectors(spark):
    schema = "vec_id long, embedding array<double>, label int"
    few = code_rows(4)[:3]
    assert sorted(tuple(r)[0] for r in compression.compress(spark.createDataFrame(few, schema))[0].collect()) == sorted(r[0] for r in few)
    for rows in ([], [(1, None, 1)]):
        assert compression.compress(spark.createDataFrame(rows, schema))[0].count() == 0
    for rows in ([(1, [1.0] * 12, 1)], [(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)]):
        with pytest.raises(ValueError):
            compression.compress(spark.createDataFrame(rows, schema))
    with pytest.raises(Exception, match="too large"):
        compression.compress(spark.createDataFrame([(1, [1e9] * 8, 1)], schema))[0].collect()


def test_equal_parts_are_one_row(spark):
    """A round reads each distinct part once, with its weight."""
    rows = [(i, [float(i % 2)] * 16, 0) for i in range(400)]
    d = compression.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), id_col="vec_id", vector_col="embedding", label_col="label", scale=4096)
    parts = compression.parts_of(d, 2, 8).groupBy("position", "part").count()
    assert parts.count() == 16 and parts.agg(F.sum("count")).first()[0] == 3200
