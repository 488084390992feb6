"""BPE, token counts, language model and toxicity on small fixtures, against the libraries and plain versions."""

import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fernworks.llm import bpe, lm, token_counts, toxicity, words

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))

TEXTS = [
    None, "", "   \n\t ", "Hello, World's 12", "café café ́x", "a<|endoftext|>b <|startoftext|>", "ΣΑΣ ΟΔΟΣ İstanbul ß", "x" * 5000, "word " * 3000, "\x0b\x0c\x85 \xa0tail", "tab\tnew\nline\r\nend ", "数学 и язык 👩‍👩‍👧", "a\x00b", "<|endoftext|>",
    "it's we'll  they're", "  two  spaces  ", "%%% ***",
]


def table(spark, texts=TEXTS, extra=True):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return df.withColumn("ids", F.lit("clash")).withColumn("pack", F.lit(1)).withColumn("score", F.lit(2)) if extra else df


@pytest.mark.parametrize("pack_bytes", [1 << 20, 64])
def test_bpe_is_the_librarys(spark, pack_bytes):
    t = Tokenizer.from_file(WORD)
    rows = {r["doc_id"]: r for r in bpe.encode_decode(table(spark).repartition(3), WORD, pack_bytes=pack_bytes).collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert rows[i]["ids"] == ids and rows[i]["decoded"] == t.decode(ids, skip_special_tokens=False)


def test_bpe_repeated_and_null_ids(spark):
    d = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, "c")], "doc_id long, text string")
    out = bpe.encode_decode(d, WORD)
    assert out.count() == 3 and out.filter("doc_id is null").select("decoded").distinct().count() == 1
    assert bpe.encode_decode(d.limit(0), WORD).count() == 0
    assert bpe.encode_decode(d.filter("doc_id = 1"), WORD, keep=("text",)).first()["text"] == "c"


def test_packs_are_made_once(spark):
    """Words and texts are read from one and the same exchange."""
    out = bpe.encode_decode(table(spark), WORD)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 1


def test_a_bucket_with_more_words_than_are_held(spark, monkeypatch):
    monkeypatch.setattr(bpe, "HELD_WORDS", 2)
    t = Tokenizer.from_file(WORD)
    texts = [" ".join(f"w{i * j}" for j in range(60)) for i in range(20)]
    rows = bpe.encode_decode(table(spark, texts, False).repartition(4), WORD, pack_bytes=500).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in rows) == [(i, t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)]


def test_bpe_refuses_other_tokenizers(spark):
    with pytest.raises(ValueError):
        bpe.encode_decode(table(spark), BYTE)


def test_decode_by_join(spark):
    t = Tokenizer.from_file(WORD)
    ids = t.encode("hello big world", add_special_tokens=False).ids
    d = spark.createDataFrame([(1, ids), (2, []), (3, None), (4, [10**6])], "doc_id int, ids array<int>")
    assert {r[0]: r[1] for r in bpe.decode(d, WORD).collect()} == {1: t.decode(ids), 2: "", 3: "", 4: ""}
    again = spark.createDataFrame([(1, ids[:1]), (1, ids), (None, ids), (None, ids[:2])], "doc_id int, ids array<int>")
    assert sorted((r[0] or 0, r[1]) for r in bpe.decode(again, WORD).collect()) == sorted((k or 0, t.decode(x)) for k, x in again.collect())


@settings(max_examples=60, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \t\n\x0b\x0c\r\x1c\x85\xa0 ́'sSΣİ12.,<|>"), st.characters(exclude_categories=("Cs",))), max_size=40))
def test_words_encode_alone(text):
    t = Tokenizer.from_file(WORD)
    assert t.encode(text, add_special_tokens=False).ids == [i for w in words.split(text.encode(), False) for i in t.encode(w.decode(), add_special_tokens=False).ids]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(["ab", " ", "  ", "\n", " ", "\x1c", "\x85", "'s", "1", "é", "<|endoftext|>", "\t"]), max_size=30).map("".join))
def test_cuts_are_safe(text):
    t = Tokenizer.from_file(BYTE)
    pieces = token_counts.cut(text, 4)
    assert "".join(pieces) == text
    assert t.encode(text, add_special_tokens=False).ids == [i for p in pieces for i in t.encode(p, add_special_tokens=False).ids]


@pytest.mark.parametrize("long", [1 << 16, 50])
def test_token_counts(spark, long):
    t = Tokenizer.from_file(BYTE)
    rows = {r["doc_id"]: r for r in token_counts.token_counts(table(spark), BYTE, batch_bytes=2000, long=long).collect()}
    for i, text in enumerate(TEXTS):
        assert (rows[i]["n_bytes"], rows[i]["n_tokens"]) == (len((text or "").encode()), len(t.encode(text or "", add_special_tokens=False)))
    assert token_counts.token_counts(table(spark).limit(0), BYTE).count() == 0


def test_token_counts_of_odd_rows(spark):
    rows = [(None, "a b"), (None, "a b"), (1, "c"), (1, None)]
    out = token_counts.token_counts(spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_bytes", F.lit("clash")), BYTE).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in out) == [(0, 3, 2), (0, 3, 2), (1, 0, 0), (1, 1, 1)]
    assert token_counts.cuts_are_safe(BYTE)


def test_lm(spark):
    texts = [None, "", "The cat sat on the mat", "the dog sat on the log", "THE cat saw the dog"] * 8 + ["unseen words here the"] * 2
    d = table(spark, texts)
    rows = {r["doc_id"]: r for r in lm.score(d).collect()}
    from collections import Counter

    tokens = lambda t: (t or "").lower().split() + [None]
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    c = Counter(w for i, t in enumerate(texts) if not out[i] for w in tokens(t))
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(texts):
        r = rows[i]
        assert r["held_out"] == out[i] and r["train_tokens"] == n and r["n_tokens"] == len(tokens(t)) and r["n_known"] == sum(c[w] > 0 for w in tokens(t))
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)))
        assert r["score"] < 0
    assert sum(r["score"] for r in rows.values()) > sum(r["base_score"] for r in rows.values())
    assert lm.score(d.limit(0)).count() == 0
    none = lm.score(spark.createDataFrame([(i, "a b") for i in range(40) if out.get(i)], "doc_id long, text string"))
    assert {(r["n_known"], r["train_tokens"]) for r in none.collect()} == {(0, 0)}


@pytest.mark.parametrize("most", [1 << 15, 20])
def test_lm_score_by_brute_force(spark, most):
    """Every token's probability written out: class, symbol in its class, word in its symbol; and all outcomes add up to 1."""
    rng = np.random.default_rng(5)
    pool = ["".join(rng.choice(list("abcd"), 3)) for _ in range(60)]
    texts = [" ".join(rng.choice(pool, 25, p=np.arange(60, 0, -1) / 1830)) for _ in range(120)] + ["never seen " + pool[0], None]
    d = table(spark, texts).repartition(3)
    tagged, w, m = lm.fitted(d, most=most)
    rows = {r["doc_id"]: r for r in lm.score(d, most=most).collect()}
    new = (w.once + 1) / (w.once + 2 * w.twice + 2) if w.once else 1.0
    known = {i: [x.decode() for x in (t or "").lower().encode().split()] for i, t in enumerate(texts)}
    from collections import Counter

    c = Counter(x for i, t in known.items() if zlib.crc32(str(i).encode()) % 7 != 2 for x in t)

    def symbol(word):
        if word is None:
            return lm.END
        if c[word] <= 1:
            return lm.RARE
        return w.number.get(word.encode(), w.tail[lm.suffix_class(word.encode(), w.classes)])

    def share(word):
        s = symbol(word)
        if s == lm.RARE:
            return new if not c[word] else (1 - new) / w.once
        return c[word] / w.mass[w.klass[s] - lm.TAILS] if s in w.tail else 1.0

    def distribution(before):
        h = sum(m.context[b].astype(float) * m.weight[k] for k, b in enumerate(before))
        klass = np.exp(m.klass[:, :-1].astype(float) @ h + m.klass[:, -1])
        symbols = np.exp(m.symbol[:, :-1].astype(float) @ h + m.symbol[:, -1])
        return (klass / klass.sum())[w.klass] * symbols / np.bincount(w.klass, symbols)[w.klass]

    for i in (0, 1, 57, 120, 121):
        tokens, want = [*known[i], None], 0.0
        for k, word in enumerate(tokens):
            before = [symbol(tokens[k - j - 1]) if k > j else lm.END for j in range(lm.CONTEXT)]
            p = distribution(before)
            assert p.sum() == pytest.approx(1)
            want += math.log10(p[symbol(word)] * share(word))
        assert rows[i]["score"] == pytest.approx(want, rel=1e-3)
    assert w.once == 0 or new + (1 - new) == pytest.approx(1)
    assert all(w.mass[k] == sum(n for x, n in c.items() if symbol(x) == w.tail[k]) for k in range(w.classes))
    often = sorted((x for x in c if c[x] > 1), key=lambda x: (-c[x], x))[:most]
    assert {x.decode() for x in w.number} == set(often) and (most > 20) == (w.mass.sum() == 0)
    assert (np.diff(w.klass) >= 0).all() and all(w.klass[w.start[k]] == k for k in range(lm.TAILS + w.classes))


def _small_words():
    frequent = sorted((f"w{k:02d}".encode() for k in range(30)), key=lambda w: w[::-1])
    return lm.Words(5, frequent, list(range(40, 70)), np.array([3, 0, 5, 9, 2]), 2000, 60, 7, 3, 25)


def test_lm_gradient_by_differences():
    """Each entry of the gradient is how fast the log-likelihood against the same noise grows, written out token by token."""
    w, rng = _small_words(), np.random.default_rng(3)
    m = lm.Model(w)
    for name in lm.Model.NAMES:
        setattr(m, name, getattr(m, name).astype(float) + rng.normal(0, 0.3, getattr(m, name).shape))
    learner = lm.Learner(m, w, 0.1, rng)
    lengths, lead = [9, 1, 14, 3, 30], 4
    symbols = rng.integers(0, len(w.klass), sum(lengths)).astype(np.int32)
    since = np.concatenate([np.arange(n) for n in lengths])
    noise = learner.noise(np.unique(w.klass[symbols[lead:]]))
    place = {c: i for i, c in enumerate(np.unique(w.klass[symbols[lead:]]))}
    log = lambda x: -np.logaddexp(0, -x)  # noqa: E731  of the logistic function

    def likelihood():
        total = 0.0
        for t in range(lead, len(symbols)):
            h = sum(m.context[symbols[t - k - 1] if since[t] > k else lm.END] * m.weight[k] for k in range(lm.CONTEXT))
            h, s = np.append(h, 1.0), symbols[t]
            c = w.klass[s]
            total += log(h @ m.klass[c] - learner.log_class[c]) + sum(log(learner.log_class[j] - h @ m.klass[j]) for j in noise[0])
            if w.start[c + 1] - w.start[c] > 1:
                total += log(h @ m.symbol[s] - learner.log_symbol[s]) + sum(log(learner.log_symbol[j] - h @ m.symbol[j]) for j in noise[1][place[c]])
        return total

    found = learner.gradients(symbols, since, lead, noise)
    for name in lm.Model.NAMES:
        index, grad = found[name]
        values = getattr(m, name)
        assert len(set(index.tolist())) == len(index)
        at = {int(i): k for k, i in enumerate(index)}
        for _ in range(12):
            i, j = int(rng.choice(index)), int(rng.integers(values.shape[1]))
            kept = values[i, j]
            values[i, j] = kept + 1e-5
            up = likelihood()
            values[i, j] = kept - 1e-5
            down = likelihood()
            values[i, j] = kept
            assert grad[at[i], j] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-5)
        others = [i for i in range(len(values)) if i not in at][:2]
        for i in others:  # a row that is not named has no gradient
            kept, values[i] = values[i].copy(), values[i] + 0.1
            moved = likelihood()
            values[i] = kept
            assert moved == likelihood()


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_lm_learns_from_every_position_once(monkeypatch, rounds):
    """The parts of the pass have each position in one batch, whatever the number of tokens."""
    monkeypatch.setattr(lm, "FIRST", 8)
    monkeypatch.setattr(lm, "LAST", 64)
    for runs in ([5], [700, 1, 90], [3000]):
        seen = []
        for r in range(rounds):
            before = number = 0
            for n in runs:
                for at, to, lead in lm.batches_of(n, before):
                    assert lead == min(at, lm.CONTEXT) and 0 < to - at <= 64
                    if number % rounds == r:
                        seen += range(before + at, before + to)
                    number += 1
                before += n
        assert sorted(seen) == list(range(sum(runs)))


def test_lm_learns_from_context(spark):
    """Words that follow one another are likelier than by their frequency, also in held-out texts."""
    rng = np.random.default_rng(2)
    texts = []
    for _ in range(300):
        side = rng.integers(2)
        texts.append(" ".join(rng.choice([f"{'xy'[side]}{k}" for k in range(20)], 30)))
    d = table(spark, texts, False)
    held = lm.score(d).filter("held_out").agg(F.sum("score"), F.sum("n_tokens")).first()
    flat = lm.score(d, rounds=0).filter("held_out").agg(F.sum("score")).first()
    assert held[0] - flat[0] > 0.15 * held[1]  # at most log10(2) a token


def test_lm_packs_are_split_once(spark):
    """A pack names its words by number: these and their counts are those of splitting at ASCII white space in Python."""
    long = ["x" * 40, "y" * 1000 + "\u00e9", "x" * 41]
    texts = ["", " ", "a", " a  B\tb\n", "\x0ba\x0c\ra\x1c\x85b\u00a0c\u2003d", "\u00c9 \u00e9 A\u0130", " ".join(long), "\n".join(long[::-1]) + " ", "b a " * 50]
    d = spark.createDataFrame([(i, i % 3 == 0, t) for i, t in enumerate(texts)], "k0 long, k1 boolean, text string").repartition(2)
    for n, pack_bytes in ((1, 1 << 20), (7, 30)):
        rows = words.numbered(d, n, lower=True, pack_bytes=pack_bytes, counted=lambda t: t.column("k1").to_pylist()).collect()
        seen = []
        for body in (r for r in rows if r["bucket"] < 0):
            table, lines = words.thaw(body["body"]), sorted((r for r in rows if r["pack"] == body["pack"] and r["bucket"] >= 0), key=lambda r: r["bucket"])
            known = [w for r in lines for w in bytes(r["words"]).split(b"\n")]
            counts = [c for r in lines for c in np.frombuffer(r["counts"], np.int64).tolist()]
            assert len(set(known)) == len(known) and len({r["bucket"] for r in lines}) == len(lines) and "text" not in table.column_names
            want = dict.fromkeys(known, 0)
            for i, k1, numbers in zip(*(table.column(c).to_pylist() for c in ("k0", "k1", "numbers")), strict=True):
                assert [known[k] for k in numbers] == words.split(texts[i].encode(), True)
                seen.append(i)
                for w in words.split(texts[i].encode(), True):
                    want[w] += k1
            assert counts == [want[w] for w in known]
        assert sorted(seen) == list(range(len(texts)))
        place = {}
        for r in rows:  # a word is in one bucket, whatever the pack
            for w in bytes(r["words"]).split(b"\n") if r["bucket"] >= 0 else ():
                assert place.setdefault(w, r["bucket"]) == r["bucket"] < n


def test_lm_edges(spark, monkeypatch):
    """Null and repeated ids, one long text, clashing columns; another cut of the input gives the same counts."""
    rows = [(None, "a b"), (None, "a b"), (3, "a b c"), (3, "b a"), (4, "w x y z " * 60000), (5, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("out", F.lit(1)).withColumn("pack", F.lit("p")).withColumn("symbols", F.lit(0)).withColumn("id", F.lit(9))
    first = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in lm.score(d.repartition(3)).collect())
    assert [x[:2] for x in first] == [("3", 3), ("3", 4), ("4", 240001), ("5", 1), ("None", 3), ("None", 3)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000000")
    try:
        again = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in lm.score(d.coalesce(1), pack_bytes=20).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [x[:4] for x in again] == [x[:4] for x in first] and [x[4] for x in again] == pytest.approx([x[4] for x in first])


def test_chains_are_exact():
    """Marginals against the sum over all tag sequences."""
    from itertools import product

    rng = np.random.default_rng(1)
    step, lengths = rng.normal(size=(2, 2)), np.array([3, 0, 5, 1])
    potential = rng.normal(size=9)
    got, at = toxicity.marginals(lengths, potential, step), 0
    for n in lengths:
        own = potential[at : at + n]
        total, bad = 0.0, np.zeros(n)
        for tags in product((0, 1), repeat=int(n)):
            w = math.exp(sum(p for p, t in zip(own, tags, strict=True) if t) + sum(step[a, b] for a, b in zip(tags, tags[1:], strict=False)))
            total += w
            bad += w * np.array(tags)
        assert np.allclose(got[at : at + n], bad / total)
        at += n


def test_a_long_chain_is_like_others():
    """A chain that goes on alone has the marginals that it has beside others."""
    rng = np.random.default_rng(7)
    step, potential = rng.normal(size=(2, 2)), rng.normal(size=900)
    long = toxicity.marginals(np.array([900]), potential, step)
    assert np.allclose(long, toxicity.marginals(np.array([900, 900]), np.tile(potential, 2), step)[:900])
    assert np.allclose(long, toxicity.marginals(np.array([3, 900, 0]), np.concatenate([potential[:3], potential]), step)[3:])


def test_toxicity_of_odd_rows(spark):
    """Repeated and null ids, and a long text whose only toxic word is its last one."""
    rng = np.random.default_rng(6)
    some = lambda: list(rng.choice([f"word{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)], 20))
    texts = [" ".join([*some(), *(["scumbag", *some()] if i % 4 == 0 else [])]) for i in range(240)]
    model = toxicity.fit(texts, [i % 4 == 0 for i in range(240)])
    rows = [(1, "you scumbag there"), (1, "you scumbag there"), (None, "fine words"), (1, "fine"), (2, "quiet words " * 100_000 + "scumbag")]
    out = toxicity.tag(spark.createDataFrame(rows, "doc_id long, text string").withColumn("k0", F.lit("clash")), model).collect()
    assert sorted((r["doc_id"] or 0, r["score"] >= 0.3, len(r["spans"])) for r in out) == [(0, False, 0), (1, False, 0), (1, True, 1), (1, True, 1), (2, True, 1)]
    assert max(r["spans"][0]["begin"] for r in out if r["doc_id"] == 2) == 1_200_000


def test_toxicity(spark):
    rng = np.random.default_rng(3)
    pool = ["w" + "".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    texts, toxic = [], []
    for i in range(240):
        ws = list(rng.choice(pool, 30))
        toxic.append(int(i % 4 == 0))
        if toxic[-1]:
            for k in rng.choice(30, 3, replace=False):
                ws[k] = str(rng.choice(["Idiot!", "scumbag", "zzfoul" + str(rng.choice(list("abcd")))]))
        texts.append(" ".join(ws))
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(1000, None), (1001, ""), (1002, "123 456"), (None, "idiot")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(toxic)] + [(0, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(*toxicity.training_rows(d, labels))
    rows = {r["doc_id"]: r for r in toxicity.tag(d, model).collect()}
    assert len(rows) == 244 and rows[1000]["score"] == rows[1001]["score"] == rows[1002]["score"] == 0.0
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 30 and np.mean([(rows[i]["score"] >= 0.3) == bool(toxic[i]) for i in held]) >= 0.95
    i = next(i for i in held if toxic[i] and rows[i]["spans"])
    assert all(texts[i][s["begin"] : s["end"]].lower()[:4] in ("idio", "scum", "zzfo") for s in rows[i]["spans"])
    flat = toxicity.fit(["a b", "c"], [False, False])
    assert {r["score"] for r in toxicity.tag(d, flat).collect()} == {0.0}
    assert toxicity.tag(d.limit(0), model).count() == 0
    assert not any(r["spans"] for r in toxicity.tag(d, toxicity.fit([], [])).collect())


def test_digests(spark):
    from fernworks.llm import registry
    from helpers import SMALL

    r = registry.op2_bpe_encode_decode(spark, SMALL).orderBy("doc_id").first()
    t = Tokenizer.from_file(WORD)
    text = spark.read.parquet(f"{SMALL}/documents.parquet").filter(F.col("doc_id") == r["doc_id"]).first()["text"]
    ids = t.encode(text, add_special_tokens=False).ids
    assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert r["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_one_long_text_leaves_the_sample(spark, monkeypatch):
    ids = [r["i"] for r in spark.range(40).select(F.col("id").alias("i")).orderBy(F.xxhash64("i")).collect()]
    able = [i for i in ids if zlib.crc32(str(i).encode()) % 4 != 2]
    long = able[0]  # the first in the sample's order
    d = spark.createDataFrame([(i, "x " * 4000 if i == long else f"text {i}") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    whole = toxicity.training_rows(d, labels)
    assert len(whole[0]) == len(able)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 4000)
    assert toxicity.training_rows(d, labels)[:2] == ([f"text {i}" for i in able[1:]], [i % 2 == 1 for i in able[1:]])


def test_document_scores_by_brute_force(spark):
    """Scores and spans of whole documents, by summing over all ways to tag their words."""
    import re
    from itertools import product

    rng = np.random.default_rng(11)
    model = toxicity.Model(rng.normal(0, 0.8, toxicity.FEATURES), rng.normal(0, 0.7, (2, 2)), np.array([-0.7, 0.9, 0.4, 0.2]))
    texts = [None, "", "12 _ !", "One", "two words", "a b c d e f g h i", "Bad, bad; BAD word's end", "é_ß 数学 x1y", "same same same", "ends. Bad"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9, "ends. Bad")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = {}
    for r in toxicity.tag(d, model).collect():
        got.setdefault(r["doc_id"], []).append((r["score"], [(s["begin"], s["end"], s["score"]) for s in r["spans"]]))
    assert len(got[9]) == 2 and got[9][0] == got[9][1]
    weights = model.weights.astype(np.float32).astype(float)
    for i, t in enumerate(texts):
        words = list(re.finditer(r"[^\W\d_]+", t or ""))
        own = [sum(weights[f] for f in toxicity.features(m[0])) for m in words]
        total, bad = 0.0, np.zeros(len(words))
        for tags in product((0, 1), repeat=len(words)):
            w = math.exp(sum(o for o, x in zip(own, tags, strict=True) if x) + sum(model.step[a, b] for a, b in zip(tags, tags[1:], strict=False)))
            total += w
            bad += w * np.array(tags)
        p = bad / total
        (score, spans), *_ = got[i]
        assert [(a, b) for a, b, _ in spans] == [m.span() for m, x in zip(words, p, strict=True) if x >= toxicity.SPAN]
        assert [x for _, _, x in spans] == pytest.approx([x for x in p if x >= toxicity.SPAN], abs=1e-5)
        if not len(words):
            assert score == 0
            continue
        odds = sorted(np.clip(np.log(p / (1 - p)), -12, 12), reverse=True)[:3]
        odds += [-12.0] * (3 - len(odds))
        assert score == pytest.approx(1 / (1 + math.exp(-(model.final[0] + float(np.dot(odds, model.final[1:]))))), abs=1e-4)
