"""Toxicity: a linear-chain conditional random field tags toxic words; its marginals give scores and offsets.

Tokens are the runs of letters of a text. A two-state chain (clean, toxic) runs over each whole text; a token's
potential is the sum of hashed features of its lower-case form (the word, its beginnings and its end). Forward and
backward passes give each token's probability of being toxic; a document's score is a logistic function of the three
largest, and tokens of at least 0.5 are its offending spans.

Labels are given for documents, so tokens are labelled first. Of all forms (words and beginnings of words) those are
taken that stand in toxic documents more often than chance allows for any of so many forms; then, for toxic documents
that hold none of these, forms that never stand in clean ones, the one that explains the most documents first, until
nothing explains enough. A form counts once for each different word before it, so a passage that documents share does
not count as evidence. Tokens of a taken form are toxic in toxic documents; all others are clean.

The classifier is fitted on a bounded sample of labelled rows: at most SAMPLE[1] toxic and SAMPLE[0] clean documents
with the smallest hashes of their ids, and at most SAMPLE_BYTES of text, the longest texts being left out first. All
documents are scored.

Defined cases. Null or empty text, or one without letters: score 0, no spans. Null id: remainder of the empty text;
scored as any other, never learnt from. Ids that are repeated: each row is scored; a label given twice is toxic if one
is. No toxic or no clean label: every score is 0, as nothing can be learnt. Empty table: no rows. Extra columns are
carried where `keep` names them, under any name. Texts of any length are scored whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import give_back, packs, prepare, remainder
from .words import pack_source

TOKEN = re.compile(r"[^\W\d_]+")
SAMPLE, SAMPLE_BYTES = (3000, 1500), 48 << 20
FEATURES, PER_TOKEN = 1 << 18, 9
CACHE, PACK = 1 << 19, 8 << 20
THRESHOLD, SPAN = 0.3, 0.5


@dataclass
class Model:
    weights: np.ndarray  # of features: log-odds of toxic
    step: np.ndarray  # 2 x 2: log potentials from the state before to this one
    final: np.ndarray  # bias, and weights of the three largest log-odds of a document


def features(token: str) -> list[int]:
    w = token.lower()
    names = ["*", "w" + w, *(f"b{w[:k]}" if len(w) >= k else "-" for k in range(3, 9)), f"e{w[-3:]}"]
    return [zlib.crc32(x.encode()) % FEATURES for x in names]


class Potentials(dict):
    """The potential of each token seen, by its form in the text; emptied when it has grown too large."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights.tolist()

    def __missing__(self, token: str) -> float:
        if len(self) >= CACHE:
            self.clear()
        w = self.weights
        v = self[token] = max(-30.0, min(30.0, sum([w[i] for i in features(token)])))
        return v


def chains(lengths: np.ndarray, potential: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Odds of toxic from what stands before (with the token itself), and from what stands after, for tokens of chains
    that lie one after another. All chains advance together, the long ones on their own at the end."""
    t = np.exp(step)
    e = np.exp(potential)
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begin, n = begin[order], lengths[order]
    active = np.searchsorted(-n, -np.arange(n[0] if len(n) else 0), side="left")  # chains longer than k
    before, after = np.ones(len(potential)), np.ones(len(potential))
    if not len(potential):
        return before, after
    at = begin[: active[0]]
    before[at] = e[at]
    alone = int(n[1]) if len(n) > 1 else 1  # from here on only the longest chain goes on: plain numbers are faster
    alone = max(alone, 1)
    for k in range(1, min(alone, len(active))):
        at = begin[: active[k]] + k
        r = before[at - 1]
        before[at] = e[at] * (t[0, 1] + r * t[1, 1]) / (t[0, 0] + r * t[1, 0])
    if len(active) > alone:
        tail = e[begin[0] + alone : begin[0] + n[0]].tolist()
        (a, b), (c, d) = t.tolist()
        r, found = float(before[begin[0] + alone - 1]), []
        for x in tail:
            r = x * (b + r * d) / (a + r * c)
            found.append(r)
        before[begin[0] + alone : begin[0] + n[0]] = found
        r, found = 1.0, []
        for x in reversed(tail):
            r = x * r
            r = (c + d * r) / (a + b * r)
            found.append(r)
        after[begin[0] + alone - 1 : begin[0] + n[0] - 1] = found[::-1]
    for k in range(min(alone, len(active)) - 1, 0, -1):
        at = begin[: active[k]] + k
        r = e[at] * after[at]
        after[at - 1] = (t[1, 0] + t[1, 1] * r) / (t[0, 0] + t[0, 1] * r)
    return before, after


def marginals(lengths: np.ndarray, potential: np.ndarray, step: np.ndarray) -> np.ndarray:
    before, after = chains(lengths, potential, step)
    x = before * after
    return x / (1 + x)


def largest(lengths: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The three largest log-odds of each chain (at least -12, which also stands for none)."""
    ends = np.cumsum(lengths)
    out = np.full((len(lengths), 3), -12.0)
    odds = np.clip(np.log(np.maximum(p, 1e-12) / np.maximum(1 - p, 1e-12)), -12, 12)
    for i, (n, e) in enumerate(zip(lengths.tolist(), ends.tolist(), strict=True)):
        own = odds[e - n : e]
        own = np.sort(own if n <= 3 else np.partition(own, n - 3)[n - 3 :])[::-1]
        out[i, : len(own)] = own
    return out


def document_scores(top: np.ndarray, final: np.ndarray) -> np.ndarray:
    s = 1 / (1 + np.exp(-(final[0] + top @ final[1:])))
    return np.where(top[:, 0] <= -12, 0.0, s)


def forms(token: str) -> list[str]:
    return [token + "$", *(token[:k] for k in range(3, min(len(token) - 1, 9) + 1))]


def toxic_forms(texts: list[np.ndarray], words: list[str], toxic: list[bool], least: int = 3, sure: float = 3.0) -> list[str]:
    """The forms that mark toxic documents: first those beyond chance, then those that explain what is left.

    texts: numbers of words. Beyond chance: the log-likelihood ratio against the share of toxic documents is above the
    log of the number of forms and `sure`, and most documents with the form are toxic.
    """
    seen = np.zeros(1 << 22, np.int32)  # documents by hash of form: what is below least here is below it
    place = lambda f: zlib.crc32(f.encode()) & (len(seen) - 1)
    for t, bad in zip(texts, toxic, strict=True):
        if bad:
            seen[np.unique([place(f) for w in np.unique(t).tolist() for f in forms(words[w])]).astype(np.int64)] += 1
    tested = int(np.count_nonzero(seen))
    of_word: dict[int, tuple[str, ...]] = {}

    def able_of(w: int) -> tuple[str, ...]:
        if w not in of_word:
            of_word[w] = tuple(f for f in forms(words[w]) if seen[place(f)] >= least)
        return of_word[w]

    held: tuple[Counter[str], Counter[str]] = Counter(), Counter()  # clean, toxic documents with a form
    for t, bad in zip(texts, toxic, strict=True):
        held[bad].update({f for w in np.unique(t).tolist() for f in able_of(w)})
    clean, marked = held
    possible = {f for f, n in marked.items() if n >= max(least, 2 * clean[f])}
    of_word = {w: tuple(f for f in fs if f in possible) for w, fs in of_word.items()}
    where: dict[str, set[int]] = defaultdict(set)
    contexts: dict[str, set[int]] = defaultdict(set)
    for i, (t, bad) in enumerate(zip(texts, toxic, strict=True)):
        before = -1
        for w in t.tolist() if bad else ():
            for f in of_word[w]:
                where[f].add(i)
                if len(contexts[f]) < 4096:
                    contexts[f].add(before)
            before = w
    base = min(max(sum(toxic) / len(toxic), 1e-6), 1 - 1e-6)
    limit = np.log(tested + 1) + sure
    out, left = [], {i for i, bad in enumerate(toxic) if bad}
    for f in sorted(where):
        s, c = min(len(where[f]), len(contexts[f])), clean[f]
        if s < least or s < 2 * c:
            continue
        share = s / (s + c)
        ratio = s * np.log(share / base) + (c * np.log((1 - share) / (1 - base)) if c else 0.0)
        if ratio > limit:
            out.append(f)
            left -= where[f]
    able = {f: s & left for f, s in where.items() if min(len(s), len(contexts[f])) >= least and not clean[f] and len(s & left) >= least}
    while able:
        rank = lambda f: (len(able[f]), len(f.rstrip("$")), f)
        best = max(able, key=rank)
        out.append(best)
        gone = able.pop(best)
        able = {f: r for f, s in able.items() if len(r := s - gone) >= least}
    return out


def _adam(params: list[np.ndarray], gradient, rounds: int, rate: float) -> None:
    m, v = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
    for t in range(1, rounds + 1):
        for k, g in enumerate(gradient()):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            params[k] += rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)


def fit(texts: list[str], toxic: list[bool], share: float | None = None, rounds: int = 60, rate: float = 0.3, piece: int = 128) -> Model:
    """Trained on whole texts, taken in chains of at most `piece` tokens. share: of toxic documents among all labelled."""
    model = Model(np.zeros(FEATURES), np.zeros((2, 2)), np.array([-np.inf, 0.0, 0.0, 0.0]))
    model.weights[features("")[0]] = -30.0  # until something is learnt, no token is toxic
    if not any(toxic) or all(toxic):
        return model
    number: dict[str, int] = {}
    docs = [np.array([number.setdefault(w.lower(), len(number)) for w in TOKEN.findall(t or "")], np.int32) for t in texts]
    words = list(number)
    taken = toxic_forms(docs, words, toxic)
    whole = {f[:-1] for f in taken if f.endswith("$")}
    begins = {f for f in taken if not f.endswith("$")}
    flat = np.concatenate(docs)
    bad = np.array([w in whole or any(w[:k] in begins for k in range(3, min(len(w) - 1, 9) + 1)) for w in words], bool)
    each = np.array([len(t) for t in docs], np.int64)
    doc_bad = np.array(toxic, bool)
    y = (bad[flat] & np.repeat(doc_bad, each)).astype(np.int8)
    if not y.any():
        return model
    model.weights[:] = 0
    which = np.array([features(w) for w in words], np.int32).reshape(-1, PER_TOKEN)
    lengths = np.array([min(piece, n - k) for n in each.tolist() for k in range(0, n, piece)], np.int64)
    ends = np.cumsum(lengths)
    cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, len(flat), 1 << 18)), len(lengths)))
    blocks = [(lengths[i:j], slice(int(ends[i] - lengths[i]), int(ends[j - 1]))) for i, j in zip(cuts, cuts[1:], strict=False)]  # of whole chains

    def inside(n):
        begins = np.zeros(int(n.sum()), bool)
        begins[np.cumsum(n) - n] = True
        return np.flatnonzero(~begins)

    seen = np.zeros(4)
    for n, part in blocks:
        i, tag = inside(n), y[part]
        seen += np.bincount((2 * tag[i - 1] + tag[i]).astype(int), minlength=4)
    seen = seen.reshape(2, 2)
    scale = 1.0 / max(1.0, float(y.sum()))

    def gradient():
        of_words = np.clip(model.weights[which].sum(1), -30, 30)
        s = np.exp(model.step)
        by_word, expected = np.zeros(len(words)), np.zeros((2, 2))
        for n, part in blocks:
            potential, i = of_words[flat[part]], inside(n)
            before, after = chains(n, potential, model.step)
            p = before * after / (1 + before * after)
            r, q = before[i - 1], after[i] * np.exp(potential[i])
            total = s[0, 0] + s[0, 1] * q + r * s[1, 0] + r * s[1, 1] * q
            expected += [[(s[0, 0] / total).sum(), (s[0, 1] * q / total).sum()], [(r * s[1, 0] / total).sum(), (r * s[1, 1] * q / total).sum()]]
            by_word += np.bincount(flat[part], y[part] - p, minlength=len(words))
        g = np.bincount(which.ravel(), np.repeat(by_word, PER_TOKEN), minlength=FEATURES) * scale - 1e-4 * model.weights
        return g, (seen - expected) * scale - 1e-2 * model.step

    _adam([model.weights, model.step], gradient, rounds, rate)
    top = largest(each, marginals(each, np.clip(model.weights[which].sum(1), -30, 30)[flat], model.step))
    share = doc_bad.mean() if share is None else share
    weight = np.where(doc_bad, share / doc_bad.mean(), (1 - share) / (1 - doc_bad.mean())) / len(top)
    model.final[:] = [0.0, 1.0, 0.0, 0.0]

    def of_documents():
        d = weight * (doc_bad - 1 / (1 + np.exp(-(model.final[0] + top @ model.final[1:]))))
        return (np.concatenate([[d.sum()], d @ top]) - 1e-3 * np.array([0, *model.final[1:]]),)

    _adam([model.final], of_documents, 600, 0.02)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", folds: int = 4, held_out: int = 2) -> tuple[list[str], list[bool], float]:
    """The bounded sample: texts, whether they are toxic, and the share of toxic ones among all labels to learn from."""
    able = labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & (remainder(F.col(id_col), folds) != held_out))
    able = able.groupBy(id_col).agg(F.max("toxic").alias("toxic")).withColumn("order", F.xxhash64(id_col))
    share = able.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    few = [able.filter(F.col("toxic") == k).orderBy("order", id_col).limit(SAMPLE[k]) for k in (0, 1)]
    few = few[0].unionByName(few[1])  # at most sum(SAMPLE) rows: a proven bound
    texts = docs.select(F.col(id_col), F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(few), id_col).groupBy(id_col).agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"), F.min("order").alias("order"))
    bytes_ = F.octet_length("text")
    size = F.sum(bytes_.cast("long")).over(Window.orderBy(bytes_, "order", id_col))  # over the sample alone; only the longest are left out
    rows = texts.withColumn("size", size).filter(F.col("size") <= SAMPLE_BYTES).orderBy("order", id_col).select("text", "toxic").toArrow()
    return rows.column("text").to_pylist(), [x == 1 for x in rows.column("toxic").to_pylist()], share


def tag(docs: DataFrame, model: Model, *, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """keep, score (double), spans (array of begin, end, score; offsets in characters of the text) for each document."""
    prepare(docs.sparkSession)
    keep = list(keep)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.step, model.final))

    def run(batches):
        weights, step, final = shared.value
        known = Potentials(weights)
        for _, table in packs(batches, "text", PACK):
            texts = table.column("text").to_pylist()
            lengths, parts = np.zeros(len(texts), np.int64), []
            for i, t in enumerate(texts):
                found = [known[w] for w in TOKEN.findall(t)]
                lengths[i] = len(found)
                parts.append(np.array(found))
            p = marginals(lengths, np.concatenate([np.zeros(0), *parts]), step)
            ends = np.cumsum(lengths)
            score, spans = document_scores(largest(lengths, p), final), []
            for i, t in enumerate(texts):
                own = p[ends[i] - lengths[i] : ends[i]]
                bad = np.flatnonzero(own >= SPAN)
                if not len(bad):
                    spans.append([])
                    continue
                where = {int(k) for k in bad}
                spans.append([{"begin": m.start(), "end": m.end(), "score": float(own[k])} for k, m in enumerate(TOKEN.finditer(t)) if k in where])
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield from pa.table([*(table.column(f"k{i}") for i in range(len(keep))), pa.array(score), pa.array(spans, kind)], names=[*(f"k{i}" for i in range(len(keep))), "score", "spans"]).to_batches()
        known.clear()
        give_back()

    kind = T.StructType([*(T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)), *T._parse_datatype_string("score double, spans array<struct<begin:int,end:int,score:double>>").fields])
    out = pack_source(docs, keep, text_col).mapInArrow(run, kind)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "score", "spans")


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """The score of every document, and where it offends."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(*training_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    out = tag(docs, model)
    spans = F.array_join(F.transform("spans", lambda s: F.concat(s["begin"].cast("string"), F.lit("-"), s["end"].cast("string"))), " ")
    return out.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), spans.alias("spans"))
