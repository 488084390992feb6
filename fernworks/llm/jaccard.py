"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact verification.

Texts are lower-cased (A-Z), split at ASCII white space and seen as sets of five-word shingles (a text of one to four
words is one shingle). Two texts are linked if the Jaccard similarity of their sets is at least 0.8.

1. Exact copies are one class of text (by digest), so a text is looked at once however often it is repeated.
2. Bands of MinHash values bring together texts that may be similar. In a bucket, texts are compared MinHash value by
   value, in steps of eight; a pair is dropped once the posterior probability that it reaches the threshold (uniform
   prior, binomial likelihood) is below a tolerance. What is left in a bucket is reduced to a spanning forest.
3. The components of the forests are groups of texts among which all links are. In a group *every* pair is compared in
   the same way, and each pair that is left is verified on the whole shingle sets. Pairs never leave the task: it
   returns the number of links of each text, and a spanning forest of the verified links.
4. The components of the verified links are the classes.

A large bucket or group is cut into chunks by hash, and pairs of chunks are compared in different tasks; a chunk's rows
go to each. A chunk of a group is bounded by rows and by bytes of text. That work grows with the square of a group of
*different* texts that all may be linked, as the number of links does; copies have no part in it. In a long chain of
texts, where few are links, the square is one of short comparisons of MinHash values only.

Chances of a miss at similarity 0.8 exactly: no common band (1 - 0.8**3)**16 = 1e-5, and pruned wrongly at most the
tolerance in each of eight steps, in both of two passes. A text that a band has missed is still compared with all
others if any similar text has brought it into the group.

Defined cases. Null text, or one without words: no shingles, no links, a class of its own. Repeated rows: copies of
each other. Null ids: allowed; the class id is the smallest id that is not null. Ties: none, 0.8 itself links. Empty
table: no rows. Other columns are left out by `jaccard_classes` and kept by `one_of_each`. A text of any length is
taken whole; long near copies are compared few at a time.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, passing, prepare, screened, table_bytes, text_of, written
from .components import components
from .words import LOWER

WORDS, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
VALUES, STEP, BANDS, ROWS = 64, 8, 16, 3
#: Texts in a chunk of a bucket, texts in a chunk of a group, and bytes of text in one.
BUCKET_CHUNK, GROUP_CHUNK, GROUP_BYTES = 4096, 512, 16 << 20

_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=1)
def _families() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(1, 2**63, VALUES, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**63, VALUES, dtype=np.uint64)


def shingles(text: bytes) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    from xxhash import xxh3_64_intdigest

    words = text.translate(LOWER).split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, n)
    k = min(WORDS, n)
    h = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        h = h * _STEP + w[j : n - k + 1 + j]
    return np.unique(_mix(h))


def minhash(sh: np.ndarray) -> np.ndarray:
    a, b = _families()
    least = np.full(VALUES, 0xFFFFFFFF, np.uint64)
    for k in range(0, len(sh), 4096):
        least = np.minimum(least, ((sh[k : k + 4096, None] * a + b) >> np.uint64(32)).min(0))
    return least


@lru_cache(maxsize=8)
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For 8, 16, ... compared values: the fewest matches with P(similarity >= threshold | matches) >= tolerance.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), and its upper tail is P(Bin(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        tail = 0.0
        for m in range(n + 2):
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
        out.append(min(m, n))
    return tuple(out)


def survivors(sig: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float, tolerance: float) -> np.ndarray:
    """Which of the pairs (i, j) are left after all their values have been compared, step by step."""
    alive = np.arange(len(i))
    matches = np.zeros(len(i), np.int16)
    for k, least in enumerate(least_matches(threshold, tolerance)):
        part = slice(k * STEP, (k + 1) * STEP)
        matches = matches + (sig[i[alive], part] == sig[j[alive], part]).sum(1, dtype=np.int16)
        ok = matches >= least
        alive, matches = alive[ok], matches[ok]
    return alive


class Forest:
    """Union-find over 0..n-1 that keeps the edges which joined something."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def join(self, i: int, j: int) -> None:
        a, b = self.label[i], self.label[j]
        if a != b:
            self.label[self.label == max(a, b)] = min(a, b)
            self.edges.append((i, j))

    def star(self, hub: int, others: np.ndarray) -> None:
        """Join all of others to hub at once."""
        labels, first = np.unique(self.label[others], return_index=True)
        new = labels != self.label[hub]
        self.edges += [(hub, int(x)) for x in others[first[new]]]
        joined = np.append(labels[new], self.label[hub])
        self.label[np.isin(self.label, joined)] = joined.min()


def tiles(n: int, side: np.ndarray | None, tile: int = 1 << 18):
    """All pairs i < j (with side: of different sides only), as index arrays of bounded length."""
    step = max(1, tile // max(1, n))
    for k in range(0, n, step):
        i, j = np.meshgrid(np.arange(k, min(n, k + step)), np.arange(k, n), indexing="ij")
        ok = i < j
        if side is not None:
            ok &= side[i] != side[j]
        yield i[ok], j[ok]


def _groups(batches, keys: list[str]):
    """Tables of whole groups (equal keys follow one another), with the start of each group."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ks = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        cut = len(ks)
        while cut and ks[cut - 1] == ks[-1]:
            cut -= 1
        if cut == 0 and (last is None or last == ks[-1]):
            rest.append(batch)
            last = ks[-1]
            continue
        if cut == 0:
            yield pa.Table.from_batches(rest)
            rest = [batch]
        else:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = [batch.slice(cut)]
        last = ks[-1]
    if rest:
        yield pa.Table.from_batches(rest)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    ks = list(zip(*(table.column(k).to_pylist() for k in keys), strict=True))
    return np.array([x for x in range(len(ks)) if not x or ks[x] != ks[x - 1]] + [len(ks)])


def _fixed(column: pa.ChunkedArray, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k0, tkey, n, bytes, sig, bands) for each row: id, digest of the text, number of shingles, length, values, band keys."""
    text = text_of(docs, text_col)
    source = docs.select(F.col(id_col).alias("k0"), F.unhex(F.md5(text.cast("binary"))).alias("tkey"), text.alias("text"))
    band = np.arange(BANDS, dtype=np.uint64)

    def run(batches):
        for batch in batches:
            n, size, sigs, bands = [], [], [], []
            for t in table_bytes(batch.column("text")):
                size.append(len(t))
                sh = shingles(t)
                v = minhash(sh)
                n.append(len(sh))
                sigs.append((v & np.uint64(0xFFFF)).astype(np.uint16).tobytes())
                h = band + _STEP
                for r in range(ROWS):
                    h = _mix(h * _STEP + v[r * BANDS : (r + 1) * BANDS])
                bands.append(h.astype(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * BANDS, pa.int32()), pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("k0"), batch.column("tkey"), pa.array(n, pa.int32()), pa.array(size, pa.int64()), pa.array(sigs, pa.binary()), lists], names=["k0", "tkey", "n", "bytes", "sig", "bands"])

    kind = T.StructType([T.StructField("k0", docs.schema[id_col].dataType), *T._parse_datatype_string("tkey binary, n int, bytes long, sig binary, bands array<long>").fields])
    return source.mapInArrow(run, kind)


def _chunked(rows: DataFrame, key: str, chunks: DataFrame) -> DataFrame:
    """rows with side, lo, hi: each row in every pair of chunks of its key that has its own chunk. chunks: (key, chunks)."""
    large = chunks.filter("chunks > 1").select(key, F.col("chunks").cast("int").alias("chunks"))
    large = written(large, "large")  # its size is then known: where it is small, as ever but in very large groups, rows stay where they are
    out = rows.join(large, key, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    out = out.withColumn("side", F.pmod(F.xxhash64("tkey"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    return out.withColumn("other", other).withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other")).drop("other", "chunks")


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys)


def _bucket_edges(classes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(a, b): spanning forests of what is left of each bucket."""
    rows = classes.select("tkey", F.explode("bands").alias("band"), "sig")
    chunks = rows.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / BUCKET_CHUNK).alias("chunks"))
    keys = ["band", "lo", "hi"]

    def run(batches):
        for table in _groups(batches, keys):
            start = _starts(table, keys)
            count = np.diff(start)
            if not (count > 1).any():
                continue
            sig = _fixed(table.column("sig"), np.uint16, VALUES)
            tkey = table.column("tkey").to_pylist()
            hub = np.repeat(start[:-1], count)
            other = np.flatnonzero(hub != np.arange(len(hub)))
            left = np.zeros(len(hub), bool)
            left[other[survivors(sig, hub[other], other, threshold, tolerance)]] = True
            edges = [(int(hub[x]), int(x)) for x in np.flatnonzero(left)]
            kept = np.add.reduceat(left.astype(int), start[:-1])
            for g in np.flatnonzero((count > 2) & (kept < count - 1)):  # not all are like the first: compare the others
                s, e = start[g], start[g + 1]
                forest = Forest(e - s)
                forest.star(0, np.flatnonzero(left[s:e]))
                forest.edges.clear()
                for i, j in tiles(e - s, None):
                    apart = forest.label[i] != forest.label[j]
                    i, j = i[apart], j[apart]
                    for x in survivors(sig[s:e], i, j, threshold, tolerance):
                        forest.join(int(i[x]), int(j[x]))
                edges += [(s + i, s + j) for i, j in forest.edges]
            yield pa.RecordBatch.from_arrays([pa.array([tkey[i] for i, _ in edges], pa.binary()), pa.array([tkey[j] for _, j in edges], pa.binary())], names=["a", "b"])

    dealt = _dealt(_chunked(rows, "band", chunks).select(*keys, "tkey", "sig"), *keys)
    return dealt.mapInArrow(run, "a binary, b binary").filter("a != b").distinct()


class Sets:
    """Sets of shingles, renumbered once so that a set's members can be marked in an array."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        ids, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(ids), bool)

    def verified(self, i: np.ndarray, j: np.ndarray, threshold: float, at_once: int = 1 << 20) -> np.ndarray:
        """Which of the pairs (i, j), sorted by i, have a Jaccard similarity of at least threshold: exactly."""
        ok = np.zeros(len(i), bool)
        cuts = np.append(np.flatnonzero(np.diff(i, prepend=-1)), len(i))
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            one = self.size[i[a]]
            own = self.flat[self.begin[i[a]] : self.begin[i[a]] + one]
            self.mark[own] = True
            c = a
            while c < z:  # as many others as have about at_once shingles together
                ends = np.cumsum(self.size[j[c:z]])
                e = c + max(1, int(np.searchsorted(ends, at_once, side="right")))
                n, ends = self.size[j[c:e]], ends[: e - c]
                at = np.arange(ends[-1]) + np.repeat(self.begin[j[c:e]] - (ends - n), n)
                common = np.add.reduceat(self.mark[self.flat[at]].astype(np.int64), ends - n)
                ok[c:e] = common >= threshold * (one + n - common) - 1e-9
                c = e
            self.mark[own] = False
        return ok


def _group_links(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(a, b, links, texts): b null: links of a in one pair of chunks, in documents and in texts; else a verified link."""
    keys = ["root", "lo", "hi"]

    def run(batches):
        for table in _groups(batches, keys):
            start = _starts(table, keys)
            every = _fixed(table.column("sig"), np.uint16, VALUES)
            sides, los, his = (table.column(c).to_numpy() for c in ("side", "lo", "hi"))
            tkeys, copies = table.column("tkey").to_pylist(), table.column("copies").to_numpy()
            texts = table.column("text")
            out: list[tuple] = []
            for s, e in zip(start[:-1], start[1:], strict=True):
                first: dict[bytes, int] = {}
                for x in range(s, e):  # rows repeated with their id
                    first.setdefault(tkeys[x], x)
                rows = np.array(list(first.values()))
                if len(rows) < 2:
                    continue
                sig = every[rows]
                sets = None
                side = None if los[s] == his[s] else sides[rows]
                links, near = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
                forest = Forest(len(rows))
                for i, j in tiles(len(rows), side):
                    alive = survivors(sig, i, j, threshold, tolerance)
                    i, j = i[alive], j[alive]
                    if not len(i):
                        continue
                    if sets is None:
                        sets = Sets([shingles(texts[int(x)].as_buffer().to_pybytes()) for x in rows])
                    ok = sets.verified(i, j, threshold)
                    i, j = i[ok], j[ok]
                    np.add.at(links, i, copies[rows[j]])
                    np.add.at(links, j, copies[rows[i]])
                    np.add.at(near, i, 1)
                    np.add.at(near, j, 1)
                    for h in np.unique(i):
                        forest.star(int(h), j[i == h])
                out += [(tkeys[r], None, int(a), int(b)) for r, a, b in zip(rows, links, near, strict=True) if b]
                out += [(tkeys[rows[i]], tkeys[rows[j]], 0, 0) for i, j in forest.edges]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.binary(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=["a", "b", "links", "texts"])
        give_back()

    chunks = members.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / GROUP_CHUNK), F.ceil(F.sum("bytes") / GROUP_BYTES)).alias("chunks"))
    return lambda with_text: _dealt(_chunked(with_text, "root", chunks).select(*keys, "side", "tkey", "copies", "sig", "text"), *keys).mapInArrow(run, "a binary, b binary, links long, texts long")


def _classified(docs: DataFrame, id_col: str, text_col: str, threshold: float, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """Rows (k0, tkey, n), and texts (tkey, n, copies, first, class_id, links)."""
    prepare(docs.sparkSession)
    rows = written(_sketches(docs, id_col, text_col), "sketches")
    classes = rows.filter("n > 0").groupBy("tkey").agg(F.count(F.lit(1)).alias("copies"), F.min("k0").alias("first"), F.first("bytes").alias("bytes"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    classes = written(classes, "classes")
    spark = docs.sparkSession
    with passing(spark) as keep:
        near = components(_bucket_edges(classes, threshold, tolerance))
        members = keep(written(near.withColumnRenamed("node", "tkey").join(classes.drop("bands"), "tkey"), "members"))
    text = text_of(docs, text_col)
    source = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("key"), text.alias("text"))
    member = members.filter("copies > 0")  # all are; a filter lets Spark screen the texts by members before it moves them
    with_text = source.join(member, (source["key"] == member["tkey"]) & source["id"].eqNullSafe(member["first"])).select("root", "tkey", "copies", "sig", "text")
    with screened(spark), passing(spark) as keep:
        links = keep(written(_group_links(members, threshold, tolerance)(with_text), "links"))
    with passing(spark) as keep:
        final = keep(written(components(links.filter("b is not null").select("a", "b")), "roots"))
    counts = links.filter("b is null").groupBy("a").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    texts = classes.drop("sig", "bands", "bytes").join(final.withColumnRenamed("node", "tkey"), "tkey", "left").withColumn("root", F.coalesce("root", "tkey"))
    texts = texts.join(counts.withColumnRenamed("a", "tkey"), "tkey", "left").fillna(0, ["links", "texts"])
    least = texts.groupBy("root").agg(F.min("first").alias("class_id"))
    return rows.select("k0", "tkey", "n"), texts.join(least, "root")


def jaccard_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """A row for each document: id, class_id (smallest id of its class), n_links (other documents that it is linked
    with, copies among them), n_linked_texts (different texts among these) and n_copies (documents with its very text)."""
    rows, texts = _classified(docs, id_col, text_col, threshold, tolerance)
    out = rows.join(texts.drop("first", "root"), "tkey", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("k0").alias(id_col), F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("k0")).alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, zero).alias("n_links"), F.coalesce("texts", zero).alias("n_linked_texts"), F.coalesce("copies", zero + 1).alias("n_copies"),
    )


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """docs with one row of each class, that of the smallest id (null: last); rows without words all stay."""
    _, texts = _classified(docs, id_col, text_col, threshold, tolerance)
    order = F.struct(F.col("first").isNull().alias("no_id"), "first", "tkey")
    keep = texts.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.first").alias("_id"), F.col("k.tkey").alias("_key"))
    text = text_of(docs, text_col)
    wordless = ~F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("key"), wordless.alias("wordless"))
    kept = keyed.join(keep, (F.col("key") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_id"))).dropDuplicates(["key", "id"])
    return kept.select("row.*").unionByName(keyed.filter("wordless").select("row.*"))


def op1_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """The class and the links of every document."""
    return jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The same by comparing all pairs that share a shingle; for small tables.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, text, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, text, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
e AS (SELECT doc_id, text, len(s) AS n, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.text = b.text) AS copy, any_value(a.text) AS ta, any_value(b.text) AS tb FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
l AS MATERIALIZED (SELECT a, b, copy, tb AS t FROM p UNION ALL SELECT b, a, copy, ta FROM p),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(root) AS class_id FROM r GROUP BY id),
k AS (SELECT a, count(*) AS n_links, count(DISTINCT t) FILTER (NOT copy) AS n_linked_texts, count(*) FILTER (copy) AS copies FROM l GROUP BY a)
SELECT id AS doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n_linked_texts, 0) AS n_linked_texts, 1 + coalesce(copies, 0) AS n_copies FROM c LEFT JOIN k ON a = id
"""
