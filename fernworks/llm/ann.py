"""Approximate nearest neighbours by additive quantisation.

A vector, less the sample's mean, is approximated by a sum of codewords, one from each of several codebooks that are
as long as the vector. The codebooks are trained one after another on the residuals of a bounded sample (SAMPLE rows
with the smallest hashes of their ids). Every vector is encoded by a beam search over the codebooks, and its code is
stored with the squared norm of the approximation. A query's products with all codewords make a lookup table, so an
approximate distance is the norm less twice a sum of table entries.

Which rows are reranked does not depend on how they are dealt out. First, those whose approximate distance is at most the
query's limit, the approximate distance of the row at the same place among the sample's codes; the place is that of
RERANK among all rows, and never under k. That alone misses neighbours where some rows are approximated much worse than
others, so, second, all rows that may be among the k nearest. A row's code is stored with the length e of what it leaves.
For a query at the distance f from the approximation, the true square is ff + ee + 2 c f e, c being the cosine between the two
differences, at least -1. What c can be near a query is read off its PROBES nearest rows of the sample: a row is reranked
if, with a c of MARGIN less than the least of theirs, its distance is at most that of the k-th nearest row of the sample
(exactly measured, so k rows are that near). Reranking is by the exact distance on the original vectors, in double
precision. The same way is taken at every size.

A shard holds its rows' codes and vectors, is bounded in bytes, and reranks its rows itself: what leaves it is the k
nearest of its rows for each query, however many it has measured. Of rows with the very same vector the k + 1 smallest
ids can be among a query's k nearest, so a shard leaves the others out, and a vector that very many rows share costs a
query no more than k + 1 distances in a shard.

Defined cases. Rows that can't take part: see vectors.valid; such a query has no result. Ties in distance: the smaller
id. Repeated ids: a query counts once; a row with the query's id is never its result; other repeated rows are results
of their own. Fewer candidates than k: all of them. Empty table: no rows. Other columns are left out. Components of any
finite size: for codes they are cut at 1e100, so that approximate distances stay finite; exact ones are not cut.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, written
from .vectors import by_shard, dealt, merged, once, sample, valid

BOOKS, WORDS, BEAM = 32, 64, 4
SAMPLE, RERANK = 8192, 200
PROBES, MARGIN = 32, 0.1


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    words = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = ((words * words).sum(1) - 2 * (x @ words.T)).argmin(1)
        n = np.bincount(near, minlength=k)
        sums = (near == np.arange(k)[:, None]).astype(x.dtype) @ x
        words = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.choice(len(x), k)])
    return words


def _extend(left: np.ndarray, c: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One more codebook for each path: the path that each new one comes from, its codeword, and what it leaves.

    left: (rows, paths, dimension), what the paths so far have left.
    """
    error = (left * left).sum(-1)[:, :, None] - 2 * (left @ c.T) + (c * c).sum(1)
    flat = error.reshape(len(left), -1)
    k = min(beam, flat.shape[1])
    best = np.argpartition(flat, k - 1, axis=1)[:, :k]
    path, word = best // len(c), best % len(c)
    return path, word, np.take_along_axis(left, path[:, :, None], 1) - c[word]


def _best(left: np.ndarray) -> np.ndarray:
    return (left * left).sum(-1).argmin(1)


def train(sample: np.ndarray, books: int = BOOKS, words: int = WORDS, beam: int = BEAM, seed: int = 11) -> np.ndarray:
    """Codebooks (books, words, dimension), each trained on what the beam search over those before it leaves."""
    rng = np.random.default_rng(seed)
    out, left = [], sample[:, None, :]
    for _ in range(books):
        out.append(_kmeans(left[np.arange(len(left)), _best(left)], words, rng))
        left = _extend(left, out[-1], beam)[2]
    return np.array(out)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Codes (rows, books): the best end of a beam search."""
    codes, left = np.zeros((len(x), 1, 0), np.uint8), x[:, None, :]
    for c in books:
        path, word, left = _extend(left, c, beam)
        codes = np.concatenate([np.take_along_axis(codes, path[:, :, None], 1), word[:, :, None].astype(np.uint8)], 2)
    return codes[np.arange(len(x)), _best(left)]


def reconstruct(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), books.shape[2]))
    for m, c in enumerate(books):
        out += c[codes[:, m]]
    return out


def _matrix(column, d: int) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return a.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def _inside(x: np.ndarray) -> np.ndarray:
    return np.clip(x, -1e100, 1e100)


def approximate(lookup: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Squared distances, but for the query's own norm, of (queries, books, words) tables to (rows, books) codes."""
    dots = np.zeros((len(lookup), len(codes)))
    for m in range(lookup.shape[1]):
        dots += np.take(lookup[:, m], codes[:, m], axis=1)
    return norms - 2 * dots


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows; where squares overflow or vanish, in units of the largest difference."""
    e = np.abs(q - x)
    with np.errstate(over="ignore"):
        out = np.sqrt((e * e).sum(1))
    odd = ~(np.isfinite(out) & (out > 1e-150)) & (e.max(1, initial=0) > 0)
    if odd.any():
        unit = e[odd].max(1)
        with np.errstate(invalid="ignore"):
            out[odd] = np.where(np.isfinite(unit), unit * np.sqrt(((e[odd] / unit[:, None]) ** 2).sum(1)), np.inf)
    return out


def coded(x: np.ndarray, middle: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, squared norms of the approximations and lengths of what they leave; that of a row that has been cut is unknown (NaN)."""
    inside = _inside(x) - middle
    codes = encode(inside, books)
    y = reconstruct(codes, books)
    rest = np.sqrt(((inside - y) ** 2).sum(1))
    return codes, (y * y).sum(1), np.where((np.abs(x) > 1e100).any(1), np.nan, rest)


def _slack(own: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """What rounding can make of squared distances that are sums of such terms."""
    return 1e-12 * (own[:, None] + norms)


def reach(q: np.ndarray, centred_q: np.ndarray, ids: np.ndarray, near: np.ndarray, own: np.ndarray, sample: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(square of the distance within which the k nearest are, largest -c near a query) of each query; see the module.

    q, centred_q: the queries' vectors, and less the mean; near, own: approximate squares to the sample's rows, but for own, the queries' own norms;
    sample: its ids, vectors, vectors less the mean, norms of the approximations and rests.
    """
    some_ids, some_x, centred, norms, rest = sample
    within, least, lengths = np.full(len(q), np.inf), np.ones(len(q)), (centred * centred).sum(1)
    for r in range(len(q)):
        rough = lengths - 2 * (centred @ centred_q[r])
        rough[some_ids == ids[r]] = np.inf
        m = min(max(PROBES, k), int(np.isfinite(rough).sum()))
        if m < k or not m:
            continue
        at = np.argpartition(rough, m - 1)[:m]
        true = exact(q[r], some_x[at])
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            within[r] = np.partition(true, k - 1)[k - 1] ** 2
            square = np.maximum(near[r, at] + own[r], 0)
            c = (true * true - square - rest[at] ** 2) / (2 * np.sqrt(square) * rest[at])
        c = np.where(np.isfinite(c), c, 0.0 if (rest[at] == 0).all() else -1.0)
        least[r] = np.clip(MARGIN - c.min(), 0, 1)
    return within, least


def build(vectors: DataFrame, d: int) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The index (id, vector, code, norm, rest, twin) of every row, the sample's mean, the codebooks and the sample's ids
    and vectors. rest: the length of what a row's code leaves; twin: the digest of its vector.

    vectors: (id, vector).
    """
    prepare(vectors.sparkSession)
    some = sample(vectors.select("id", "vector"), SAMPLE)
    some_ids, some_x = some.column("id").to_numpy(), _matrix(some.column("vector"), d)
    middle = _inside(some_x).mean(0)
    books = train(_inside(some_x) - middle)
    shared = vectors.sparkSession.sparkContext.broadcast((middle, books))

    def run(batches):
        middle, books = shared.value
        for batch in batches:
            for k in range(0, batch.num_rows, 2048):
                part = batch.slice(k, 2048)
                x = _matrix(part.column("vector"), d)
                codes, norm, rest = coded(x, middle, books)
                twins = [hashlib.blake2b(r.tobytes(), digest_size=16).digest() for r in x + 0.0]  # 0.0: of both zeros
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("vector"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm), pa.array(rest), pa.array(twins, pa.binary())], names=["id", "vector", "code", "norm", "rest", "twin"])

    kind = f"id long, vector {vectors.schema['vector'].dataType.simpleString()}, code binary, norm double, rest double, twin binary"
    return written(vectors.mapInArrow(run, kind), "index"), middle, books, some_ids, some_x


def _first_twins(ids: np.ndarray, twins: list[bytes], most: int) -> np.ndarray:
    """The places of the rows that are among the first `most` ids of those with their vector."""
    first, second = np.frombuffer(b"".join(twins), np.uint64).reshape(-1, 2).T
    order = np.lexsort((ids, second, first))
    starts = np.append(True, (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)) if len(ids) else np.zeros(0, bool)
    rank = np.arange(len(ids)) - np.maximum.accumulate(np.where(starts, np.arange(len(ids)), 0))
    return np.sort(order[rank < most])


def _least(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query's rows the k with the least scores, ties by the smaller id."""
    order = np.lexsort((ids, score, query))
    q = query[order]
    order = order[np.arange(len(q)) - np.searchsorted(q, q) < k]
    return query[order], ids[order], score[order]


#: Components that are measured at once.
MEASURED = 1 << 20


def nearest(vectors: DataFrame, queries: DataFrame, *, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", rerank: int = RERANK, reranked=None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, by Euclidean distance; queries: rows alike.

    reranked: an accumulator, to which the number of exact distances is added.
    """
    rows, d = valid(vectors, id_col, vector_col)
    asked, _ = valid(queries, id_col, vector_col)
    if not d:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, middle, books, some_ids, some_x = build(rows, d)
    n = index.count()
    codes, norms, rests = coded(some_x, middle, books)
    place = min(len(codes), max(k + 1, -(-rerank * len(codes) // n))) - 1  # one more than k: the query's own row may be in the sample
    shared = index.sparkSession.sparkContext.broadcast((middle, books, codes, norms, rests, some_ids, some_x))

    def lookup(q) -> np.ndarray:
        return np.einsum("qd,mwd->qmw", q, shared.value[1])

    def centred(column) -> np.ndarray:
        return _inside(_matrix(column, d)) - shared.value[0]

    def limits(batches):
        middle, _, codes, norms, rests, some_ids, some_x = shared.value
        sample = some_ids, some_x, _inside(some_x) - middle, norms, rests
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                q, ids = centred(part.column("vector")), part.column("id").to_numpy()
                near = approximate(lookup(q), codes, norms)
                limit = np.partition(near, place, axis=1)[:, place]
                within, least = reach(_matrix(part.column("vector"), d), q, ids, near, (q * q).sum(1), sample, k)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("vector"), pa.array(limit), pa.array(least), pa.array(within)], names=["id", "vector", "norm", "rest", "within"])

    def search(batches):
        last, step = None, -(-MEASURED // d)
        for table, part in by_shard(batches):
            if table is not last:
                last, own = table, table.column("id").to_numpy()
                chosen = _first_twins(own, table.column("twin").to_pylist(), k + 1)
                own, norm, rest = own[chosen], *(table.column(c).to_numpy()[chosen] for c in ("norm", "rest"))
                code = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(table.num_rows, -1)[chosen]
                x = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            ids, limit, least, within = (part.column(c).to_numpy() for c in ("id", "norm", "rest", "within"))
            q = centred(part.column("vector"))
            tables, length, vector = lookup(q), (q * q).sum(1), _matrix(part.column("vector"), d)
            best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            for s in range(0, len(own), 4096):  # as many at once as stay in the processor's cache
                near = approximate(tables, code[s : s + 4096], norm[s : s + 4096])
                e, far = rest[s : s + 4096], np.sqrt(np.maximum(near + length[:, None], 0))
                lower = far * (far - 2 * least[:, None] * e) + e * e - _slack(length, norm[s : s + 4096])
                a, b = np.nonzero(((near <= limit[:, None]) | ~(lower > within[:, None])) & (ids[:, None] != own[None, s : s + 4096]))
                for i in range(0, len(a), step):
                    at, of = a[i : i + step], b[i : i + step] + s
                    score = exact(vector[at], x[chosen[of]].astype(np.float64))
                    best = _least(*map(np.append, best, (at, own[of], score)), k)
                if reranked is not None:
                    reranked.add(len(a))
            if len(best[0]):
                yield pa.RecordBatch.from_arrays([pa.array(ids[best[0]]), pa.array(best[1]), pa.array(best[2])], names=["query_id", "vec_id", "score"])

    kind = index.schema["vector"].dataType.simpleString()
    asked = written(once(asked).mapInArrow(limits, f"id long, vector {kind}, norm double, rest double, within double"), "asked")
    nothing = lambda c, t: F.lit(None).cast(t).alias(c)
    held = index.select("id", "vector", "code", "norm", "rest", nothing("within", "double"), "twin")
    looking = asked.select("id", "vector", nothing("code", "binary"), "norm", "rest", "within", nothing("twin", "binary"))
    single = 4 if kind == "array<float>" else 8
    found = dealt(held, looking, n, single * d + books.shape[0] + 128).mapInArrow(search, "query_id long, vec_id long, score double")
    return merged(found, k)


def op9_ann(spark, sf_dir: str) -> DataFrame:
    """The ten nearest found of every hundredth vector."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(table, table.filter(F.col("vec_id") % 100 == 0))
