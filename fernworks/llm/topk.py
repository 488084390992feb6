"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is one or more words of 64 bits, cut into segments of eight bits. If two codes differ in fewer than segments * (r + 1) bits, some
segment differs in at most r bits. So each task indexes its codes by the value of each segment, and for a query looks
up all values within radius 0, then 1, and so on; what it finds is verified by the whole distance. It stops once the
k-th verified distance is at most segments * (r + 1) - 1: nothing that was not found can be nearer or as near. The k-th
distance in a bounded sample of the rows (SAMPLE) is never less than the true one, so a task also stops, and returns
nothing farther, once that distance is covered. Equal codes are one entry with its rows.

Queries and rows meet in shards of the rows (see vectors.dealt); of a shard a query gets its k best at most.

Defined cases. Rows that can't take part: see vectors.valid; such a query has no result. Ties: the smaller id. Repeated
ids: a query counts once; a row with the query's id is never its result; other repeated rows are results of their own.
Fewer candidates than k: all. Empty table: no rows. Other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, written
from .vectors import by_shard, dealt, merged, once, sample, valid

BITS, WIDTH, SAMPLE = 64, 8, 8192
#: Bytes of a row in a shard for each word of its code, with its index.
ROW_BYTES = 512
MASKS = [np.flatnonzero(np.bitwise_count(np.arange(1 << WIDTH)) == r) for r in range(WIDTH + 1)]


def words_of(column) -> np.ndarray:
    """(rows, words) of a column of codes, which are longs, or bytes of as many words as they need."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if pa.types.is_integer(a.type):
        return a.to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, 1)
    rows = a.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint64).reshape(len(rows), -1) if rows else np.zeros((0, 1), np.uint64)


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int64)


class Index:
    """Codes of one block, (rows, words), by the value of each segment."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray):
        order = np.lexsort((ids, *codes.T))
        self.ids, codes = ids[order], codes[order]
        new = np.append(True, (codes[1:] != codes[:-1]).any(axis=1)) if len(ids) else np.zeros(0, bool)
        self.first = np.flatnonzero(new)
        self.rows = np.diff(np.append(self.first, len(ids)))
        self.codes = codes[self.first]
        self.owners, self.owned = np.unique(self.ids, return_counts=True)
        self.segments = BITS // WIDTH * codes.shape[1]
        self.by, self.start = [], []
        for s in range(self.segments):
            v = self._segment(self.codes, s).astype(np.int64)
            self.by.append(np.argsort(v, kind="stable"))
            self.start.append(np.concatenate([[0], np.cumsum(np.bincount(v, minlength=1 << WIDTH))]))

    @staticmethod
    def _segment(codes: np.ndarray, s: int) -> np.ndarray:
        word, at = divmod(s, BITS // WIDTH)
        return (codes[..., word] >> np.uint64(WIDTH * at)) & np.uint64((1 << WIDTH) - 1)

    def search(self, own: int, code: np.ndarray, k: int, bound: int | None = None) -> list[tuple[int, int]]:
        """The k smallest (distance, id) of this block within bound, without rows of the id `own`."""
        bound = BITS * self.codes.shape[1] if bound is None else bound
        seen = np.zeros(len(self.codes), bool)
        at = int(np.searchsorted(self.owners, own))
        need = k + (int(self.owned[at]) if at < len(self.owners) and self.owners[at] == own else 0)
        found, distance = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for r in range(WIDTH + 1):
            new = []
            for s in range(self.segments):
                v = int(self._segment(code, s))
                values = MASKS[r] ^ v
                a, b = self.start[s][values], self.start[s][values + 1]
                n = b - a
                ends = np.cumsum(n)
                if ends[-1]:
                    new.append(self.by[s][np.arange(ends[-1]) + np.repeat(a - (ends - n), n)])
            if new:
                new = np.concatenate(new)
                new = np.unique(new[~seen[new]])
                seen[new] = True
                d = distances(self.codes[new], code)
                found.append(new[d <= bound])
                distance.append(d[d <= bound])
            covered = self.segments * (r + 1) - 1
            if covered >= bound:
                break
            near = np.concatenate(distance)
            if int(self.rows[np.concatenate(found)[near <= covered]].sum()) >= need:
                break
        found, near = np.concatenate(found), np.concatenate(distance)
        order = np.argsort(near, kind="stable")
        found, near = found[order], near[order]
        total = np.cumsum(self.rows[found])
        last = int(near[min(np.searchsorted(total, need), len(near) - 1)]) if len(near) else -1
        out: list[tuple[int, int]] = []
        for c, d in zip(found[near <= last].tolist(), near[near <= last].tolist(), strict=True):
            ids = self.ids[self.first[c] : self.first[c] + self.rows[c]]
            ids = ids[ids != own][:k]  # sorted: of equal codes no others can be among the k
            out += [(d, i) for i in ids.tolist()]
        return sorted(out)[:k]


def codes_of(vectors: DataFrame) -> DataFrame:
    """(id, code) from (id, vector) of one dimension: the signs of its components, the first one lowest, in bytes of as many
    words of 64 bits as they need; a missing one is 0."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            signs = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(n, -1) > 0
            bits = np.zeros((n, -(-max(1, signs.shape[1]) // BITS) * BITS), bool)
            bits[:, : signs.shape[1]] = signs
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([r.tobytes() for r in np.packbits(bits, axis=1, bitorder="little")], pa.binary())], names=["id", "code"])

    prepare(vectors.sparkSession)
    return vectors.mapInArrow(run, "id long, code binary")


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) with score the Hamming distance; codes and queries: (id, code), code being a long
    or, alike in length, bytes of some words of 64 bits."""
    prepare(codes.sparkSession)
    codes = written(codes.select("id", "code"), "codes")
    n, kind = codes.count(), codes.schema["code"].dataType.simpleString()
    some = sample(codes, SAMPLE)
    known = words_of(some.column("code"))
    shared = codes.sparkSession.sparkContext.broadcast((some.column("id").to_numpy(), known))

    def bounds(batches):
        ids, known = shared.value
        for batch in batches:
            out = []
            for i, c in zip(batch.column("id").to_pylist(), words_of(batch.column("code")), strict=True):
                d = distances(known[ids != i], c)
                out.append(int(np.partition(d, k - 1)[k - 1]) if len(d) >= k else BITS * known.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("code"), pa.array(out, pa.int32())], names=["id", "code", "bound"])

    def run(batches):
        last = None
        for table, part in by_shard(batches):
            if table is not last:
                last, index = table, Index(table.column("id").to_numpy(), words_of(table.column("code")))
            asked = zip(part.column("id").to_pylist(), words_of(part.column("code")), part.column("bound").to_pylist(), strict=True)
            rows = [(q, i, d) for q, c, b in asked for d, i in index.search(q, c, k, b)]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.float64()))], names=["query_id", "vec_id", "score"])

    asked = once(queries.select("id", "code")).mapInArrow(bounds, f"id long, code {kind}, bound int")
    both = dealt(codes.withColumn("bound", F.lit(None).cast("int")), asked, n, ROW_BYTES * known.shape[1])
    return merged(both.mapInArrow(run, "query_id long, vec_id long, score double"), k)


def op6_exact_topk(spark, sf_dir: str) -> DataFrame:
    """The ten codes nearest to every hundredth vector's sign code."""
    rows, _ = valid(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    codes = codes_of(rows)
    out = top_k(codes, codes.filter(F.col("id") % 100 == 0))
    return out.select("query_id", "rank", "vec_id", F.col("score").cast("int").alias("distance"))


SQL = r"""
WITH c AS (SELECT vec_id, embedding AS e FROM embeddings),
d AS (SELECT q.vec_id AS query_id, v.vec_id,
    list_sum(list_transform(list_zip(q.e, v.e), lambda p: CASE WHEN (p[1] > 0) <> (p[2] > 0) THEN 1 ELSE 0 END))::INT AS distance
  FROM c q JOIN c v ON q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank FROM d)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10
"""
