"""Vector code compression: product codes by weighted Lloyd rounds over the distinct integer parts of all vectors.

A component x becomes the integer floor(scale * x); vectors are cut into equal consecutive parts. Parts that are equal
at a position are one row with a weight, made by one aggregation (summed before the exchange), so a vector that a third
of all rows share counts once in each round. A round assigns every distinct row to its position's nearest entry and
sums rows times weight for each entry inside the task; what leaves a task is a row for each entry. All arithmetic is in
integers, so sums are the same in any order. At the end each distinct row has its code and error, which are joined back
to the vectors by position and part; Spark splits a part of very many vectors there.

The codebooks are the only thing that the driver holds: positions x entries x components of a part, whatever the rows.

Defined cases. Null vectors and those with null or non-finite components are left out. Repeated rows and ids: each row
has its result row; where the first codebooks are chosen, equal ids are ordered by their components. Null ids are coded
like others but come last in that order. Null labels count together. Fewer vectors than entries: fewer entries. Empty
table, or no vector that takes part: no rows. Vectors of unequal length, or of a length that the number of parts does
not divide, and integers of 2**28 or more, whose squares could leave 64 bits, are errors. Zero vectors take part. Extra
columns have no effect.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, written

#: Integers must be smaller than this; rows of which distances are made at once.
LARGEST, BLOCK = 1 << 28, 4096


def integers(vectors: DataFrame, *, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(row, id, label, v): the vectors that take part, as integers; row is unique."""
    kept = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("x")).filter("x is not null")
    kept = kept.filter(F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    bad = F.exists("x", lambda x: F.abs(x * scale) >= LARGEST)
    whole = F.when(bad, F.raise_error(F.lit("a component is too large for sums of squares in 64 bits")).cast("array<long>")).otherwise(F.transform("x", lambda x: F.floor(x * scale)))
    return kept.select(F.monotonically_increasing_id().alias("row"), "id", "label", whole.alias("v"))


def parts_of(rows: DataFrame, width: int, positions: int) -> DataFrame:
    cut = F.transform(F.sequence(F.lit(0), F.lit(positions - 1)), lambda p: F.struct(p.alias("position"), F.slice("v", p * width + 1, width).alias("part")))
    return rows.select("row", F.inline(cut))


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part its nearest entry (the lower number of equals) and the squared distance."""
    code, error = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    for k in range(0, len(parts), BLOCK):
        away = parts[k : k + BLOCK, None, :] - entries[None]
        away = (away * away).sum(axis=2)
        code[k : k + BLOCK] = here = away.argmin(axis=1)
        error[k : k + BLOCK] = np.take_along_axis(away, here[:, None], 1)[:, 0]
    return code, error


def _by_position(batch: pa.RecordBatch, width: int):
    """(position, the batch's rows there, their parts)."""
    position = batch.column("position").to_numpy()
    flat = batch.column("part").flatten().to_numpy().reshape(-1, width)
    for p in np.unique(position).tolist():
        at = np.flatnonzero(position == p)
        yield p, at, flat[at]


def lloyd(distinct: DataFrame, books: list[np.ndarray], rounds: int) -> list[np.ndarray]:
    """The codebooks after so many rounds over (position, part, weight)."""
    width = books[0].shape[1]
    prepare(distinct.sparkSession)
    for _ in range(rounds):

        def sums(batches, books=books):
            total = [np.zeros((len(b), width + 1), np.int64) for b in books]
            for batch in batches:
                weight = batch.column("weight").to_numpy()
                for p, at, parts in _by_position(batch, width):
                    code, _ = nearest(parts, books[p])
                    np.add.at(total[p], code, np.column_stack([parts * weight[at, None], weight[at]]))
            rows = [(p, e, *t) for p, b in enumerate(total) for e, t in enumerate(b.tolist()) if t[-1]]
            if rows:
                p, e, *t = map(list, zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), *(pa.array(x, pa.int64()) for x in t)], names=["position", "entry", *(f"s{i}" for i in range(width)), "n"])

        schema = "position int, entry int, " + "".join(f"s{i} long, " for i in range(width)) + "n long"
        found = distinct.mapInArrow(sums, schema).groupBy("position", "entry").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)], F.sum("n").alias("n"))
        books = [b.copy() for b in books]
        for r in found.collect():  # a row for each entry
            books[r["position"]][r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return books


def coded(distinct: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(position, part, code, error) for each row of (position, part, ...)."""
    width = books[0].shape[1]

    def run(batches):
        for batch in batches:
            code, error = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for p, at, parts in _by_position(batch, width):
                code[at], error[at] = nearest(parts, books[p])
            yield pa.RecordBatch.from_arrays([batch.column("position"), batch.column("part"), pc.cast(pa.array(code), pa.int32()), pa.array(error)], names=["position", "part", "code", "error"])

    prepare(distinct.sparkSession)
    return distinct.select("position", "part").mapInArrow(run, "position int, part array<long>, code int, error long")


def compress(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 4096, positions: int = 8, entries: int = 16, rounds: int = 6) -> tuple[DataFrame, list[np.ndarray]]:
    """(id_col, codes, error, label_error) for each vector that takes part, and the codebooks (entries x components for
    each position). codes: array<int>, one of each position. See the module for the method and the defined cases."""
    rows = written(integers(vectors, id_col=id_col, vector_col=vector_col, label_col=label_col, scale=scale), "integers")
    sizes = rows.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    if sizes["least"] != sizes["most"] or (sizes["most"] or 0) % positions:
        raise ValueError(f"vectors of {sizes['least']} to {sizes['most']} components can't be cut into {positions} equal parts")
    width = (sizes["most"] or positions) // positions
    first = rows.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    start = np.array([r["v"] for r in first], np.int64).reshape(len(first), positions, width)
    books = [start[:, p].copy() for p in range(positions)]
    parts = parts_of(rows, width, positions)
    if first and width:
        distinct = written(parts.groupBy("position", "part").agg(F.count(F.lit(1)).alias("weight")), "parts")
        books = lloyd(distinct, books, rounds)
        codes = coded(distinct, books)
    else:
        codes = parts.select("position", "part", F.lit(0).alias("code"), F.lit(0).cast("long").alias("error"))
    found = parts.join(codes, ["position", "part"]).groupBy("row")
    found = found.agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "code"))), lambda x: x["code"]).alias("codes"), F.sum("error").alias("error"))
    found = written(rows.select("row", "id", "label").join(found, "row"), "codes")
    by_label = found.groupBy("label").agg(F.sum("error").alias("label_error"))
    out = found.join(by_label, found["label"].eqNullSafe(by_label["label"])).select(found["id"].alias(id_col), "codes", "error", "label_error")
    return out, books


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Codes and errors of all vectors of `embeddings`, with the digest of the codebooks."""
    out, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return out.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql(rounds: int = 6) -> str:
    """The rounds as statements one after another: b0 are the first codebooks, a<k> the parts assigned to those of b<k>."""
    steps = []
    for k in range(rounds + 1):
        away = "list_sum([(x.v[i] - b.v[i]) * (x.v[i] - b.v[i]) for i in range(1, len(x.v) + 1)])::BIGINT"
        steps.append(f"a{k} AS MATERIALIZED (SELECT x.r, x.p, min({{'d': {away}, 'e': b.e}}) AS m FROM x JOIN b{k} b USING (p) GROUP BY x.r, x.p)")
        if k < rounds:
            steps.append(
                f"b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(s.v, b.v) AS v FROM b{k} b LEFT JOIN (SELECT p, e, list(c ORDER BY i) AS v FROM ("
                f"SELECT p, m.e AS e, i, floor(sum(c)::DOUBLE / count(*))::BIGINT AS c FROM (SELECT x.p, m, unnest(x.v) AS c, unnest(range(len(x.v))) AS i FROM x JOIN a{k} USING (r, p)) GROUP BY ALL) GROUP BY p, e) s ON s.p = b.p AND s.e = b.e)"
            )
    return f"""
WITH k AS (SELECT row_number() OVER () AS r, vec_id, label, [floor(4096 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
x AS MATERIALIZED (SELECT r, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS v FROM k, range(8) q(p)),
f AS (SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM k ORDER BY vec_id, v LIMIT 16),
b0 AS MATERIALIZED (SELECT x.p, f.e, x.v FROM f JOIN x USING (r)),
{", ".join(steps)},
c AS (SELECT vec_id, label, string_agg(lower(printf('%02x', m.e::INT)), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM k JOIN a{rounds} USING (r) GROUP BY r, vec_id, label),
s AS (SELECT sha256(string_agg(t, ',' ORDER BY p, e)) AS codebooks_sha256 FROM (SELECT p, e, array_to_string(v, ',') AS t FROM b{rounds}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM c, s
"""


SQL = _sql()
