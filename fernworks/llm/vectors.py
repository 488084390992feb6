"""What the searches share: valid vectors, a fair sample of rows, and queries dealt to shards of the rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Bytes of the rows of a shard, which a task holds, and the queries that it compares with them at once.
SHARD_BYTES, BLOCK = 32 << 20, 512


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, vector) of the rows that take part, and their dimension (the most common one; others take no part).

    Null ids and vectors, zero vectors and those with null or non-finite components take no part. Components stay
    float where they are float; all others become double.
    """
    kind = vectors.schema[vector_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("vector"))
    v = v.filter(F.col("id").isNotNull() & F.col("vector").isNotNull())
    v = v.filter(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vector", lambda x: x != 0))
    first = v.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    d = first["d"] if first else 0
    return v.filter(F.size("vector") == d), d


def sample(rows: DataFrame, size: int) -> pa.Table:
    """The `size` rows with the smallest hashes of their ids: alike at every reading."""
    others = [c for c in rows.columns if c != "id"]
    return rows.withColumn("_order", F.xxhash64("id")).orderBy("_order", "id", *others).limit(size).drop("_order").toArrow()


def once(queries: DataFrame) -> DataFrame:
    """A query id that is repeated counts once, with its smallest row."""
    others = [c for c in queries.columns if c != "id"]
    return queries.groupBy("id").agg(F.min(F.struct(*others)).alias("q")).select("id", "q.*")


def dealt(rows: DataFrame, queries: DataFrame, n: int, row_bytes: int) -> DataFrame:
    """Rows and queries (columns alike) with `shard` and `asked`: every query goes to every shard of the n rows.

    A shard is bounded by SHARD_BYTES and its rows stand before the queries, which stream past them, so a task's
    memory grows with neither. What is moved is each row once, and each query once for a shard. rows must be a written
    table: shards take its rows in turn, whatever their ids.
    """
    shards = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n * row_bytes // SHARD_BYTES))
    left = rows.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")).withColumn("asked", F.lit(False))
    right = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("asked", F.lit(True))
    return left.unionByName(right.select(left.columns)).repartition(shards, "shard").sortWithinPartitions("shard", "asked")


def by_shard(batches) -> Iterator[tuple[pa.Table, pa.RecordBatch]]:
    """(rows of a shard, some of its queries); the rows are the same object as long as the shard is."""
    shard, held, table = None, [], None
    for batch in batches:
        numbers, asked = batch.column("shard").to_pylist(), batch.column("asked").to_pylist()
        start = 0
        while start < batch.num_rows:
            stop = start
            while stop < batch.num_rows and (numbers[stop], asked[stop]) == (numbers[start], asked[start]) and stop - start < BLOCK:
                stop += 1
            part = batch.slice(start, stop - start)
            if numbers[start] != shard:
                shard, held, table = numbers[start], [], None
            if not asked[start]:
                held.append(part)
            elif held:
                if table is None:
                    table = pa.Table.from_batches(held).combine_chunks()
                yield table, part
            start = stop


def merged(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k smallest scores of each query; ties by the smaller id."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
