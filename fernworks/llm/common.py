"""What the operators of this subpackage share: the shared folder, written tables, packs of documents."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.workers import prepare  # noqa: F401  for the operators

def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or on one machine (tests) a temporary one if it is unset."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="fernworks-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


#: Tables that this process has written, for `clean`.
_written: list[str] = []


def clean(spark: SparkSession, since: int = 0, kept: set[str] | None = None) -> None:
    """Remove the tables written so far (since so many had been, but for those kept); only when no result that was made
    from them is needed any more."""
    jvm = spark.sparkContext._jvm
    for name in [w for w in _written[since:] if w not in (kept or ())]:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _written.remove(name)


@contextmanager
def passing(spark: SparkSession):
    """Tables written in this block are removed at its end, but for those given to the function that the block gets."""
    since, kept = len(_written), set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._written_at)
        return df

    yield keep
    clean(spark, since, kept)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts lineage, survives lost executors, is computed once. See clean."""
    path = f"{shared_dir(df.sparkSession)}/fernworks/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


#: Spark's own Bloom filters below a shuffle, for joins of a large table with a selected smaller one, whatever their
#: sizes. A filter has 8 MB at most; beyond what it can tell apart it only lets more rows through.
_SCREENS = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0", "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1TB"}


@contextmanager
def screened(spark: SparkSession):
    """Joins that run in this block screen the larger side by a Bloom filter of the smaller one's keys."""
    before = {k: spark.conf.get(k) for k in _SCREENS}
    for k, v in _SCREENS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def in_written_order(rows: DataFrame, *columns: str) -> tuple[DataFrame, int, int]:
    """columns of rows with `position`, from 0 in the order in which they were written; how many rows and files there are.

    Spark reads a folder's files in any order, but a file's name has the number of the task that wrote it, and its rows
    stand as they were written. Rows that are not read from Parquet files are written first. Sent to all tasks is one
    row for each file.
    """
    from pyspark.errors import AnalysisException
    from pyspark.sql.window import Window

    name, number = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    try:
        rows.select(name, number)
    except AnalysisException:
        rows = written(rows.select(*columns), "ordered")
    files = rows.select(name.alias("file"), number.alias("n")).groupBy("file").agg((F.max("n") + 1).alias("n"))
    part = lambda pattern: F.coalesce(F.regexp_extract("file", pattern, 1).try_cast("long"), F.lit(-1))
    before = Window.orderBy(part(r"part-(\d+)"), part(r"-c(\d+)"), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = written(files.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))), "files")
    total = files.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    rows = rows.select(*columns, name.alias("_file"), number.alias("_number")).join(F.broadcast(files.select(F.col("file").alias("_file"), F.col("start").alias("_start"))), "_file")
    return rows.select(*columns, (F.col("_start") + F.col("_number")).alias("position")), total[0], total[1]


def sorted_by_position(rows: DataFrame, n: int, partitions: int) -> DataFrame:
    """rows range-sorted by `position`, which runs from 0 to n - 1, in that many partitions; they are not looked at twice."""
    partitions = max(1, partitions)
    width = max(1, -(-n // partitions))
    at = F.floor(F.col("position") / width).cast("int")
    return rows.repartitionById(partitions, at).sortWithinPartitions("position")


def text_of(docs: DataFrame, text_col: str = "text") -> Column:
    return F.coalesce(docs[text_col].cast("string"), F.lit(""))


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def table_bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).to_pylist()


def packs(batches: Iterator[pa.RecordBatch], text_col: str, pack_bytes: int) -> Iterator[tuple[int, pa.Table]]:
    """Groups of whole rows, in order, of about pack_bytes of text each (a longer text stands alone), with an id.

    The id is unique in the job, and the same whenever the same partition is read again in the same order.
    """
    from pyspark import TaskContext

    import numpy as np
    import pyarrow.compute as pc

    base, n = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32, 0
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths, dtype=np.int64), 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, before + pack_bytes - size, side="right"))
            stop = min(max(stop, start + (not held)), batch.num_rows)
            if stop > start:
                held.append(batch.slice(start, stop - start))
                size += int(ends[stop - 1]) - before
                start = stop
            if start < batch.num_rows or size >= pack_bytes:
                yield base + n, pa.Table.from_batches(held)
                held, size, n = [], 0, n + 1
    if held:
        yield base + n, pa.Table.from_batches(held)


def give_back() -> None:
    """Return freed memory to the system: a Python worker stays for other tasks, and what it has held stays with it."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        pass


def freeze(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    table = table.combine_chunks()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def thaw(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()
