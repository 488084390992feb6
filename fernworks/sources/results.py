"""Results of calls that may fail: a table (id, data, error) in attempts, with resume and retry.

`run` makes one Spark job of a wave; `run_batched` makes one of each batch, several at a time, and keeps each batch's
results as it ends, so that a fault after hours of calls loses the batches under way and no others.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, as_completed

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException
from pyspark.sql.window import Window


class ResultStore:
    """An append-only folder of attempts; the last attempt of an id counts, and error is null on success."""

    def __init__(self, spark: SparkSession, path: str, payload: str = "data string", id_type: str = "long"):
        self.spark, self.path = spark, path
        self.schema = f"id {id_type}, {payload}, error string"

    def attempts(self) -> DataFrame:
        """All that has been added, with `attempt`; where `remove` has stopped half way, what was there before it."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path.rstrip("/"))
        before = jvm.org.apache.hadoop.fs.Path(self.path.rstrip("/") + "-before")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path) and fs.exists(before):
            fs.rename(before, path)
        try:
            return self.spark.read.schema(self.schema + ", attempt long").option("recursiveFileLookup", True).parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], self.schema + ", attempt long")

    def rows(self) -> DataFrame:
        a = self.attempts()
        last = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("attempt"), F.col("error").asc_nulls_first()))
        return a.withColumn("_rn", last).filter("_rn <= 1").drop("_rn", "attempt")

    def next_attempt(self) -> int:
        """One more than the last attempt's number, whatever clock its driver had."""
        return (self.attempts().agg(F.max("attempt")).first()[0] or 0) + 1

    def add(self, results: DataFrame, attempt: int | None = None) -> None:
        """Results as a folder of their own below the store, under a hidden name until it is whole: what reads the store
        sees all of them or none, and several can be added at the same time."""
        attempt = self.next_attempt() if attempt is None else attempt
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(self.schema)]
        root, name = self.path.rstrip("/"), f"added-{uuid.uuid4().hex}"
        results.select(*columns).withColumn("attempt", F.lit(attempt).cast("long")).write.parquet(f"{root}/_{name}")
        jvm = self.spark.sparkContext._jvm
        hidden, seen = jvm.org.apache.hadoop.fs.Path(f"{root}/_{name}"), jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        if not hidden.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).rename(hidden, seen):
            raise OSError(f"{root}/_{name} could not be given its name")

    def done(self) -> DataFrame:
        return self.rows().filter("error is null").select("id")

    def failed(self) -> DataFrame:
        return self.rows().filter("error is not null").select("id")

    def counts(self) -> tuple[int, int]:
        """Successes and failures."""
        r = self.rows().agg(F.count_if(F.col("error").isNull()), F.count_if(F.col("error").isNotNull())).first()
        return r[0], r[1]

    def remove(self, ids: DataFrame) -> None:
        """Rewrite the store without ids. The new files take the place of the folder by renames; should it stop in
        between, the store as it was is beside it under the name that ends in -before."""
        kept = self.attempts().join(ids.select("id"), "id", "left_anti")
        path = self.path.rstrip("/")
        other, before = f"{path}-{uuid.uuid4().hex}", f"{path}-before"
        kept.write.parquet(other)
        jvm = self.spark.sparkContext._jvm
        at = lambda x: jvm.org.apache.hadoop.fs.Path(x)
        fs = at(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(at(before), True)
        if fs.exists(at(path)):
            fs.rename(at(path), at(before))
        fs.rename(at(other), at(path))
        fs.delete(at(before), True)

    def clear(self) -> None:
        self.attempts().filter("false").write.mode("overwrite").parquet(self.path)


def run(ids: DataFrame, store: ResultStore, work: Callable[[DataFrame], DataFrame], *, retries: int = 0, resume: bool = True, must_succeed: bool = True) -> dict:
    """work (ids to results) for the ids that have no success yet, tried again up to `retries` times; a summary.

    Concurrency is Spark's: work maps partitions. Only the ids asked for are tried, retried and counted. Raises
    RuntimeError if some have failed in the end and must_succeed.
    """
    ids = ids.select("id").distinct()
    began = time.time()
    if not resume:
        store.clear()
    for _ in range(retries + 1):
        todo = ids.join(store.done(), "id", "left_anti")
        if not todo.limit(1).count():
            break
        store.add(work(todo))
    return _summary(ids, store, began, must_succeed)


def _summary(ids: DataFrame, store: ResultStore, began: float, must_succeed: bool) -> dict:
    """first_failed: the first hundred of the failed ids; all of them are in store.failed()."""
    good = store.done().join(ids, "id", "left_semi")
    n, ok = ids.count(), good.count()
    failed = [r[0] for r in ids.join(good, "id", "left_anti").orderBy("id").limit(100).collect()] if ok < n else []
    if failed and must_succeed:
        raise RuntimeError(f"{n - ok} of {n} have failed, the first: {failed[:5]}")
    return {"n_total": n, "n_success": ok, "n_failed": n - ok, "first_failed": failed, "seconds": time.time() - began}


def _wave(spark: SparkSession, numbers: list[int], one: Callable[[int], None], concurrent: int, pool: str | None) -> list[tuple[int, Exception]]:
    """one(number) for each, at most `concurrent` at a time, as Spark jobs under one tag; the faults.

    After the first fault nothing new is begun and the jobs of the others are cancelled.
    """
    sc, tag, stop, faults = spark.sparkContext, f"batches-{uuid.uuid4().hex}", threading.Event(), []

    def tagged(number: int) -> None:
        if stop.is_set():
            return
        sc.addJobTag(tag)
        if pool:
            sc.setLocalProperty("spark.scheduler.pool", pool)
        try:
            one(number)
        finally:
            sc.removeJobTag(tag)

    with ThreadPoolExecutor(concurrent) as threads:
        running = {threads.submit(inheritable_thread_target(spark)(tagged), k): k for k in numbers}
        for f in as_completed(running):
            if f.cancelled():
                continue
            if (e := f.exception()) is not None:
                faults.append((running[f], e))
                if not stop.is_set():
                    stop.set()
                    for other in running:
                        other.cancel()
                    sc.cancelJobsWithTag(tag)
    return faults


def run_batched(ids: DataFrame, store: ResultStore, work: Callable[[DataFrame], DataFrame], *, scratch: str, batch_size: int, concurrent: int = 1, retries: int = 0, resume: bool = True, must_succeed: bool = True, faults: str = "stop", pool: str | None = None) -> dict:
    """work (ids to results) batch by batch for the ids that have no success yet; a summary as of `run`, with `batches`.

    Ids are dealt by hash to batches of about batch_size, written to the folder `scratch` that all executors share; each
    batch is a Spark job, `concurrent` of them run at a time (in the scheduler pool `pool`, if given), and its results
    are in the store as soon as it has ended. Ids whose row has an error, or that got no row, are dealt anew in the next
    of `retries` waves.

    faults: what happens when a batch's job itself fails. "stop": the other jobs are cancelled and the fault is raised;
    what has ended is kept, and a later call does the rest. "rows": the batch's ids get the fault as their error, and
    the other batches go on.

    Repeated ids count once; null ids are left out. No ids: nothing is run.
    """
    if faults not in ("stop", "rows"):
        raise ValueError(f"faults must be stop or rows: {faults}")
    if batch_size < 1 or concurrent < 1:
        raise ValueError("batch_size and concurrent must be at least 1")
    spark, began, batches = store.spark, time.time(), 0
    ids = ids.select("id").filter("id is not null").distinct()
    if not resume:
        store.clear()
    for wave in range(retries + 1):
        todo = ids.join(store.done(), "id", "left_anti")
        if not (n := todo.count()):
            break
        folder, attempt = f"{scratch.rstrip('/')}/wave-{wave}-{uuid.uuid4().hex}", store.next_attempt()
        dealt = todo.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(-(-n // batch_size))))
        dealt.repartition("batch").write.partitionBy("batch").parquet(folder)
        schema = todo.schema
        names = T.StructType.fromDDL(store.schema).names

        def one(k: int, folder=folder, attempt=attempt, schema=schema, names=names) -> None:
            mine = spark.read.schema(schema).parquet(f"{folder}/batch={k}")
            try:
                store.add(work(mine), attempt)
            except Exception as e:  # noqa: BLE001  any fault of the work
                if faults == "stop":
                    raise
                said = F.lit((str(e).strip().splitlines() or [type(e).__name__])[0][:500])
                store.add(mine.select(*[F.col("id") if c == "id" else said.alias(c) if c == "error" else F.lit(None).alias(c) for c in names]), attempt)

        numbers = sorted(r[0] for r in spark.read.schema("batch int").parquet(folder).select("batch").distinct().collect())
        found = _wave(spark, numbers, one, concurrent, pool)
        if found:
            raise RuntimeError(f"batch {found[0][0]} of {len(numbers)} has failed; what has ended is kept") from found[0][1]
        batches += len(numbers)
    return _summary(ids, store, began, must_succeed) | {"batches": batches}
