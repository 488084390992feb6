"""Tables in files, and the markers that say a step's output is complete."""

from __future__ import annotations

import atexit
import hashlib
import json
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scratch(spark: SparkSession) -> str:
    """A new folder's name below the one that all executors share (spark.checkpoint.dir; in tests a temporary one)."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="fernworks-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", at)
    return f"{at.rstrip('/')}/fernworks-files/{uuid.uuid4().hex}"


#: Tables that `kept` has written.
_kept: list[str] = []
#: Rows from which a table that `kept` has written is joined by a shuffle.
MERGED_ROWS = 50_000


def kept(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: computed once, and there again when an executor is lost. See forget.

    Spark takes a table's files for its size, and numbers take ten times as much in memory, so a table with many rows
    has the hint that it is not to be sent to all tasks through the driver.
    """
    path = scratch(df.sparkSession)
    if not _kept:
        atexit.register(_forget_at_exit)
    _kept.append(path)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    return out.hint("merge") if out.count() >= MERGED_ROWS else out


def forget(spark: SparkSession) -> None:
    """Remove the tables that `kept` has written so far, when no result that reads them is needed any more."""
    while _kept:
        fs, p = _fs(spark, _kept.pop())
        fs.delete(p, True)


def _forget_at_exit() -> None:
    try:
        spark = SparkSession.getActiveSession()
        if spark is not None and spark.sparkContext._jsc is not None:
            forget(spark)
    except Exception:  # noqa: BLE001  the session may be gone, and the folder with it
        _kept.clear()


def register(spark: SparkSession, tables: dict[str, str]) -> None:
    """Parquet tables as views for SQL, each read where it lies."""
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated table with a header, every column as text."""
    return spark.read.csv(path, sep="\t", header=True, inferSchema=False, quote="")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A table as CSV files with a header, one for each of its partitions."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_map(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(key, value) of a map of texts: of files of one JSON object each, or (lines) of what write_map has made."""
    if lines:
        return spark.read.schema("key string, value string").json(path)
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")))


def write_map(df: DataFrame, path: str, key: str = "key", value: str = "value") -> None:
    """A table of texts as JSON lines {"key": ..., "value": ...}, sorted by key; a null value is written as null."""
    rows = df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value")).orderBy("key")
    rows.select(F.to_json(F.struct("key", "value"), {"ignoreNullFields": "false"})).write.mode("overwrite").text(path)


def boundaries(spark: SparkSession, path: str, tolerance: float = 0.0, lines: bool = False) -> DataFrame:
    """The properties of GeoJSON features, with their geometry as `geometry` (struct of type and coordinates, a JSON text).

    lines: a feature on each line, which Spark splits; else whole files with a collection of features each. tolerance:
    polygons are simplified by it (see functions.geometry.simplify). A feature without geometry has null there; a
    property named geometry is hidden by it.
    """
    from ..functions.geometry import simplify
    from ..functions.workers import prepare

    reader = spark.read if lines else spark.read.option("multiLine", True)
    found = reader.json(path)
    one = T.StructType.fromJson(found.schema.jsonValue()) if lines else found.schema["features"].dataType.elementType
    if "properties" not in one.names or not isinstance(one["properties"].dataType, T.StructType):
        raise ValueError(f"{path}: no feature has properties")
    feature = T.StructType([one["properties"], T.StructField("geometry", T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]))])
    if lines:
        f = spark.read.schema(feature).json(path)
    else:
        f = reader.schema(T.StructType([T.StructField("features", T.ArrayType(feature))])).json(path).select(F.inline("features"))
    names = [n for n in one["properties"].dataType.names if n != "geometry"]
    if tolerance > 0:
        prepare(spark)
        made = simplify(F.col("geometry.type"), F.col("geometry.coordinates"), tolerance)
        f = f.withColumn("geometry", F.when(F.col("geometry").isNotNull(), F.struct(F.col("geometry.type").alias("type"), made.alias("coordinates"))))
    return f.select(*[F.col("properties").getField(n).alias(n) for n in names], "geometry")


def boundary_attributes(spark: SparkSession, path: str) -> DataFrame:
    """The properties of a GeoJSON file's features, without their geometry."""
    return spark.read.option("multiLine", True).json(path).selectExpr("explode(features) as f").select("f.properties.*")


def digest(config: dict, leave_out: tuple[str, ...] = ()) -> str:
    """SHA-256 of a configuration; the order of its keys and the keys left out make no difference."""
    return hashlib.sha256(json.dumps({k: v for k, v in config.items() if k not in leave_out}, sort_keys=True, default=str).encode()).hexdigest()


MARKER = "step.json"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_marker(spark: SparkSession, folder: str) -> dict | None:
    fs, p = _fs(spark, f"{folder}/{MARKER}")
    return json.loads("".join(r[0] for r in spark.read.text(f"{folder}/{MARKER}", wholetext=True).collect())) if fs.exists(p) else None


def _put(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_marker(spark: SparkSession, folder: str, values: dict) -> None:
    """The marker is written last, so that a folder without one is incomplete."""
    _put(spark, f"{folder}/{MARKER}", json.dumps(values, sort_keys=True, default=str))


def readable(spark: SparkSession, path: str) -> bool:
    """Whether every file of a Parquet table can be read."""
    try:
        spark.read.parquet(path).write.format("noop").mode("overwrite").save()
        return True
    except Exception:  # noqa: BLE001  any failure to read is the answer
        return False


def incomplete(spark: SparkSession, root: str, steps: list[str], check_files: bool = False) -> dict[str, str]:
    """For steps below root: MISSING without a folder, INCOMPLETE without a marker or (where asked) with unreadable files."""
    out = {}
    for s in steps:
        fs, p = _fs(spark, f"{root}/{s}")
        if not fs.exists(p):
            out[s] = "MISSING"
        elif read_marker(spark, f"{root}/{s}") is None or (check_files and not readable(spark, f"{root}/{s}/data")):
            out[s] = "INCOMPLETE"
    return out


def clean(spark: SparkSession, root: str, steps: list[str], dry_run: bool = True, check_files: bool = False) -> list[str]:
    """Remove incomplete steps (only name them in a dry run); their names."""
    bad = [s for s, what in incomplete(spark, root, steps, check_files).items() if what == "INCOMPLETE"]
    for s in [] if dry_run else bad:
        fs, p = _fs(spark, f"{root}/{s}")
        fs.delete(p, True)
    return bad


def discover_runs(spark: SparkSession, root: str, needed: tuple[str, ...]) -> list[dict[str, str]]:
    """Runs below root, on any file system, named val__definition__llm__embedding__reranker that have all the files needed."""
    fs, p = _fs(spark, root)
    out = []
    for name in sorted(x.getPath().getName() for x in fs.listStatus(p)):
        parts = name.split("__")
        if len(parts) == 5 and parts[0] == "val" and all(fs.exists(_fs(spark, f"{root}/{name}/{n}")[1]) for n in needed):
            out.append({"run": name, "definition": parts[1], "llm": parts[2], "embedding": parts[3], "reranker": parts[4]})
    return out
