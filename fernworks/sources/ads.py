"""Advertisements: the fixed schema, loading JSON lines by year and month, keeping the earliest of repeated ids."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException
from pyspark.sql.window import Window

from .files import _fs, read_marker, write_marker

# The columns of an advertisement, with their types.
ADS = T.StructType(
    [
        T.StructField(name, kind())
        for name, kind in (
            ("id", T.LongType), ("year", T.IntegerType), ("month", T.IntegerType), ("date_created", T.StringType), ("title", T.StringType), ("description", T.StringType), ("location_raw", T.StringType),
            ("geo_lat", T.StringType), ("geo_lng", T.StringType), ("LAD22CD", T.StringType), ("LAD22NM", T.StringType), ("LAD24CD", T.StringType), ("category_id", T.LongType), ("category_name", T.StringType),
            ("company_raw", T.StringType), ("company_id", T.DoubleType), ("normalised_company", T.StringType), ("salary_min", T.DoubleType), ("salary_max", T.DoubleType), ("salary_currency", T.StringType),
            ("salary_predicted", T.DoubleType), ("salary_raw", T.StringType), ("contract_type", T.StringType), ("contract_time", T.StringType), ("soc2020_major_group", T.StringType), ("soc2020_submajor_group", T.StringType),
            ("soc2020_minor_group", T.StringType), ("soc2020", T.StringType), ("sic_section", T.StringType), ("SIC1", T.StringType), ("SIC2", T.StringType), ("SIC3", T.StringType), ("SIC4", T.StringType),
        )
    ]
)


def harmonised(df: DataFrame, schema: T.StructType = ADS, **constants) -> DataFrame:
    """df in the columns and types of schema: missing ones null, others cast (what can't be is null), constants put in."""
    have = {c.lower(): c for c in df.columns}

    def column(f: T.StructField):
        if f.name in constants:
            return F.lit(constants[f.name]).cast(f.dataType).alias(f.name)
        if f.name.lower() not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return F.expr(f"try_cast(`{have[f.name.lower()]}` as {f.dataType.simpleString()})").alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


def earliest(df: DataFrame, keys: list[str], date: str, tie: str) -> DataFrame:
    """One row of each key: the smallest date, nulls last, then the smallest tie. (A NOT IN over minima would keep all
    rows as soon as one key has no date.)"""
    order = Window.partitionBy(*keys).orderBy(F.col(date).asc_nulls_last(), F.col(tie))
    return df.withColumn("_rn", F.row_number().over(order)).filter("_rn <= 1").drop("_rn")


def read_json(spark: SparkSession, base: str, years: list[int] | None = None) -> DataFrame:
    """JSON lines below base/year=*/month=*/, files .json and .jsonl, as harmonised ads; only the years asked for are read."""
    raw = T.StructType([f for f in ADS.fields if f.name not in ("year", "month")])
    df = spark.read.schema(raw).option("basePath", base).option("pathGlobFilter", "*.json*").json(f"{base}/year=*/month=*")
    df = df.withColumn("year", F.col("year").cast("int")).withColumn("month", F.col("month").cast("int"))
    return harmonised(df.filter(F.col("year").isin(years)) if years else df)


def loaded_months(spark: SparkSession, store: str) -> DataFrame | None:
    """(year, month) that the store has, or None if there is no store yet."""
    try:
        return spark.read.parquet(store).select("year", "month").distinct()
    except AnalysisException:
        return None


#: Rows of a file of the store, about: a month with more is several files, each written by a task of its own.
FILE_ROWS = 1_000_000


def spread(ads: DataFrame, file_rows: int = FILE_ROWS) -> DataFrame:
    """ads dealt so that a month's rows go to as many tasks as it has file_rows, whatever its share of all rows."""
    many = ads.groupBy("year", "month").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / file_rows)).alias("_files"))
    same = ads["year"].eqNullSafe(many["year"]) & ads["month"].eqNullSafe(many["month"])
    n = many.agg(F.sum("_files")).first()[0] or 1
    dealt = ads.join(many, same).select(ads["*"], F.pmod(F.xxhash64("id"), F.col("_files")).alias("_file"))
    return dealt.repartition(int(n), "year", "month", "_file").drop("_file")


def finish(spark: SparkSession, store: str) -> bool:
    """Finish a load that has stopped while it changed the store; whether there was one. What it was about to write lies
    beside the store, and every step that is done again puts the same rows in the same place."""
    intent = read_marker(spark, f"{store.rstrip('/')}-intent")
    if intent is None:
        return False
    laid = lambda name: spark.read.schema(ADS).parquet(f"{intent['beside']}/{name}")
    into = lambda df: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(store)
    if intent["kept"]:
        into(spread(laid("kept"), intent["file_rows"]))
    for path in intent["gone"]:
        _delete(spark, path)
    into(spread(laid("won"), intent["file_rows"]))  # months that the store has not had
    _delete(spark, f"{store.rstrip('/')}-intent")
    _delete(spark, intent["beside"])
    return True


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def load(spark: SparkSession, base: str, store: str, years: list[int] | None = None, file_rows: int = FILE_ROWS) -> int:
    """Add the months that the store lacks; over all of them the earliest row of each id stays. The number of new ids.

    The store is partitioned by year and month, a month in files of about file_rows rows. Where a new month has an
    earlier row of a stored id, the partitions that hold the stored one are rewritten without it (others are not
    touched), then the new months are added. Rows without a date come last; of equal dates the stored row stays.

    All that is to be written lies beside the store first, then a marker (the store's name and -intent) says so: a load
    that stops before it has changed nothing, and one that stops after it is finished by the next load, or by `finish`.
    """
    finish(spark, store)
    beside = f"{store.rstrip('/')}-{uuid.uuid4().hex}"

    def laid(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{beside}/{name}")
        return spark.read.schema(df.schema).parquet(f"{beside}/{name}")

    ads, have = read_json(spark, base, years), loaded_months(spark, store)
    if have is not None:
        ads = ads.join(have, ["year", "month"], "left_anti").select(*ADS.names)
    new = earliest(ads.withColumn("_tie", F.xxhash64(*ADS.names)), ["id"], "date_created", "_tie").drop("_tie")
    ads = laid(new, "won" if have is None else "new")
    n, gone = ads.count(), []
    if have is not None:
        stored = spark.read.schema(ADS).parquet(store)
        both = stored.select("id", F.col("date_created").alias("_old"), "year", "month").join(ads.select("id", F.col("date_created").alias("_new")), "id")
        wins = F.coalesce(F.col("_new") < F.col("_old"), F.col("_new").isNotNull() & F.col("_old").isNull())
        both = laid(both.withColumn("wins", wins), "both")
        n -= both.count()
        laid(ads.join(both.filter("not wins").select("id"), "id", "left_anti").select(*ADS.names), "won")
        losers = both.filter("wins")
        parts = losers.select("year", "month").distinct()
        kept = laid(stored.join(parts, ["year", "month"], "left_semi").join(losers.select("id"), "id", "left_anti").select(*ADS.names), "kept")
        gone = [f"{store}/year={r['year']}/month={r['month']}" for r in parts.join(kept.select("year", "month"), ["year", "month"], "left_anti").collect()]
    write_marker(spark, f"{store.rstrip('/')}-intent", {"beside": beside, "gone": gone, "kept": have is not None, "file_rows": file_rows})
    finish(spark, store)
    return n


def by_id(ads: DataFrame, ids: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The ads of ids (id), with the columns asked for; id always among them."""
    out = ads.join(ids.select("id").distinct(), "id", "left_semi")
    return out.select("id", *[c for c in columns if c != "id"]) if columns else out


def as_lines(ads: DataFrame, width: int = 80) -> DataFrame:
    """(id, shown): each row as lines of "column: value", values cut at width; null values are left out."""

    def line(c: str):
        v = F.col(c).cast("string")
        return F.concat(F.lit(f"{c}: "), F.when(F.length(v) > width, F.concat(F.substring(v, 1, width), F.lit("..."))).otherwise(v))

    return ads.select("id", F.concat_ws("\n", *[line(c) for c in ads.columns if c != "id"]).alias("shown"))


def show(ads: DataFrame, n: int = 3, width: int = 80) -> None:
    ads.show(n, truncate=width, vertical=True)
