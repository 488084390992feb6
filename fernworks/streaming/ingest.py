"""Ads as a stream. An extension: batch loading (sources.ads) is the defined way.

The stream keeps the first row of an id to *arrive* within the watermark; batch loading keeps the earliest *dated* one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.ads import ADS


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(ADS).json(path)


def first_arrived(stream: DataFrame, key: str = "id", time: str = "date_created", delay: str = "1 day") -> DataFrame:
    """One row of each key; keys are forgotten once the watermark has passed them, so the state stays bounded."""
    at = stream.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", delay)
    return at.dropDuplicatesWithinWatermark([key]).drop("_at")


def counts(stream: DataFrame, time: str, window: str, *keys: str, delay: str = "1 hour") -> DataFrame:
    """(start, end, keys..., n) by tumbling window; late rows beyond the delay are left out."""
    w = stream.withWatermark(time, delay).groupBy(F.window(time, window), *keys).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def write(stream: DataFrame, store: str, checkpoint: str):
    """Append to a Parquet table, exactly once; reads all there is and stops."""
    return stream.writeStream.format("parquet").option("path", store).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
