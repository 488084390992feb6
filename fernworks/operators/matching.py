"""Samples, keep/drop decisions and pair scores over candidate tables (ad_id, rank, onet_code, ...)."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.workers import prepare


def hash_sample(df: DataFrame, n: int, seed: int, key: str = "id") -> DataFrame:
    """n rows without replacement, the same ones at every run; -1: all; other negative numbers raise ValueError."""
    if n == -1:
        return df
    if n < 0:
        raise ValueError("n must be -1 or at least 0")
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")).cast("binary")), key).limit(n)


def kept_indices(data: Column) -> Column:
    """The list under "keep" in a JSON text; null where the text is not such JSON."""
    return F.from_json(data, "keep array<int>")["keep"]


def validated(responses: DataFrame, sizes: DataFrame) -> DataFrame:
    """(ad_id, keep, error): at least one index, all from 1 to the ad's number of candidates; error null where so.

    responses: (ad_id, data, error); sizes: (ad_id, n).
    """
    r = responses.join(sizes, "ad_id").withColumn("keep", kept_indices(F.col("data")))
    error = (
        F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("keep").isNull(), "JSONDecodeError: malformed response").when(F.size("keep") == 0, "ValidationError: must keep at least 1")
        .when(F.exists("keep", lambda i: i.isNull()), "ValidationError: keep must hold integers").when(F.exists("keep", lambda i: i < 1), "ValidationError: keep indices must be 1-based").when(F.exists("keep", lambda i: i > F.col("n")), "index out of range")
    )
    return r.select("ad_id", "keep", error.alias("error"))


def rated_tasks(answers: DataFrame) -> DataFrame:
    """(id, exposure, confidence, error) of (id, data): a task's exposure of 0, 1 or 2 with a confidence from 0 to 1; error null where so."""
    r = answers.withColumn("r", F.from_json("data", "occupation string, task string, reasoning string, exposure int, confidence_0to1 double"))
    e, c = F.col("r.exposure"), F.col("r.confidence_0to1")
    lacks = F.exists(F.array("r.occupation", "r.task", "r.reasoning", e.cast("string"), c.cast("string")), lambda x: x.isNull())
    error = (
        F.when(F.col("r").isNull() | lacks, "ValidationError: a field is missing or of another type").when(~e.isin(0, 1, 2), F.concat(F.lit("exposure must be 0, 1, or 2, got "), e.cast("string")))
        .when((c < 0) | (c > 1) | F.isnan(c), F.concat(F.lit("confidence must be in [0, 1], got "), c.cast("string")))
    )
    return r.select("id", F.when(error.isNull(), e).alias("exposure"), F.when(error.isNull(), c).alias("confidence"), error.alias("error"))


def pair_answers(answers: DataFrame) -> DataFrame:
    """(id, outcome, error) of (id, data): which of a pair is more exposed, A, B or tie; error null where so."""
    said = F.from_json("data", "more_exposed string")["more_exposed"]
    r = answers.withColumn("said", said)
    good = F.col("said").isin("A", "B", "tie")
    return r.select("id", F.when(good, F.col("said")).alias("outcome"), F.when(~F.coalesce(good, F.lit(False)), "ValidationError: more_exposed must be A, B or tie").alias("error"))


def split_by_response(candidates: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept candidates, ranked anew from 0 in their old order, and dropped ones with their original_rank.

    Ads whose response is in error are in neither.
    """
    sizes = candidates.groupBy("ad_id").agg(F.count(F.lit(1)).alias("n"))
    good = validated(responses, sizes).filter("error is null").select("ad_id", "keep")
    both = candidates.join(good, "ad_id").withColumn("stays", F.array_contains("keep", F.col("rank") + 1)).drop("keep")
    order = Window.partitionBy("ad_id").orderBy("rank")
    kept = both.filter("stays").withColumn("rank", (F.row_number().over(order) - 1).cast("int")).drop("stays")
    return kept, both.filter("not stays").withColumnRenamed("rank", "original_rank").drop("stays")


def error_class(error: Column) -> Column:
    """One of seven classes of an error text, by the first test that holds; the JSON-in-prose text is the one that is written."""
    validation = F.when(error.contains("must keep at least 1"), "empty_keep").when(error.contains("keep indices must be 1-based"), "zero_or_negative_index").otherwise("validation_error")
    return (
        F.when(error.contains("ValidationError"), validation).when(error.contains("JSONDecodeError"), "malformed_json").when(error.contains("out of range"), "index_out_of_range")
        .when(error.contains("Failed to extract valid JSON"), "no_json_in_reasoning").otherwise("other")
    )


def first_json(text: str | None, valid=None) -> str | None:
    """The first JSON object inside prose: from the earliest opening brace at which one begins; each is parsed once."""
    text, decoder = text or "", json.JSONDecoder()
    start = text.find("{")
    while start >= 0:
        try:
            found, end = decoder.raw_decode(text, start)
            if valid is None or valid(found):
                return text[start:end]
        except (ValueError, RecursionError):
            pass
        start = text.find("{", start + 1)
    return None


def json_in_prose(df: DataFrame, column: str, valid=None) -> DataFrame:
    """df with `column` reduced to the first JSON object in it (null: none). The one place that needs Python, in Arrow batches."""
    prepare(df.sparkSession)

    @F.pandas_udf(T.StringType())
    def pick(s: pd.Series) -> pd.Series:
        return s.map(lambda x: first_json(x, valid))

    return df.withColumn(column, pick(F.col(column)))


def reranked(kept: DataFrame, scores: DataFrame) -> DataFrame:
    """kept with rerank_score by (ad_id, onet_code); the rank stays that of the filter."""
    return kept.join(scores.select("ad_id", "onet_code", "rerank_score"), ["ad_id", "onet_code"], "left")


def pruned(matches: DataFrame, most: int) -> DataFrame:
    return matches.filter(F.col("rank") < most)


def remaining(ids: DataFrame, results: DataFrame, key: str = "id") -> DataFrame:
    """The ids without a successful result: never tried, or failed."""
    return ids.join(results.filter("error is null").select(key), key, "left_anti")
