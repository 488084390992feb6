"""From scored matches to exposure of ads and districts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .stats import quantiles

NO_MATCH = "no matched scores"


def softmax_weights(matches: DataFrame, temperature: float = 0.7, score: str = "rerank_score", key: str = "ad_id") -> DataFrame:
    """matches with a weight: exp of the min-max score of its ad (0.5 where all are equal) over the temperature."""
    w = Window.partitionBy(key)
    lo, hi = F.min(score).over(w), F.max(score).over(w)
    s = F.when(hi > lo, (F.col(score).cast("double") - lo) / (hi - lo)).otherwise(0.5)
    return matches.withColumn("weight", F.exp(s / temperature))


def ad_exposure(matches: DataFrame, scores: DataFrame, temperature: float = 0.7) -> DataFrame:
    """(ad_id, n_matches, each score): weighted means of the occupations' scores over an ad's matches.

    Negative match scores go first, then matches of unknown occupations; weights are over what is left. scores:
    (onet_code, any number of score columns). One exchange by ad serves the windows and the sums.
    """
    names = [c for c in scores.columns if c != "onet_code"]
    held = matches.filter(F.col("rerank_score") >= 0).join(scores, "onet_code")
    w = softmax_weights(held, temperature)
    means = [(F.sum(F.col("weight") * F.col(c)) / F.sum("weight")).alias(c) for c in names]
    return w.groupBy("ad_id").agg(F.count(F.lit(1)).cast("int").alias("n_matches"), *means)


def all_ads(ads: DataFrame, exposure: DataFrame) -> DataFrame:
    """A row for each ad asked for: those without matches have no scores, n_matches 0 and an error."""
    out = ads.select("ad_id").join(exposure, "ad_id", "left").withColumn("n_matches", F.coalesce("n_matches", F.lit(0)))
    return out.withColumn("error", F.when(F.col("n_matches") == 0, F.lit(NO_MATCH)))


def by_district(exposure: DataFrame, ads: DataFrame, names: DataFrame, code: str = "district") -> DataFrame:
    """Per district: n_ads (all with a code), n_ads_with_scores, and the mean of each score over ads with matches.

    exposure: as all_ads gives; ads: (ad_id, code); names: (code, name). Names are joined after the aggregation.
    """
    scores = [c for c in exposure.columns if c not in ("ad_id", "n_matches", "error")]
    has = F.col("n_matches") > 0
    joined = exposure.join(ads.filter(F.col(code).isNotNull()), "ad_id")
    out = joined.groupBy(code).agg(F.count(F.lit(1)).alias("n_ads"), F.sum(F.when(has, 1).otherwise(0)).cast("int").alias("n_ads_with_scores"), *[F.avg(F.when(has, F.col(c))).alias(c) for c in scores])
    return out.join(names, code, "left")


def minmax(df: DataFrame, column: str, alias: str) -> DataFrame:
    """df with alias: column scaled to [0, 1] over the whole table (null where it is flat)."""
    ends = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    return df.crossJoin(ends).withColumn(alias, F.try_divide(F.col(column) - F.col("_lo"), F.col("_hi") - F.col("_lo"))).drop("_lo", "_hi")


def vulnerability(df: DataFrame, exposure: str, presence: str) -> DataFrame:
    """df with vulnerability: scaled exposure times what scaled presence leaves."""
    out = minmax(minmax(df, exposure, "_e"), presence, "_p")
    return out.withColumn("vulnerability", F.col("_e") * (1 - F.col("_p"))).drop("_e", "_p")


def quadrants(df: DataFrame, exposure: str, presence: str) -> DataFrame:
    """df with quadrant, cut at both medians. (Naming the rows' quadrants is an addition of ours.)"""
    (e,), (p,) = quantiles(df, exposure, [0.5]), quantiles(df, presence, [0.5])
    high, near = F.col(exposure) >= F.lit(e).cast("double"), F.col(presence) >= F.lit(p).cast("double")
    name = F.when(high & near, "augmented").when(high, "vulnerable").when(near, "resilient").otherwise("unchanged")
    return df.withColumn("quadrant", name)
