"""Run definitions and a runner that skips what is complete."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import files


def resolve(definitions: dict, run: str | None) -> tuple[dict, dict[str, dict]]:
    """Values of a run: (for all steps, for each step). `defaults` are overridden by the run; tables are a step's own."""
    if not run:
        raise ValueError("name a run")
    if run not in definitions.get("runs", {}):
        raise ValueError(f"no run {run!r}; there are {sorted(definitions.get('runs', {}))}")
    common, own = {}, {}
    for layer in (definitions.get("defaults", {}), definitions["runs"][run]):
        for k, v in layer.items():
            if isinstance(v, dict):
                own[k] = {**own.get(k, {}), **v}
            else:
                common[k] = v
    return common, own


class Runner:
    """Steps (spark, inputs, config) -> DataFrame, each written below root/run with a marker of its configuration's digest.

    A step is skipped if its marker has the digest of its configuration and of its inputs' markers: a change to a
    configuration makes that step and all after it run again.
    """

    def __init__(self, spark: SparkSession, root: str, run: str):
        self.spark, self.root = spark, f"{root}/{run}"
        self.digests: dict[str, str] = {}
        self.ran: list[str] = []

    def step(self, name: str, fn: Callable[[SparkSession, dict[str, DataFrame], dict], DataFrame], inputs: dict[str, DataFrame] | None = None, after: tuple[str, ...] = (), config: dict | None = None) -> DataFrame:
        folder, config = f"{self.root}/{name}", config or {}
        want = files.digest({"config": config, "after": {a: self.digests[a] for a in after}})
        marker = files.read_marker(self.spark, folder)
        if not marker or marker.get("digest") != want:
            given = dict(inputs or {}) | {a: self.read(a) for a in after}
            fn(self.spark, given, config).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/data")
            files.write_marker(self.spark, folder, {"digest": want, "n_total": self.read(name).count(), "config": config})
            self.ran.append(name)
        self.digests[name] = want
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}/data")


def match_ads(spark: SparkSession, ads: DataFrame, occupations: DataFrame, scores: DataFrame, root: str, run: str, config: dict) -> DataFrame:
    """The whole chain from texts to the exposure of ads, each step kept: embed, candidates, filter, rerank, exposure.

    ads: (id, title, description); occupations: (onet_code, title, description, alternate_titles, top_tasks).
    """
    from pyspark.sql import functions as F

    from ..functions import text
    from ..operators import exposure, matching, vectors
    from . import providers

    runner = Runner(spark, root, run)
    model = config.get("model", {"mode": "standin"})
    document = text.occupation_text(F.col("title"), F.col("description"), F.col("alternate_titles"), F.col("top_tasks"))
    ad = ads.select("id", text.ad_text(F.col("title"), F.col("description")).alias("text"))
    occ = occupations.select(F.col("onet_code").alias("id"), document.alias("text"))
    runner.step("embed_ads", lambda s, i, c: providers.embedded(i["ads"], "text", model), {"ads": ad}, config={"model": model})
    runner.step("embed_occupations", lambda s, i, c: providers.embedded(i["occupations"], "text", model), {"occupations": occ}, config={"model": model})
    runner.step("candidates", lambda s, i, c: vectors.cosine_topk(i["embed_ads"].withColumnRenamed("id", "ad_id"), i["embed_occupations"].withColumnRenamed("id", "onet_code"), c["k"]), after=("embed_ads", "embed_occupations"), config={"k": config.get("k", 20)})

    def kept(s, i, c):
        listed = i["candidates"].join(occupations.select("onet_code", "title"), "onet_code").groupBy("ad_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "title"))), lambda x: x["title"]).alias("titles"))
        prompts = ad.join(listed, F.col("id") == F.col("ad_id")).select("id", F.concat("text", F.lit("\n"), text.numbered(F.col("titles"))).alias("prompt"))
        said = providers.generated(prompts, "prompt", model).withColumnRenamed("id", "ad_id")
        return matching.split_by_response(i["candidates"], said)[0]

    runner.step("filtered", kept, after=("candidates",), config={"model": model})

    def scored(s, i, c):
        pairs = i["filtered"].join(ad.select(F.col("id").alias("ad_id"), F.col("text").alias("query")), "ad_id").join(occ.select(F.col("id").alias("onet_code"), F.col("text").alias("document")), "onet_code")
        return matching.reranked(i["filtered"], providers.pair_scores(pairs, model))

    runner.step("reranked", scored, after=("filtered",), config={"model": model})
    temperature = config.get("temperature", 0.7)
    return runner.step("exposure", lambda s, i, c: exposure.all_ads(ads.select(F.col("id").alias("ad_id")), exposure.ad_exposure(i["reranked"], scores, c["temperature"])), after=("reranked",), config={"temperature": temperature})
