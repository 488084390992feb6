"""The training-data pipeline: four stages over `documents`, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernworks.llm import bpe, jaccard, mixing, toxicity, words
from fernworks.llm.common import in_written_order, sorted_by_position, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on `labels`, does not score as toxic.

    Null and empty texts score 0 and stay; null and repeated ids and repeated rows are each judged by themselves; without
    toxic labels nothing goes. Columns of any name are carried.
    """
    model = toxicity.fit(*toxicity.training_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")  # columns may have any name
    return toxicity.tag(rows, model, keep=("row",)).filter(F.col("score") < toxicity.THRESHOLD).select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of the smallest id (null: last; equal ids by a digest of the text).

    Texts without words, null among them, are in no class and stay; repeated rows are copies.
    """
    return jaccard.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as the mix takes it.

    Texts without words take nothing and go, as the mix has no use for them; null is a source of its own; ties in the
    order go by a hash of id and text.
    """
    return mixing.training_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of what they decode to and its place in the training order, in that order.

    Null texts are empty and have no ids; every row has its own result. Packs are half as large as the operator's, as the
    executors still hold what the stages before have left.
    """
    placed, n, files = in_written_order(docs, "doc_id", "lang", "source", "text")
    keep = ("position", "doc_id", "lang", "source")
    out = bpe.encode_decode(placed, public_tokenizers.path("word_bpe_49k.json"), keep=keep, pack_bytes=words.PACK_BYTES // 2)
    out = out.select(*keep, F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
    return sorted_by_position(out, n, files)


STAGES = [("toxicity", drop_toxic), ("n-gram Jaccard join", one_of_each), ("mixing sources to target weights", mix), ("BPE encoding and decoding", encode)]

#: SQL can express neither the classifier nor the tokenizer; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage{k}")
    return docs
