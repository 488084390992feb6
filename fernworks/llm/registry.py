"""The queries of this subpackage, and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, compression, jaccard, lm, mixing, packing, spelling, token_counts, topk, toxicity, url_filter, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    out = bpe.encode_decode(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    out = token_counts.token_counts(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > 512)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document, where they are packed, and the digest of their ids."""
    out = packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "context", "step")


QUERIES = {f.__name__: f for f in (jaccard.op1_ngram_jaccard, op2_bpe_encode_decode, mixing.op3_mixing, lm.op4_lm_scoring, warc.op5_warc_revisits, topk.op6_exact_topk, url_filter.op7_url_filter, op8_token_counts, ann.op9_ann, toxicity.op10_toxicity, op11_packing, spelling.op12_spelling_variants, compression.op13_vector_codes)}

SQL: dict[str, str] = {"op1_ngram_jaccard": jaccard.SQL, "op3_mixing": mixing.SQL, "op5_warc_revisits": warc.SQL, "op6_exact_topk": topk.SQL, "op7_url_filter": url_filter.SQL, "op12_spelling_variants": spelling.SQL, "op13_vector_codes": compression.SQL}
