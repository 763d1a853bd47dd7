"""Registered queries of the operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profitlens.llm._common import fold, read
from profitlens.llm.oracle import ORACLE_SQL  # noqa: F401

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def held_out(doc_id):
    """Rows whose labels are never learned from; those with a null id are none of them."""
    return F.coalesce(fold(doc_id, 5) == 0, F.lit(False))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profitlens.llm.mixing import mix_documents

    return mix_documents(read(spark, sf_dir, "documents"))


def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profitlens.llm.nn_descent import nearest

    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from profitlens.llm.bpe import bpe_decode, bpe_encode, digests

    ranks, pattern = public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe_encode(docs, "text", ranks, pattern).drop("text")
    return digests(bpe_decode(ids, "token_ids", ranks, pattern))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profitlens.llm.langid import learn_profiles, predict_language

    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    profiles = learn_profiles(docs.where(~F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))), "text", "lang")
    return predict_language(docs, ["doc_id", out], "text", profiles)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profitlens.llm.simhash import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profitlens.llm.quality_rules import line_frequency_rules

    return line_frequency_rules(read(spark, sf_dir, "documents")).drop("removed_lines", "text_key")


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/")]


def op5_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profitlens.llm.url_templates import judge_urls

    return judge_urls(read(spark, sf_dir, "pages"), URL_RULES)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profitlens.llm.sharding import shard_documents

    return shard_documents(read(spark, sf_dir, "documents"), shards=16)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profitlens.llm.toxicity import learn_toxicity, score_toxicity

    docs, out = read(spark, sf_dir, "documents"), held_out(F.col("doc_id"))
    model = learn_toxicity(docs, read(spark, sf_dir, "labels"), lambda doc_id: ~held_out(doc_id))
    scored = score_toxicity(docs, ["doc_id", out.alias("held_out")], "text", model)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profitlens.llm.quality_model import learn_quality, score_quality

    docs, out = read(spark, sf_dir, "documents"), held_out(F.col("doc_id"))
    model = learn_quality(docs, read(spark, sf_dir, "labels"), lambda doc_id: ~held_out(doc_id))
    scored = score_quality(docs, ["doc_id", out.alias("held_out")], "text", model)
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profitlens.llm.resampling import resample

    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), percent=5).drop("n_words")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profitlens.llm.decontaminate import benchmark_hits

    found = benchmark_hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from profitlens.llm.search import ranked_search

    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)
}
