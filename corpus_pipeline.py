"""The corpus pipeline: language ID, quality rules, SimHash near-dedup, mixing, BPE encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet to the shared folder
and rereads for the next stage. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profitlens.llm._common import fold, read, staged
from profitlens.session import drop_staged

LANG_DIMS = 2048       # an unrelated text has a cosine of about 0 +- 1 / sqrt(LANG_DIMS) with a language
NOISE_Z = 3.5          # documents whose cosine with the nearest language is below so many of these are rejected,
LOW_QUANTILE, LOW_SHARE = 0.001, 0.5  # or below this share of the low quantile of the language's own documents


def lang_limits(docs: DataFrame, profiles: dict[str, list]) -> dict[str, float]:
    """The smallest cosine that a document of each language needs: LOW_SHARE of the LOW_QUANTILE of its own documents'
    cosines, and never less than the noise of unrelated texts."""
    from profitlens.llm.langid import predict_language

    noise = NOISE_Z / LANG_DIMS**0.5
    own = predict_language(docs, [F.col("lang").cast("string").alias("own")], "text", profiles, LANG_DIMS)
    low = (own.where(F.col("own") == F.col("lang_pred")).groupBy("lang_pred")
           .agg(F.percentile_approx("score", LOW_QUANTILE, 10_000).alias("q")).collect())  # a row for each language
    return {n: noise for n in profiles} | {r.lang_pred: max(noise, LOW_SHARE * r.q) for r in low}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Profiles are learned from the texts and languages that the documents have (those of the training folds). A
    document goes if no language is found (``und``) or its cosine with the nearest is below the language's limit, which
    the cosines of the training folds give (see lang_limits); lang becomes the predicted language."""
    from profitlens.llm.langid import learn_profiles, predict_language

    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    profiles = learn_profiles(docs.where(~held_out), "text", "lang", LANG_DIMS)
    limits = lang_limits(docs.where(~held_out), profiles)
    found = predict_language(docs, [F.struct(*docs.columns).alias("doc")], "text", profiles, LANG_DIMS)
    limit = F.create_map(*[F.lit(v) for pair in limits.items() for v in pair])[F.col("lang_pred")] if limits else F.lit(1.0)
    found = found.where((F.col("lang_pred") != "und") & (F.col("score") >= limit))
    return found.select(*[F.col("lang_pred").alias("lang") if c == "lang" else F.col(f"doc.`{c}`") for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines that are frequent on a source are taken out of the others, n_chars follows."""
    from profitlens.llm.quality_rules import apply_line_rules

    kept = apply_line_rules(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group stays."""
    from profitlens.llm.simhash import keep_one

    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the production mix, a row for each epoch."""
    from profitlens.llm.mixing import apply_mix

    return apply_mix(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the token ids, and the digests of the ids and of the bytes they decode to."""
    import public_tokenizers

    from profitlens.llm.bpe import bpe_decode, bpe_encode, digests
    from profitlens.llm.queries import RANK_FILE

    ranks, pattern = public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    ids = bpe_encode(docs.select("doc_id", "lang", "source", "text"), "text", ranks, pattern).drop("text")
    both = bpe_decode(ids, "token_ids", ranks, pattern)
    return digests(both, keep=["lang", "source", "token_ids"])


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("mixing", mixing),
    ("bpe", bpe_tokens),
]

# No stage before the last is expressible in SQL (learned profiles, XXH64): tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of a folder. A stage's table is deleted once the next one is written."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        done = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if i:
            drop_staged(docs)
        docs = done
    return docs
