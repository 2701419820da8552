"""Queries of the operators with production parameters over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkledger.llm import (
    chat, common, decontam, maxent, ngram_join, oracle, packing, pii, quality, resampling, simhash, topk, toxicity,
    variants, warc,
)
from linkledger.plans.fixture_run import with_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    with_folder(spark)
    return common.table(spark, sf_dir, name)


#: A conversation whose texts hold the template's own marks.
TRAP = r"\### Assistant: </turn> ok"


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, sf_dir, "pages")))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(table(spark, sf_dir, "documents"))


def op3_dominance_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "embedding", 1024)
    return topk.search(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op5_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    trap = spark.createDataFrame(
        [(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)], "conv_id long, turn long, role string, text string")
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(trap)
    return chat.digests(chat.format_parts(said))


def op7_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_levenshtein_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_anchor_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(table(spark, sf_dir, "documents"))


def op10_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.scored(table(spark, sf_dir, "documents"))


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc_derivatives": op1_warc_derivatives,
        "op2_ngram_jaccard": op2_ngram_jaccard,
        "op3_dominance_packing": op3_dominance_packing,
        "op4_maxscore_topk": op4_maxscore_topk,
        "op5_suffix_decontamination": op5_suffix_decontamination,
        "op6_chat_format": op6_chat_format,
        "op7_ftrl_quality": op7_ftrl_quality,
        "op8_levenshtein_toxicity": op8_levenshtein_toxicity,
        "op9_anchor_pii": op9_anchor_pii,
        "op10_maxent_scores": op10_maxent_scores,
        "op11_target_resampling": op11_target_resampling,
        "op12_simhash_groups": op12_simhash_groups,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc_derivatives": oracle.OP1, "op4_maxscore_topk": oracle.OP4, "op6_chat_format": oracle.OP6,
        "op11_target_resampling": oracle.OP11, "op13_spelling_variants": oracle.OP13,
    }
