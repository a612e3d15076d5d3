"""One query per operator over the given tables, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import (
    counts, decontaminate, infilling, pieces, pii, quality, resample, sharding, simhash, substring, tokenids, topk, urls,
)
from shelfmark.llm.common import table
from shelfmark.llm.oracles import ORACLES

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORD_VOCABULARY = 49_408
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2

URL_RULES = (
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removal_report(table(spark, sf_dir, "documents"))


def op2_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), quality.held_back)
    return quality.scored(docs, model).select(
        "doc_id", quality.held_back(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_topk_nra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_scores(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_decontaminate_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenids.token_report(table(spark, sf_dir, "documents"), WORD_TOKENIZER, END_ID, WORD_VOCABULARY)


def op7_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged_pages(
        table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES
    ).select("page_id", "host", "path", "rule", "verdict")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_report(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_report(table(spark, sf_dir, "documents"), pieces.Vocabulary.of_model(PIECE_MODEL))


def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_report(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, counts.own_cache(spark, "token-counts"))


def op12_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infilling.infilling_report(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_quality_nbsvm, op3_topk_nra, op4_decontaminate_fm_index, op5_simhash_near_dedup,
        op6_token_files, op7_url_reputation, op8_personal_data, op9_sentencepiece, op10_byte_shards,
        op11_token_counts, op12_infilling, op13_importance_resampling,
    )
}

__all__ = ["ORACLES", "QUERIES"]
