"""From raw documents to piece ids: judge, deduplicate, decontaminate, redact, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes a stage's
result as Parquet to the shared folder and reads it back as the next stage's input, so a
lost executor costs at most one stage's tasks. All stages but the last keep the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm import decontaminate, pieces, pii, quality, simhash
from shelfmark.llm.common import saved, table
from shelfmark.llm.queries import PIECE_MODEL


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars, where the table has it, follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the classifier rejects go."""
    return quality.of_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels"), quality.held_back))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id."""
    return simhash.without_near_duplicates(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts."""
    return _with_length(decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark")))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers, plain or disguised, give way to their kind."""
    return _with_length(pii.without_personal_data(docs))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text as piece ids, beside the other columns."""
    return pieces.encoded(docs, pieces.Vocabulary.of_model(PIECE_MODEL))


STAGES = [
    ("judge_quality", judge_quality),
    ("drop_near_duplicates", drop_near_duplicates),
    ("cut_benchmark", cut_benchmark),
    ("redact_personal_data", redact_personal_data),
    ("encode_pieces", encode_pieces),
]

# Fingerprint components, a trained classifier and Viterbi paths are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
