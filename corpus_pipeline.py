"""From raw documents to token ids: filter, deduplicate, decontaminate, redact, encode.

Each stage reads what the one before has written. All but the last return the columns of
``documents``; the last returns doc_id, ids and n_ids of every document that is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.common import free_name, read_table
from basketlens.llm.decontamination import decontaminated
from basketlens.llm.near_dedup import without_near_duplicates
from basketlens.llm.pii import redacted
from basketlens.llm.quality import THRESHOLD, score_column, train
from basketlens.llm.sentencepiece_viterbi import encoded_rows
from basketlens.operators.staging import staged

#: SQL can express neither the classifier nor the near-duplicates nor the encoding.
ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = train(docs, read_table(spark, sf_dir, "labels"))
    score = free_name(docs, "__score")
    return docs.withColumn(score, score_column(model, F.col("text"))).where(F.col(score) >= THRESHOLD).drop(score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced, and n_chars counted anew."""
    out = redacted(docs)
    if "n_chars" in out.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids."""
    return encoded_rows(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
