"""The corpus queries, one for each operator, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketlens.llm.collocations import COLLOCATION_SQL, collocations
from basketlens.llm.common import read_table
from basketlens.llm.decontamination import CONTAMINATION_SQL, contamination_report
from basketlens.llm.embedding_whitening import whitening_report
from basketlens.llm.fingerprints import fingerprint_report
from basketlens.llm.language import predict_language
from basketlens.llm.near_dedup import near_duplicate_classes
from basketlens.llm.pii import pii_report
from basketlens.llm.quality import quality_scores
from basketlens.llm.sentencepiece_viterbi import encode_and_verify
from basketlens.llm.suffix_dedup import suffix_dedup_report
from basketlens.llm.token_counts import counts_with_sample_edits
from basketlens.llm.toxicity import toxicity_scores
from basketlens.llm.warc_archive import ARCHIVE_SQL, archive_report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return put


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_with_sample_edits(_documents(spark, sf_dir))


@query("op2_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(_documents(spark, sf_dir))


@query("op3_minhash_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(_documents(spark, sf_dir))


@query("op4_decontamination", CONTAMINATION_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


@query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_language(_documents(spark, sf_dir))


@query("op8_suffix_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup_report(_documents(spark, sf_dir))


@query("op9_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(_documents(spark, sf_dir))


@query("op10_sentencepiece")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_verify(_documents(spark, sf_dir))


@query("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_report(read_table(spark, sf_dir, "embeddings"))


@query("op12_warc_chunks", ARCHIVE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(read_table(spark, sf_dir, "pages"))


@query("op13_collocations", COLLOCATION_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_documents(spark, sf_dir))
