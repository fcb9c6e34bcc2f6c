"""Registered queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .context_mixing import learn_model, score_texts
from .decontamination import SQL as DECONTAMINATION_SQL
from .decontamination import find_leaks
from .embedding_dedup import near_copies
from .fill_in_middle import SQL as FILL_IN_MIDDLE_SQL
from .fill_in_middle import digest as fill_in_middle_digest
from .jaccard_join import SQL as JACCARD_SQL
from .jaccard_join import jaccard_components
from .language_id import learn_languages, predict_languages
from .license_scan import scan_licenses
from .line_dedup import SQL as LINE_DEDUP_SQL
from .line_dedup import drop_boilerplate
from .personal_data import find_personal_data
from .prefix_trie import SQL as PREFIX_TRIE_SQL
from .prefix_trie import rebuilt_trie
from .quality import predict_quality
from .token_counts import count_tokens
from .unigram_pieces import digest

Query = Callable[[SparkSession, str], DataFrame]


def op1_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score_texts(docs, learn_model(docs))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return predict_languages(docs, learn_languages(docs))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_boilerplate(table(spark, folder, "documents").select("doc_id", "source", "text"), counts=True).drop("source")


def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "embeddings"))


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return digest(table(spark, folder, "documents"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"))


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal_data(table(spark, folder, "documents"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return predict_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_in_middle_digest(table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return rebuilt_trie(table(spark, folder, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_context_mixing": op1_context_mixing,
    "op2_language_id": op2_language_id,
    "op3_decontamination": op3_decontamination,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_line_dedup": op5_line_dedup,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_token_counts": op8_token_counts,
    "op9_personal_data": op9_personal_data,
    "op10_quality": op10_quality,
    "op11_license_scan": op11_license_scan,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": DECONTAMINATION_SQL,
    "op4_jaccard_join": JACCARD_SQL,
    "op5_line_dedup": LINE_DEDUP_SQL,
    "op12_fill_in_middle": FILL_IN_MIDDLE_SQL,
    "op13_prefix_trie": PREFIX_TRIE_SQL,
}
