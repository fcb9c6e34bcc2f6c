"""Corpus pipeline: from the table documents to encoded training text.

Each stage takes what its predecessor kept, as a written table, and decides on that alone: documents of poor quality go,
lines that are boilerplate of their source go, one document of each group of near copies stays, documents that hold a
benchmark item go, and the texts are encoded. A later run continues nothing: every stage is written anew.

Quality is learned from labels, and pieces come from a model file, so there is no SQL for the whole; each stage is
tested against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm.common import staged, table, unused
from folioframe.llm.decontamination import without_leaks
from folioframe.llm.jaccard_join import one_of_each
from folioframe.llm.line_dedup import drop_boilerplate
from folioframe.llm.quality import THRESHOLD, fit_quality, score_quality
from folioframe.llm.unigram_pieces import encode


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts."""
    model, score = fit_quality(docs, table(spark, sf_dir, "labels")), unused(docs, "score")
    return score_quality(docs, model, score).filter(F.col(score) >= THRESHOLD).drop(score)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source; n_chars follows the text. Copies of a document count
    as one page, so that its body is still there when the next stage chooses among them."""
    return drop_boilerplate(docs, copies_once=True).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of linked documents."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their piece ids, and whether decoding gives the text back."""
    return encode(docs, check="restored")


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("sentencepiece", pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
