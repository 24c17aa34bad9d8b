"""A corpus pipeline of five stages, each on all rows that the one before it kept.

All stages but the last return the columns of documents. No stage drops a row for its length or for nulls, but the classifier
rejects texts without words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.llm import decontaminate, line_dedup, mixing, ngram_join, quality
from statuta.llm.common import drop, read, settled


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.filter_documents(docs, read(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go; n_chars follows the text, and a document that only repeats stays as an empty one."""
    n = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return line_dedup.dedup(docs).select(*(n.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of smallest doc_id stays."""
    return ngram_join.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document left."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", source_mix),
]

ORACLE_SQL: str | None = None  # no SQL for the classifier and the latent search: tests/llm holds brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over documents, each but the last written and read again; what isn't read any more is deleted."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        last, docs = docs, settled(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"stage{k}")
        drop(last)
    return STAGES[-1][1](spark, docs, sf_dir)
