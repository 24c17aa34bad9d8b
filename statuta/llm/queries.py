"""The queries of the training-text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import audio, chat, decontaminate, html_text, line_dedup, mixing, ngram_join, quality, span_dedup, token_count
from .common import read


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps."""
    return quality.select(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated chunks of lines."""
    return line_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix(read(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle set size and near-duplicate component of every document."""
    return ngram_join.join(read(spark, sf_dir, "documents"))


def op1_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    import public_tokenizers

    return token_count.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(read(spark, sf_dir, "pages"))


def op5_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, feature tensors and time spans of every document's bytes, stored and read back as sound; not the sounds themselves."""
    return audio.describe(read(spark, sf_dir, "documents"), media=False)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of the conversations as linked, validated and ordered tool use."""
    tools = spark.createDataFrame(chat.TOOLS, f"name string, params {chat.PARAMS}")
    return chat.link(chat.parse(chat.as_messages(read(spark, sf_dir, "conversations"))), tools)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they hold."""
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated spans of sentences."""
    return span_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_count": op1_token_count,
    "op2_decontaminate": op2_decontaminate,
    "op3_mixing": op3_mixing,
    "op4_html_text": op4_html_text,
    "op5_audio": op5_audio,
    "op6_line_dedup": op6_line_dedup,
    "op7_chat": op7_chat,
    "op8_quality": op8_quality,
    "op9_ngram_join": op9_ngram_join,
    "op10_span_dedup": op10_span_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op3_mixing": mixing.ORACLE,
    "op6_line_dedup": line_dedup.ORACLE,
    "op7_chat": chat.ORACLE,
    "op10_span_dedup": span_dedup.ORACLE,
}
