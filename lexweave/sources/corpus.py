"""Corpus readers: stories, raw lines, whole files, split tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import canonical_newlines, is_blank, normalize_text
from ..operators.ordering import first_rows

DOCUMENT_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


class EmptyCorpusError(ValueError):
    pass


def read_documents(
    spark: SparkSession, path: str, schema: str = DOCUMENT_SCHEMA, partitions: int | None = None
) -> DataFrame:
    """The documents table. ``partitions`` deals its rows out evenly by id, for work that costs
    far more a row than moving it; without it tasks follow the files.
    """
    rows = spark.read.schema(schema).parquet(path)
    return rows if partitions is None else rows.repartition(partitions, "doc_id")


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One record per file, keyed by its path."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("path"), F.col("value").alias("text")
    )


def read_split(
    spark: SparkSession, base: str, schema: str, *, split: str, config: str | None = None
) -> DataFrame:
    """One split of one configuration of ``base/config=…/split=…``; partitions are pruned."""
    table = spark.read.schema(f"{schema}, config STRING, split STRING").parquet(base)
    wanted = F.col("split") == split
    if config is not None:
        wanted = wanted & (F.col("config") == config)
    return table.filter(wanted).drop("config", "split")


def require_corpus(df: DataFrame, text: str = "text") -> DataFrame:
    """Fail on a corpus without a non-blank row; stops at the first row that has one."""
    if df.filter(~is_blank(F.col(text))).isEmpty():
        raise EmptyCorpusError("text corpus is empty")
    return df


def corpus_profile(df: DataFrame, *by: str) -> DataFrame:
    """Rows, characters and UTF-8 bytes per group."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n_docs"),
        F.sum(F.length("text")).alias("n_chars"),
        F.sum(F.octet_length("text")).cast("bigint").alias("n_bytes"),
    )


def non_empty_stories(df: DataFrame, text: str = "text") -> DataFrame:
    """Normalised stories; rows with nothing left are dropped."""
    return df.filter(~is_blank(F.col(text))).withColumn(text, normalize_text(F.col(text)))


def first_stories(df: DataFrame, max_stories: int, order: str = "doc_id") -> DataFrame:
    """The first ``max_stories`` non-empty stories in source order."""
    if max_stories <= 0:
        raise ValueError("max_stories must be positive")
    return first_rows(non_empty_stories(df), max_stories, order)


def raw_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """Raw rows with canonical newlines; empty rows stay."""
    return df.withColumn(text, canonical_newlines(F.col(text)))


def contains_text(df: DataFrame, needle: str, *by: str, text: str = "text") -> DataFrame:
    """How many rows hold ``needle``, and whether any does."""
    hit = F.contains(F.col(text), F.lit(needle))
    return df.groupBy(*by).agg(
        F.count("*").alias("n_docs"),
        F.count_if(hit).alias("n_hits"),
        F.coalesce(F.bool_or(hit), F.lit(False)).alias("found"),
    )


def require_markers(df: DataFrame, marker: str, text: str = "text") -> DataFrame:
    """Fail unless some row holds the end marker; stops at the first hit."""
    if df.filter(F.contains(F.col(text), F.lit(marker))).isEmpty():
        raise ValueError(f"training corpus has no {marker} story boundaries")
    return df


def ordered_limit(df: DataFrame, n: int, order: str) -> DataFrame:
    """First ``n`` rows in order, as a smoke-test prefix."""
    if n <= 0:
        raise ValueError("limit must be positive")
    return first_rows(df, n, order)
