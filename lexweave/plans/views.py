"""The given tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.token_tables import story_offsets, story_tokens, token_offsets
from ..operators.vocabulary import Vocabulary
from ..session import materialize
from ..sources.corpus import read_documents
from ..streaming.ingest import read_document_stream

NEWLINE_ID = 202


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, f"{sf_dir}/documents.parquet")


def document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as a stream, whether it is one file or a folder of part files.

    The pattern matches that one name; Spark then lists a folder and takes a file as it is.
    """
    return read_document_stream(spark, f"{sf_dir}/documents.[p]arquet")


def dealt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dealt to as many tasks as a shuffle has, for queries with heavy work a row."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_documents(spark, f"{sf_dir}/documents.parquet", partitions=parts)


def instruction_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the turn before as input and the assistant's answer as output."""
    turns = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.lead("role").over(turns).alias("next_role"),
        F.lead("text").over(turns).alias("next_text"),
        F.lag("text").over(turns).alias("prev_text"),
    )
    return rows.filter(F.col("role") == "user").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("rec_id"),
        F.col("text").alias("instruction"),
        F.coalesce("prev_text", F.lit("")).alias("input"),
        F.when(F.col("next_role") == "assistant", F.col("next_text")).otherwise("").alias("output"),
    )


def choice_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per document: its text, its last words as choices, by language group."""
    last = F.substring_index(F.regexp_replace("text", r"[ \n]+", " "), " ", -4)
    # made by explode, so filters on the choices do not make them again
    choices = F.explode(F.array(F.split(last, " "))).alias("choices")
    return dealt_documents(spark, sf_dir).select("doc_id", "text", "lang", choices).select(
        F.col("doc_id").alias("idx"),
        F.col("text").alias("question"),
        F.concat("lang", F.lit("_grp_"), (F.col("doc_id") % 3).cast("string")).alias("subject"),
        "choices",
        F.expr("cast((doc_id div 3) % 4 as int)").alias("answer"),
        F.when(F.expr("(doc_id div 7) % 5 = 0"), "dev").otherwise("test").alias("split"),
    )


def pseudo_scores(index: Column, salt: int = 0) -> Column:
    """Arithmetic label scores both engines compute alike."""
    def score(label: int) -> Column:
        mixed = index * 7919 + (label + 1) * (104729 + salt) + index * (label * 31)
        return (mixed % 1009 + 1) / F.lit(100.0) * F.lit(-1.0)

    return F.array(*[score(l) for l in range(4)])


_streams: dict[tuple[str, str], DataFrame] = {}


def story_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-token stream of the exported corpus: ``doc_id, ids, n_tokens, start_pos``.

    Written once per session and folder, like a token cache; readers take the columns
    they need.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _streams:
        _streams[key] = materialize(story_offsets(documents(spark, sf_dir), Vocabulary()), "story-stream")
    return _streams[key]


def byte_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of the same stream without token arrays, from lengths stored first."""
    lengths = story_tokens(documents(spark, sf_dir), Vocabulary()).drop("ids")
    return token_offsets(materialize(lengths, "story-lengths"))
