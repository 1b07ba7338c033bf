"""Writers. Data is checked before anything is written, goes to a fresh folder and is
published by adding a manifest row, so readers never see half of it and a failed run
leaves the published version as it was."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from ..constants import REPORT_NOTE, REPORT_SETTINGS, REPORT_TITLE
from .corpus import require_corpus
from ..functions.text import code_fence, is_blank, line_chunk, normalize_text, story_chunk

MANIFEST_SCHEMA = (
    "version BIGINT, path STRING, records BIGINT, size BIGINT, published_at TIMESTAMP"
)


# --- row shapes ------------------------------------------------------------------


def story_rows(df: DataFrame, order: str, text: str = "text") -> DataFrame:
    """``order, chunk, n_chars``: non-empty stories with their end marker."""
    norm = df.filter(~is_blank(F.col(text))).select(order, normalize_text(F.col(text)).alias("__n"))
    return norm.select(order, story_chunk(F.col("__n")).alias("chunk")).withColumn(
        "n_chars", F.length("chunk").cast("bigint")
    )


def line_rows(df: DataFrame, order: str, text: str = "text") -> DataFrame:
    """``order, chunk, n_chars``: raw rows, each ended by one newline."""
    return df.select(order, line_chunk(F.col(text)).alias("chunk")).withColumn(
        "n_chars", F.length("chunk").cast("bigint")
    )


def json_rows(df: DataFrame, order: str, *fields: str) -> DataFrame:
    """``order, json, n_bytes``: one compact JSON object per record."""
    rows = df.select(order, F.to_json(F.struct(*fields)).alias("json"))
    return rows.withColumn("n_bytes", F.octet_length("json").cast("bigint"))


def markdown_sections(df: DataFrame, order: str, *keys: str) -> DataFrame:
    """One Markdown section per sample (``id, sample, seed, prompt, input, output``)."""

    def block(title: str, text: Column) -> Column:
        return F.concat(F.lit(f"{title}:\n\n"), code_fence(text), F.lit("\n\n"))

    heading = F.concat(
        F.lit("## "), F.col("id"), F.lit(" (sample "), F.col("sample").cast("string"),
        F.lit(", seed "), F.col("seed").cast("string"), F.lit(")\n\n"),
    )
    shown_input = F.when(F.length("input") > 0, block("Input", F.col("input"))).otherwise("")
    return df.select(
        *keys,
        order,
        F.concat(
            heading, block("Prompt", F.col("prompt")), shown_input,
            block("Model output", F.col("output")),
        ).alias("section"),
    )


def markdown_header(settings: dict[str, object]) -> str:
    """Opening of a sample report, with every setting of ``REPORT_SETTINGS``."""
    listed = "\n".join(f"- {name}: `{settings[name]}`" for name in REPORT_SETTINGS)
    return f"{REPORT_TITLE}\n\n{listed}\n\n{REPORT_NOTE}\n\n"


def _chunk_body() -> Column:
    return F.substring(F.col("chunk"), F.lit(1), F.length("chunk") - 1)


# --- publishing ------------------------------------------------------------------


def current_version(spark: SparkSession, base: str) -> dict | None:
    """Newest manifest row of a published table, or nothing."""
    try:
        rows = (
            spark.read.schema(MANIFEST_SCHEMA).json(f"{base}/manifest")
            .orderBy(F.desc("version")).limit(1).collect()
        )
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None
    return rows[0].asDict() if rows else None


def publish(
    df: DataFrame, base: str, sizes: Column, save, empty: str, order: str | None = None
) -> tuple[int, int]:
    """Write ``df`` with ``save(df, path)`` and publish it; returns (records, size).

    With ``order`` the files are range partitions by that column, sorted inside each.
    Counts are taken after that exchange, which reads its input twice.
    """
    spark = df.sparkSession
    if df.isEmpty():
        raise ValueError(empty)
    if order is not None:
        df = df.repartitionByRange(F.col(order)).sortWithinPartitions(order)
    seen = Observation(f"written-{uuid.uuid4().hex[:8]}")
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(sizes).alias("size"))
    path = f"{base}/data-{uuid.uuid4().hex}"
    save(counted, path)
    records, size = seen.get["n"], seen.get["size"] or 0
    last = current_version(spark, base)
    version = (last["version"] if last else 0) + 1
    row = spark.createDataFrame(
        [(version, path, int(records), int(size))],
        "version BIGINT, path STRING, records BIGINT, size BIGINT",
    ).withColumn("published_at", F.current_timestamp())
    row.coalesce(1).write.mode("append").json(f"{base}/manifest")
    return int(records), int(size)


def _save_text(body: Column):
    """Text files of ``body``, a row without its last newline, which the writer adds."""
    return lambda df, path: df.select(body.alias("value")).write.text(path)


def write_stories(df: DataFrame, base: str, order: str, text: str = "text") -> tuple[int, int]:
    """Publish a story corpus; returns (stories, characters)."""
    rows = story_rows(require_corpus(df, text), order, text)
    return publish(
        rows, base, F.col("n_chars"), _save_text(_chunk_body()), "input corpus is empty", order
    )


def write_text_lines(df: DataFrame, base: str, order: str, text: str = "text") -> tuple[int, int]:
    """Publish raw lines, empty ones included; returns (lines, characters)."""
    rows = line_rows(df, order, text)
    return publish(
        rows, base, F.col("n_chars"), _save_text(_chunk_body()), "input text records are empty", order
    )


def write_json_records(
    df: DataFrame, base: str, order: str, fields: list[str], validate=None
) -> tuple[int, int]:
    """Validate, then publish JSON lines; returns (records, bytes).

    ``validate`` is any function that takes the table and raises on a bad one.
    """
    if validate is not None:
        validate(df)
    rows = json_rows(df, order, *fields)
    return publish(
        rows, base, F.col("n_bytes") + 1, _save_text(F.col("json")), "input records are empty", order
    )


def write_sample_report(
    df: DataFrame, base: str, order: str, settings: dict[str, object]
) -> tuple[int, int]:
    """Publish the Markdown report: settings first, then one section per sample in order."""
    sections = markdown_sections(df, order).select(
        F.col(order).cast("bigint").alias("ord"),
        F.concat(F.lit("\n"), F.substring(F.col("section"), F.lit(1), F.length("section") - 2)).alias("body"),
    )
    opening = df.sparkSession.createDataFrame(
        [(-(1 << 62), markdown_header(settings).rstrip("\n"))], "ord BIGINT, body STRING"
    )
    return publish(
        opening.unionByName(sections), base, F.length("body") + 1, _save_text(F.col("body")),
        "no samples", "ord",
    )


def write_table(df: DataFrame, base: str, sizes: Column, empty: str) -> tuple[int, int]:
    """Publish a Parquet table under the same rules."""
    return publish(df, base, sizes, lambda d, path: d.write.parquet(path), empty)


def read_published(spark: SparkSession, base: str, fmt: str = "text") -> DataFrame:
    version = current_version(spark, base)
    if version is None:
        raise FileNotFoundError(f"nothing published under {base}")
    return spark.read.format(fmt).load(version["path"])
