"""Streaming ingest: the batch normalisation over an unbounded input, appended exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.corpus import DOCUMENT_SCHEMA, non_empty_stories
from ..sources.records import broken_rules


def read_document_stream(
    spark: SparkSession,
    path: str,
    *,
    schema: str = DOCUMENT_SCHEMA,
    fmt: str = "parquet",
    pattern: str | None = None,
    files_per_trigger: int = 64,
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.format(fmt).load(path)


def start_story_ingest(
    stream: DataFrame, output: str, checkpoint: str, *, available_now: bool = True
) -> StreamingQuery:
    """Append normalised, non-empty stories; stateless, so no watermark is needed."""
    writer = (
        non_empty_stories(stream)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(output)


def start_checked_ingest(
    stream: DataFrame, output: str, rejects: str, checkpoint: str,
    rules: list[tuple[str, Column]], *, available_now: bool = True,
) -> StreamingQuery:
    """Stories that break no rule go to ``output``, the rest to ``rejects`` with ``rules``.

    Rules see rows as they arrive. Good rows are normalised and blank ones dropped, as in
    ``start_story_ingest``; rejects stay as they came. A batch owns the folder of its id in
    both tables and replaces it, so a batch that runs again leaves nothing twice. Both tables
    have a column ``batch_id``.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        checked = batch.withColumn("rules", broken_rules(rules))
        good = F.size("rules") == 0
        parts = (
            (output, non_empty_stories(checked.filter(good).drop("rules"))),
            (rejects, checked.filter(~good)),
        )
        for base, rows in parts:
            rows.write.mode("overwrite").parquet(f"{base}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ingest_progress(query: StreamingQuery) -> dict:
    """Batches and input rows so far."""
    steps = query.recentProgress
    return {
        "batches": len(steps),
        "input_rows": sum(step["numInputRows"] for step in steps),
    }
