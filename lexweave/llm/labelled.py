"""Labelled training rows, bounded, and the fold that is never learned from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Labelled rows a classifier learns from, at most about this many; drawn by hash.
TRAINING_ROWS = 50_000
HELD_OUT = 2


def fold(key: Column | str) -> Column:
    """0 to 3 by CRC-32 of the key as text; null for a null key."""
    return F.crc32((F.col(key) if isinstance(key, str) else key).cast("string").cast("binary")) % 4


def held_out(key: Column | str) -> Column:
    return F.coalesce(fold(key) == HELD_OUT, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, bound: int = TRAINING_ROWS,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """``fold, text, label`` of labelled documents outside the held-out fold.

    Null keys and labels are left out; a key labelled more than once counts as 1 if any label
    is 1. Beyond ``bound`` labels a share is drawn by a hash of the key, which keeps about
    ``bound`` of them: the sample is sent to the tasks, so documents are not shuffled.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key))
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(F.col(label)).cast("int").alias("label"))
    share = min(1.0, bound / max(known.count(), 1))
    drawn = F.shiftrightunsigned(F.xxhash64("_key", F.lit(5)), 11) < int(share * (1 << 53))
    known = known.filter(drawn).filter(F.col("label").isin(0, 1))
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.join(F.broadcast(known), "_key").select(fold("_key").alias("fold"), "text", "label")
