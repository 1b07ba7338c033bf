"""Shards of equal row counts that all match the mixture of sources."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import attach, ranked

SHARDS = 40
SEED = 17


def seeded(key: Column, seed: int) -> Column:
    """A pseudo-random order of keys that any engine can repeat."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))


def interleave(rows: DataFrame, stratum: str, key: str, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Adds ``shard`` and ``slot``: proportional stratified interleaving.

    Rows are ranked within their stratum in seeded order; sorting all rows by the fractional
    rank ``(rank + 1/2) / stratum size`` spreads every stratum evenly, and the sorted sequence
    is cut into ``shards`` runs whose lengths differ by one at most. Within a run ``slot``
    counts from zero. Null strata are a stratum, null keys are ordered as one key, repeated
    rows are interchangeable. No stratum is gathered: both rankings are range-partitioned.
    """
    n = rows.count()
    order = [F.col(stratum), F.col("_seeded"), F.col(key), *[F.col(c) for c in rows.columns if c not in (stratum, key)]]
    first = ranked(rows.withColumn("_seeded", seeded(F.col(key), seed)), order, "shard-strata", "_rank")
    # null is a stratum of its own, apart from a source of that name
    name = F.coalesce(F.concat(F.lit("{"), F.col(stratum).cast("string"), F.lit("}")), F.lit("null"))
    first = materialize(first.withColumn("_stratum", name), "shard-ranked")
    sizes = first.groupBy("_stratum").agg(F.min("_rank").alias("_first"), F.count("*").alias("_size"))
    sizes = materialize(sizes.withColumn("_n", F.col("_size")), "shard-sizes")
    placed = attach(first, sizes, "_stratum", "_n", n, F.col("_rank"))
    share = ((F.col("_rank") - F.col("_first")) * 2 + 1) / (F.col("_size") * 2)
    placed = placed.withColumn("_share", share.cast("double"))
    by = [F.col("_share"), F.col("_stratum"), F.col("_rank")]
    place = ranked(placed.drop("_first", "_size"), by, "shard-places", "_place")
    shard = F.expr(f"(_place * {shards}) div {max(n, 1)}")
    start = F.expr(f"(_shard * {n} + {shards - 1}) div {shards}")
    placed = place.withColumn("_shard", shard).withColumn("_slot", F.col("_place") - start)
    return placed.select(
        *rows.columns, F.col("_shard").cast("int").alias("shard"), F.col("_slot").cast("long").alias("slot")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, key: str = "doc_id",
                    text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, size, text_crc32, source, law, shard, slot, grown_shard`` of every document.

    Only these few values are sorted, not the texts. ``write_shards`` puts the texts in place.
    """
    light = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.col(source).alias("source"),
    )
    return interleave(light, "source", "doc_id", shards, seed).select(
        "doc_id", "size", "text_crc32", "source", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, places: DataFrame, path: str, key: str = "doc_id") -> None:
    """Writes documents under ``shard=...`` folders, sorted by slot; needs unique keys."""
    named = places.select(F.col("doc_id").alias("_key"), "shard", "slot")
    rows = docs.join(named, docs[key] == named["_key"]).drop("_key")
    rows = rows.repartition("shard", F.expr("slot div 100000"))
    rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
