"""Lookups by keys that a large share of the rows may hold, and of wide rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: The most frequent keys of a lookup, whose facts are sent to all tasks.
HOT_KEYS = 256


def lookup(rows: DataFrame, facts: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join of ``rows`` with one fact row per key, however the keys are spread.

    The facts of the HOT_KEYS most frequent keys are broadcast, so their rows stay where they
    are; no other key holds more than 1/HOT_KEYS of the rows that shuffle. ``rows`` is read
    twice, so give a stored table. Null keys find nothing.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    top = [r[0] for r in counts.orderBy(F.desc("n")).limit(HOT_KEYS).select(key).collect()]
    hot = F.coalesce(F.col(key).isin(top), F.lit(False))
    frequent = rows.filter(hot).join(F.broadcast(facts.filter(hot)), key, how)
    return frequent.unionByName(rows.filter(~hot).join(facts, key, how))


def with_facts(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Join of wide ``rows`` with narrow ``facts`` by a number that each row has to itself.

    The facts are hashed, so the rows are dealt out once and never sorted.
    """
    return rows.join(facts.hint("shuffle_hash"), key)
