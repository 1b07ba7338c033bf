"""Connected components of a graph whose nodes are 64-bit values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import attach


def _with_least(pairs: DataFrame, label: str) -> DataFrame:
    """Each (u, v) with the least of u and the values paired with u."""
    pairs = materialize(pairs, label)
    total = pairs.count()
    least = pairs.groupBy("u").agg(F.min("v").alias("least"), F.count("*").alias("n"))
    least = materialize(
        least.select("u", F.least("u", "least").alias("least"), "n"), f"{label}-least"
    )
    return attach(pairs, least, "u", "n", total, F.xxhash64("u", "v"))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``); root is the least node reachable.

    Large-star and small-star steps in turn, until a round changes nothing: the first links
    every larger neighbour of a node to the least one around it, the second does so with the
    smaller neighbours. Each round is written to shared storage. Nulls and loops link nothing;
    repeated edges and an empty table are fine. A node with very many edges is never gathered.
    """
    links = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")
    )
    links = materialize(links.distinct(), label)
    seen = None
    while True:
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, f"{label}-large").filter("v > u")
        large = large.select(F.col("least").alias("u"), "v").filter("u <> v").distinct()
        small = _with_least(large.select(F.col("v").alias("u"), F.col("u").alias("v")), f"{label}-small")
        # here u is the larger end and v one of its smaller neighbours
        moved = small.select(F.explode(F.array(
            F.struct(F.col("least").alias("u"), "v"),
            F.struct(F.col("least").alias("u"), F.col("u").alias("v")),
        )).alias("e")).select("e.u", "e.v")
        links = materialize(moved.filter("u <> v").distinct(), label)
        now = links.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
        ).first()
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("u").alias("root")).distinct()
    return links.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        roots.select(F.col("root").alias("node"), "root")
    )
