"""Whole-number vectors of an embeddings table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def whole_vectors(rows: DataFrame, vector: str, scale: float, shift: int, out: str = "x") -> DataFrame:
    """Rows whose vector is whole, with entries ``floor(scale * c) + shift`` (long) as ``out``.

    Vectors that are null, empty or hold a null or non-finite entry go, and so do those of
    another length than most have (of equally many the longest). An entry beyond a long is an
    error.
    """
    entries = F.col(f"`{vector}`")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = rows.filter(entries.isNotNull() & ~F.coalesce(bad, F.lit(False)) & (F.size(entries) > 0))
    usual = whole.groupBy(F.size(entries).alias("k")).agg(F.count("*").alias("n"))
    usual = usual.orderBy(F.desc("n"), F.desc("k")).first()
    whole = whole.filter(F.size(entries) == (usual["k"] if usual else 0))
    return whole.withColumn(out, F.transform(entries, lambda c: _entry(c, scale, shift)))


def _entry(c: Column, scale: float, shift: int) -> Column:
    return F.floor(c.cast("double") * F.lit(float(scale))).cast("long") + F.lit(shift).cast("long")


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """The rows of a list array as a matrix of whole numbers."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(lists), dims)
