"""Embedding whitening: exact scatter from bit planes, centred as integers before eigh."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize
from .vectors import matrix, whole_vectors

SCALE, SHIFT = 64.0, 1_000_000
COMPONENTS = 32
#: Rows that one set of bit planes packs.
PLANE_ROWS = 4096
#: Components with a smaller share of the largest eigenvalue are beyond double precision.
FLAT = 1e-10

_EXACT = pa.decimal128(38, 0)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per dimension of a task's rows: rows, least, largest and sum."""
    n, low, high, total = 0, None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        x = matrix(batch.column(0), len(batch.column(0)[0]))
        sums = [int(v) for v in x.sum(axis=0, dtype=object)] if np.abs(x).max() > 1 << 40 else x.sum(axis=0).tolist()
        n += len(x)
        low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
        high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        total = sums if total is None else [a + b for a, b in zip(total, sums)]
    if n:
        yield pa.record_batch(
            [pa.array(np.arange(len(low), dtype=np.int32)), pa.array(np.full(len(low), n, np.int64)), pa.array(low),
             pa.array(high), pa.array([Decimal(v) for v in total], _EXACT)],
            ["dim", "n", "low", "high", "total"],
        )


def planes(x: np.ndarray, low: np.ndarray, widths: list[int]) -> np.ndarray:
    """Bit planes of every dimension, lowest bit first, each packed across rows into 64-bit words."""
    rows = -(-len(x) // 64) * 64
    bits = np.zeros((sum(widths), rows), np.uint8)
    at = 0
    for dim, width in enumerate(widths):
        shifted = (x[:, dim] - low[dim]).astype(np.uint64)
        for b in range(width):
            bits[at, : len(x)] = (shifted >> np.uint64(b)) & np.uint64(1)
            at += 1
    return np.packbits(bits, axis=1).view(np.uint64)


def scatter(counts: np.ndarray, widths: list[int], rows: int) -> np.ndarray:
    """Exact cross-products of shifted dimensions from the AND-popcounts of their planes."""
    whole = counts + np.triu(counts, 1).T
    weights = np.zeros((len(counts), len(widths)), object)
    at = 0
    for dim, width in enumerate(widths):
        for b in range(width):
            weights[at, dim] = 1 << b
            at += 1
    if 2 * max(widths, default=0) + rows.bit_length() < 62:
        whole, weights = whole.astype(np.int64), weights.astype(np.int64)
    else:
        whole = whole.astype(object)
    return weights.T @ whole @ weights


def _products(low: np.ndarray, widths: list[int]):
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(widths)
        counts, rows = np.zeros((n, n), np.int64), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0), len(widths))
            rows += len(x)
            for at in range(0, len(x), PLANE_ROWS):
                p = planes(x[at : at + PLANE_ROWS], low, widths)
                for i in range(n):
                    counts[i, i:] += np.bitwise_count(p[i] & p[i:]).sum(axis=1, dtype=np.int64)
        if rows:
            made = scatter(counts, widths, rows)
            i, j = np.triu_indices(len(widths))
            yield pa.record_batch(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array([Decimal(int(v)) for v in made[i, j]], _EXACT)],
                ["i", "j", "product"],
            )

    return products


def _rebased(x: np.ndarray, low: np.ndarray, excess: list[int], n: int, reach: int) -> np.ndarray:
    """``n * x - S``, exact: whole numbers of 64 bits where they do, of any size elsewhere."""
    if n * reach < 1 << 62:
        return (x - low) * n - np.array(excess, np.int64)
    return (x - low).astype(object) * n - np.array(excess, object)


class _Fit:
    """What tasks need to whiten rows: bounded by the dimension, whatever the rows."""

    def __init__(self, n: int, low: list[int], high: list[int], total: list[int], products: np.ndarray, components: int):
        d = len(low)
        self.n, self.low = n, np.array(low, np.int64)
        self.excess = [t - n * b for t, b in zip(total, low)]  # n times mean minus least
        self.reach = max((h - b for h, b in zip(high, low)), default=0)
        s = np.array(self.excess, object)
        centred = n * products - s[:, None] * s[None, :]
        trace = sum(int(centred[k, k]) for k in range(d))
        # true division of whole numbers rounds once
        v = np.array([[int(c) / (n * n) for c in row] for row in centred])
        values, vectors = np.linalg.eigh(v)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        keep = values > max(FLAT * values[0], 0.0) if len(values) else values > 0
        self.values, vectors = values[keep], vectors[:, keep]
        heads = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
        self.axes = vectors * np.where(heads < 0, -1.0, 1.0) / np.sqrt(self.values)
        self.explained = [float(e / (trace / (n * n))) for e in self.values] if trace else []

    def apply(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Centred rows times n, and the whitened rows."""
        y = _rebased(matrix(lists, len(self.low)), self.low, self.excess, self.n, self.reach)
        return y, (y / self.n).astype(np.float64) @ self.axes


def _moments(fit: _Fit):
    """Sums of the whitened values and of their products over a task's rows."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fit.values)
        sums, squares = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                z = fit.apply(batch.column(0))[1]
                sums += z.sum(axis=0)
                squares += z.T @ z
        i, j = np.triu_indices(k)
        i, j, v = np.r_[i, np.full(k, -1)], np.r_[j, np.arange(k)], np.r_[squares[i, j], sums]
        yield pa.record_batch([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(v)], ["i", "j", "v"])

    return moments


def _whitened(fit: _Fit):
    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y, z = fit.apply(batch.column(1))
            if y.dtype != object and (fit.n * fit.reach) ** 2 * len(fit.low) >= 1 << 63:
                y = y.astype(object)
            deviation = pa.array([Decimal(int(v)) for v in (y * y).sum(axis=1)], _EXACT)
            ends = np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(z).reshape(-1)))
            yield pa.record_batch([batch.column(0), deviation, lists], ["key", "deviation", "whitened"])

    return whitened


def fit_whitening(stored: DataFrame, components: int = COMPONENTS) -> _Fit | None:
    """Whitening of the stored whole-number vectors ``x``; None without rows.

    Cross-products are exact: entries less their dimension's least are cut into bit planes, a
    plane packs 64 rows in a word, and each pair of planes adds the popcount of its AND, weighted
    by its two bits. Tasks send one number a pair of dimensions; the driver centres them as
    integers and takes the eigenvectors of a dimension by dimension matrix.
    """
    kind = "dim int, n long, low long, high long, total decimal(38,0)"
    totals = stored.select("x").mapInArrow(_totals, kind).groupBy("dim").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total")
    ).orderBy("dim").collect()  # one row a dimension
    if not totals:
        return None
    low, high = [r["low"] for r in totals], [r["high"] for r in totals]
    widths = [(h - b).bit_length() for h, b in zip(high, low)]
    pairs = stored.select("x").mapInArrow(_products(np.array(low, np.int64), widths), "i int, j int, product decimal(38,0)")
    products = np.zeros((len(low), len(low)), object)
    for r in pairs.groupBy("i", "j").agg(F.sum("product").alias("product")).collect():  # one row a pair of dimensions
        products[r["i"], r["j"]] = products[r["j"], r["i"]] = int(r["product"])
    return _Fit(totals[0]["n"], low, high, [int(r["total"]) for r in totals], products, components)


def _identity_error(stored: DataFrame, fit: _Fit) -> float:
    """Largest entry of the whitened rows' covariance less the identity, measured on all rows."""
    k = len(fit.values)
    squares, sums = np.zeros((k, k)), np.zeros(k)
    found = stored.select("x").mapInArrow(_moments(fit), "i int, j int, v double")
    for r in found.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # one row a pair of components
        if r["i"] < 0:
            sums[r["j"]] = r["v"]
        else:
            squares[r["i"], r["j"]] = squares[r["j"], r["i"]] = r["v"]
    mean = sums / fit.n
    return float(np.abs(squares / fit.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whiten(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
    scale: float = SCALE, shift: int = SHIFT,
) -> DataFrame:
    """One row per whole vector: ``key, n, deviation, whitened, explained, identity_error``.

    Entries become ``x = floor(scale * c) + shift``. ``whitened`` holds, for each component by
    falling eigenvalue, the row's ``x`` less the mean, projected on the unit eigenvector of the
    covariance (divisor n) and divided by the root of the eigenvalue; each eigenvector's largest
    entry is positive. ``explained`` holds the shares of the trace, ``deviation`` the exact sum of
    ``(n * x - S) ** 2`` (decimal), ``identity_error`` the largest entry of the whitened covariance less the
    identity, measured on all rows.

    Vectors that are null, hold null or non-finite entries or have an unusual length are left out
    (``whole_vectors``). Repeated rows and null keys count and come back row by row; only the two
    columns named are read. Components whose eigenvalue is zero next to the largest (equal rows,
    dependent dimensions) cannot be whitened and are left out, so ``whitened`` may be shorter or
    empty. An empty table gives no rows.
    """
    spark = rows.sparkSession
    whole = whole_vectors(rows, vector, scale, shift)
    key_type = whole.schema[key].dataType
    stored = materialize(whole.select(F.col(f"`{key}`").alias("key"), "x"), "whitening")
    fit = fit_whitening(stored, components)
    out = T.StructType().add("key", key_type).add("deviation", T.DecimalType(38, 0)).add("whitened", T.ArrayType(T.DoubleType()))
    if fit is None:
        made = spark.createDataFrame([], out)
        n, explained, error = 0, [], 0.0
    else:
        made = stored.select("key", "x").mapInArrow(_whitened(fit), out)
        n, explained, error = fit.n, fit.explained, _identity_error(stored, fit)
    shares = F.array(*[F.lit(e) for e in explained]).cast("array<double>")
    return made.select(
        F.col("key").alias(key), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        shares.alias("explained"), F.lit(error).alias("identity_error"),
    )
