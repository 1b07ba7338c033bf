"""Helpers the operators share: word hashes in tasks, global ranks, joins on skewed keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize

#: Bytes of text that one vectorised step works on; a longer text is a step of its own.
STEP_BYTES = 1 << 20
#: A key with more than 1/HOT_KEYS of all rows is hot, so there are at most HOT_KEYS of them.
HOT_KEYS = 50_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

#: Word bytes: ASCII letters and digits and every byte of a non-ASCII character.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
WORD_BYTES[128:] = True
#: Everything but ASCII white space.
INK_BYTES = np.ones(256, bool)
INK_BYTES[[*b" \t\n\v\f\r"]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse, modulo 2**64."""
    size = max(n, STEP_BYTES)
    got = _powers.__dict__.get("held")
    if got is None or len(got[0]) < size:
        got = []
        for base in (_ODD, _ODD_INVERSE):
            steps = np.full(size, base)
            steps[0] = 1
            got.append(np.multiply.accumulate(steps))
        got = tuple(got)
        if size == STEP_BYTES:
            _powers.held = got
    return got


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans in order; equal spans have equal hashes.

    Spans may overlap. Works in steps of STEP_BYTES, so memory follows the longest span.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(int(np.searchsorted(ends, base + STEP_BYTES, "right")), at + 1)
        part = buf[base : ends[to - 1]]
        power, inverse = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        at = to
    return out


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array, end to end, and the offsets of its texts."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = texts.buffers()[2]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), offsets - (offsets[0] if len(offsets) else 0)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(
    buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes of a class, none across two texts: starts, ends, first run of each text."""
    ink = inside[buf]
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    full = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads], last[tails] = ink[heads], ink[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def steps(texts: pa.Array, size: int = STEP_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of a string array of about ``size`` bytes, one text at least."""
    if not len(texts):
        return
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, before + size, "right")), at + 1)
        yield texts.slice(at, to - at)
        at = to


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``n`` words of each text, and the first run of each text.

    A text of fewer words has its whole sequence as its one run; a text without words none.
    """
    if n == 1 or not len(words):
        return words, bounds
    sizes = np.diff(bounds)
    whole = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for k in range(n):
        whole = whole * np.uint64(0xD6E8FEB86659FD93) + words[k : k + len(whole)]
    whole = mix(whole)
    counts = np.where(sizes >= n, sizes - n + 1, (sizes > 0).astype(sizes.dtype))
    first = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(first[-1], np.uint64)
    long = np.flatnonzero(sizes >= n)
    if len(long):
        inner = np.arange(int(counts[long].sum())) - np.repeat(
            np.cumsum(counts[long]) - counts[long], counts[long]
        )
        out[np.repeat(first[long], counts[long]) + inner] = whole[
            np.repeat(bounds[long], counts[long]) + inner
        ]
    for i in np.flatnonzero((sizes > 0) & (sizes < n)):
        value = np.full(1, sizes[i], np.uint64)
        for k in range(int(bounds[i]), int(bounds[i + 1])):
            value = value * np.uint64(0xD6E8FEB86659FD93) + words[k : k + 1]
        out[first[i]] = mix(value)[0]
    return out, first


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, order: list[Column], label: str, out: str = "rank") -> DataFrame:
    """Adds the 0-based place of each row in a total order.

    Rows are range-partitioned and sorted, then stored, so that places stay the same when a
    task runs again. One row a partition is counted and sent to all tasks.
    """
    n = partitions(df.sparkSession)
    place = F.monotonically_increasing_id()
    stored = materialize(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", place),
        label,
    )
    part = F.shiftright("_at", 33)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).collect()
    before, total = {}, 0
    for row in sorted(sizes, key=lambda r: r["_part"]):  # one row a partition
        before[row["_part"]] = total
        total += row["n"]
    rows = [(int(p), int(b)) for p, b in before.items()]
    starts = df.sparkSession.createDataFrame(rows, "_part long, _before long")
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_before", "_at")
    )


def attach(
    rows: DataFrame, facts: DataFrame, key: str, size: str, total: int, unique: Column
) -> DataFrame:
    """Left join of rows with one fact row per key, whatever share of the rows a key holds.

    ``size`` is the number of rows of the key, a column of ``facts``. Keys with more than
    ``total / HOT_KEYS`` rows, at most HOT_KEYS of them, are sent to all tasks; rows of such
    keys then carry a key of their own through the shuffle that serves the rest. Every other
    column of ``facts`` comes back; keys are not null in ``facts``.
    """
    names = [c for c in facts.columns if c not in (key, size)]
    bound = total // HOT_KEYS
    hot = facts.filter(F.col(size) > bound)
    hot = hot.select(key, F.struct(*names).alias("_hot"))
    rest = facts.filter(F.col(size) <= bound)
    rest = rest.select(
        F.struct(F.lit(0).alias("kind"), F.col(key).cast("string").alias("k")).alias("_key"),
        F.struct(*names).alias("_rest"),
    )
    spread = F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.lit(0)).otherwise(1)
    joined = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_key",
        F.struct(
            spread.alias("kind"),
            F.when(spread == 0, F.col(key).cast("string")).otherwise(unique.cast("string")).alias("k"),
        ),
    )
    joined = joined.join(rest, "_key", "left")
    found = F.coalesce("_hot", "_rest")
    return joined.select(*rows.columns, *[found[c].alias(c) for c in names])
