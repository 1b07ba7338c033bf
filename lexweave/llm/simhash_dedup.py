"""SimHash near-duplicates: segment bit counts as a grid, Manhattan bound, exact check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialize
from .common import attach
from .components import components

SHINGLE = 3
SEED = 42
RADIUS = 2
SEGMENTS = 16
#: A grid cell of more fingerprints is compared through exact one-bit neighbours.
PAIRWISE = 500

_SHIFTS = (np.arange(SEGMENTS, dtype=np.uint64) * np.uint64(4))[None, :]
_LOWEST = np.uint64(0x1111111111111111)


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """Majority of the bits of the XXH64 values of all word shingles, repeats included.

    Words are runs without ASCII white space, A-Z lower-cased. Fewer than ``n`` words give one
    shingle, the whole sequence; no word, or a null text, gives zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    k = max(len(words) - n + 1, 1)
    starts = (ends - sizes)[:k].tolist()
    stops = ends[min(n, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops)], "<u8")
    votes = np.zeros(64, np.int64)
    for at in range(0, k, 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > k, bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def fingerprint_udf(texts: pa.Array) -> pa.Array:
    values = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
    return pa.array(values.view(np.int64))


def bit_counts(values: np.ndarray) -> np.ndarray:
    """Set bits of each 4-bit segment, in the segment's own place."""
    x = values - ((values >> np.uint64(1)) & np.uint64(0x5555555555555555))
    return (x & np.uint64(0x3333333333333333)) + (
        (x >> np.uint64(2)) & np.uint64(0x3333333333333333)
    )


def cells(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grid points at Manhattan distance 0 or 1 of each value's bit counts, and the rows' owners.

    Points that no value can have (a count below 0 or above 4) are left out: a shortest way
    between two counts never needs them.
    """
    own = bit_counts(values)
    digits = (own[:, None] >> _SHIFTS) & np.uint64(15)
    step = np.uint64(1) << _SHIFTS
    points = np.concatenate([own[:, None], own[:, None] + step, own[:, None] - step], axis=1)
    valid = np.concatenate([np.ones((len(own), 1), bool), digits < 4, digits > 0], axis=1)
    owner = np.broadcast_to(np.arange(len(own))[:, None], points.shape)
    return points[valid], owner[valid]


def _to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(0).to_numpy().view(np.uint64)
        point, owner = cells(values)
        yield pa.record_batch(
            [pa.array(point.view(np.int64)), pa.array(values[owner].view(np.int64))], ["cell", "fp"]
        )


def _verify(cell: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one cell within the radius; rows of a cell are neighbours in the arrays."""
    own = bit_counts(fp)
    left, right = [], []
    lag = 1
    at = np.flatnonzero(cell[1:] == cell[:-1]) if len(cell) > 1 else np.zeros(0, np.int64)
    while len(at):
        a, b = at, at + lag
        apart = np.zeros(len(a), np.int64)
        for s in range(SEGMENTS):  # Manhattan distance of the bit counts, a lower bound
            shift = np.uint64(4 * s)
            x = ((own[a] >> shift) & np.uint64(15)).astype(np.int64)
            y = ((own[b] >> shift) & np.uint64(15)).astype(np.int64)
            apart += np.abs(x - y)
        near = apart <= radius
        a, b = a[near], b[near]
        exact = np.bitwise_count(fp[a] ^ fp[b]) <= radius
        left.append(fp[a[exact]])
        right.append(fp[b[exact]])
        lag += 1
        at = at[at + lag < len(cell)]
        at = at[cell[at] == cell[at + lag]]
    if not left:
        return fp[:0], fp[:0]
    return np.concatenate(left), np.concatenate(right)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of cells that arrive whole and in order; a cell may cross batches."""
    kept_cell, kept_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def found(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        a, b = _verify(cell, fp, RADIUS)
        pairs = np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)
        pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
        sides = [pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)]
        return pa.record_batch(sides, ["a", "b"])

    for batch in batches:
        cell = np.concatenate([kept_cell, batch.column(0).to_numpy()])
        fp = np.concatenate([kept_fp, batch.column(1).to_numpy().view(np.uint64)])
        if not len(cell):
            continue
        cut = int(np.searchsorted(cell, cell[-1]))
        kept_cell, kept_fp = cell[cut:], fp[cut:]
        yield found(cell[:cut], fp[:cut])
    yield found(kept_cell, kept_fp)


def link_fingerprints(prints: DataFrame) -> DataFrame:
    """Edges ``a, b`` whose components are those of all pairs within two differing bits.

    ``prints`` has distinct values ``fp``. Two values within two bits have segment bit counts
    within Manhattan distance two, so both stand within distance one of a common grid point,
    where they meet. A cell of up to PAIRWISE rows checks its pairs exactly; all its links
    come out. In a larger cell each value also stands at the values one bit away that lie in
    the cell; values that meet there are at most 65 and all within two bits of each other, so
    each is linked with the least of them: no link of the components is lost, and nothing is
    gathered.
    """
    spread = prints.select("fp").mapInArrow(_to_cells, "cell long, fp long")
    sized = spread.withColumn("n", F.count("*").over(Window.partitionBy("cell")))
    calm = sized.filter(F.col("n").between(2, PAIRWISE)).select("cell", "fp")
    calm = calm.sortWithinPartitions("cell").mapInArrow(_links, "a long, b long")
    bits = [0, *[1 << i for i in range(63)], -(1 << 63)]
    flips = F.array(*[F.lit(b).cast("long") for b in bits])
    near = sized.filter(F.col("n") > PAIRWISE).select(
        "cell", "fp", F.explode(flips).alias("flip")
    ).select("cell", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("meet"))
    near = near.filter(count_cell(F.col("meet")) == F.col("cell")).select("fp", "meet")
    # equal (fp, meet) from several cells fold in the aggregate
    least = near.groupBy("meet").agg(F.collect_set("fp").alias("all"))
    busy = least.filter(F.size("all") > 1).select(
        F.array_min("all").alias("a"), F.explode("all").alias("b")
    )
    return calm.union(busy.filter("a <> b")).distinct()


def count_cell(value: Column) -> Column:
    """Column form of the segment bit counts."""
    low = F.lit(0x1111111111111111)
    parts = [F.shiftrightunsigned(value, k).bitwiseAND(low) for k in range(4)]
    return parts[0] + parts[1] + parts[2] + parts[3]


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp, component`` per row: the fingerprint and the least key of its group.

    Equal texts share a fingerprint; null, empty and blank texts have fingerprint zero and link
    like any other. Null keys keep their rows; a group of null keys only has component null.
    Repeated rows and an empty table are fine. Only the two columns named are read.
    """
    rows = docs.select(F.col(key).alias(key), fingerprint_udf(text).alias("fp"))
    return _grouped(rows, key).select(key, "fp", "component")


def _grouped(rows: DataFrame, key: str) -> DataFrame:
    """Adds ``root``, a value that names the group of ``fp``, and ``component``, its least key."""
    rows = materialize(rows, "simhash")
    prints = materialize(
        rows.groupBy("fp").agg(F.min(key).alias("least"), F.count("*").alias("n")), "simhash-values"
    )
    roots = components(materialize(link_fingerprints(prints), "simhash-links"), "simhash-parts")
    # values outside every link are their own group; a group of values may be large
    named = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root")
    )
    named = materialize(named, "simhash-named")
    groups = named.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("size"))
    groups = materialize(groups, "simhash-groups")
    facts = attach(named, groups, "root", "size", named.count(), F.col("fp"))
    facts = materialize(facts.select("fp", "n", "root", "component"), "simhash-facts")
    return attach(rows, facts, "fp", "n", rows.count(), F.xxhash64(key, "fp"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Keeps of each group of ``near_duplicates`` the row with the least key, with all its columns.

    Of several rows of a group with that key one stays: the one whose text has the least hash,
    and of equal texts any. A group whose rows all have null keys keeps one of them; null keys
    come after all others. Null, empty and blank texts are a group like any other. Columns of any
    name come back as they are; an empty table gives no rows.
    """
    told = F.xxhash64(F.col(text))
    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null"))
    rows = docs.select(F.col(key).alias("key"), fingerprint_udf(text).alias("fp"), name.alias("name"), told.alias("told"))
    found = _grouped(rows, "key").filter(F.col("key").eqNullSafe(F.col("component")))
    texts = found.groupBy("root", "name", "told").agg(F.count("*").alias("n"))
    keep = texts.groupBy("root", "name").agg(F.min(F.struct("told", "n")).alias("one"))
    keep = materialize(keep.select("name", "one.told", "one.n"), "simhash-kept")
    mine = docs.select(F.struct("*").alias("row"), name.alias("name"), told.alias("told"))
    single = mine.join(keep.filter("n = 1"), ["name", "told"], "left_semi")
    repeated = mine.join(keep.filter("n > 1"), ["name", "told"], "left_semi").dropDuplicates(["name", "told"])
    return single.union(repeated).select("row.*")
