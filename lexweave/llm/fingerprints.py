"""SimHash document fingerprints and their search by permuted block tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialize
from .common import WORD_BYTES, attach, hash_spans, mix, partitions, steps, text_buffer, word_spans

BITS = 128
RADIUS = 3
#: A word pair weighs by its letters, up to this many.
LONGEST = 24
#: Texts of fewer bytes also vote with runs of GRAM bytes, the shorter the more.
SHORT = 1000
GRAM = 5
#: Every row whose id divides by this is a query of the search.
QUERY_STEP = 20

_PAIR = np.uint64(0xD6E8FEB86659FD93)
_SECOND = np.uint64(0xA0761D6478BD642F)


def _votes(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Signed sums of the bits of weighted 64-bit hashes and of their second scrambling."""
    total = np.zeros(BITS)
    for at in range(0, len(hashes), 1 << 15):
        h, w = hashes[at : at + (1 << 15)], weights[at : at + (1 << 15)].astype(np.float32)
        both = np.stack([h, mix(h ^ _SECOND)], axis=1)
        bits = np.unpackbits(both.view(np.uint8).reshape(len(h), -1), axis=1, bitorder="little")
        total += (w @ bits.astype(np.float32)).astype(np.float64)  # whole numbers below 2**24
    return 2 * total - float(weights.sum())


def fingerprints(texts: pa.Array) -> list[bytes]:
    """128-bit SimHash of whole texts.

    Terms are pairs of neighbouring lower-cased words, every word first paired with nothing,
    weighted by their letters; a repeated term votes each time. A bit is set if its signed sum
    is positive. A text without terms has fingerprint zero.
    """
    out = []
    for part in steps(texts):
        buf, offsets = text_buffer(pc.utf8_lower(pc.fill_null(part, "")))
        starts, ends, bounds = word_spans(buf, offsets, WORD_BYTES)
        words = hash_spans(buf, starts, ends)
        sizes = np.minimum(ends - starts, LONGEST // 2)
        pairs = mix(words[1:] + words[:-1] * _PAIR)
        singles = mix(words * _PAIR)
        for row in range(len(part)):
            a, b = int(bounds[row]), int(bounds[row + 1])
            size = int(offsets[row + 1] - offsets[row])
            hashes = [singles[a:b], pairs[a : b - 1] if b > a else pairs[:0]]
            weights = [sizes[a:b], 2 * (sizes[a : b - 1] + sizes[a + 1 : b]) if b > a else sizes[:0]]
            if GRAM <= size < SHORT:
                s = np.arange(offsets[row], offsets[row + 1] - GRAM + 1)
                hashes.append(hash_spans(buf, s, s + GRAM))
                weights.append(np.full(len(s), 1 + 12 * (SHORT - size) // SHORT))
            elif 0 < size < GRAM:
                hashes.append(hash_spans(buf, offsets[row : row + 1], offsets[row + 1 : row + 2]))
                weights.append(np.ones(1, np.int64))
            votes = _votes(np.concatenate(hashes), np.concatenate(weights))
            out.append(np.packbits(votes > 0).tobytes())
    return out


@F.arrow_udf(T.BinaryType())
def fingerprint(texts: pa.Array) -> pa.Array:
    return pa.array(fingerprints(texts), pa.binary())


def _half(print_: Column, k: int) -> Column:
    """The k-th 64-bit half of a fingerprint."""
    return F.conv(F.substring(F.hex(print_), 16 * k + 1, 16), 16, -10).cast("long")


def differing(a: Column, b: Column) -> Column:
    """Differing bits of two fingerprints."""
    return sum(F.bit_count(_half(a, k).bitwiseXOR(_half(b, k))) for k in range(BITS // 64))


def likeness(a: Column, b: Column) -> Column:
    return 1 - differing(a, b) / F.lit(float(BITS))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``query, fp, distance``: all of ``prints`` within the radius of each of ``queries``.

    Fingerprints fall into ``radius + 1`` blocks; two within the radius are equal in one of
    them at least. Each block in turn leads a table, so a lookup is a join on table and block,
    and the other bits are compared exactly. Both sides have distinct values in ``fp``; a value
    finds itself. Nothing is lost and no pair of two non-queries is looked at.
    """
    blocks = radius + 1
    width = BITS // 4 // blocks + (1 if BITS // 4 % blocks else 0)  # hex digits

    def tables(df: DataFrame, name: str) -> DataFrame:
        digits = F.hex("fp")
        heads = [F.struct(F.lit(i).alias("t"), F.substring(digits, 1 + i * width, width).alias("b")) for i in range(blocks)]
        return df.select(
            F.col("fp").alias(name), _half(F.col("fp"), 0).alias(f"{name}_0"), _half(F.col("fp"), 1).alias(f"{name}_1"),
            F.explode(F.array(*heads)).alias("head"),
        ).select(name, f"{name}_0", f"{name}_1", "head.t", "head.b")

    left, right = tables(queries, "query"), tables(prints, "fp")
    apart = sum(F.bit_count(F.col(f"query_{k}").bitwiseXOR(F.col(f"fp_{k}"))) for k in range(2))
    same = (left["t"] == right["t"]) & (left["b"] == right["b"])
    found = left.join(right, same & (apart <= radius))
    return found.select("query", "fp", apart.alias("distance")).distinct()


# --- each document, its edited text and the next document ----------------------------------


def _order(key: Column, text: Column) -> Column:
    """Text that sorts as descending key, null keys last, equal keys by a hash of the text."""
    down = F.bitwise_not(key.cast("long").bitwiseXOR(F.lit(-(1 << 63))))
    digits = F.when(key.isNull(), F.lit("~" * 16)).otherwise(F.lpad(F.hex(down), 16, "0"))
    return F.concat(digits, F.lpad(F.hex(F.xxhash64(text)), 16, "0"))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``next_<column>`` of the row that follows by ``_order``; after the last, the first.

    Rows are dealt into ordered buckets. The first row of a bucket also goes to the bucket
    before it, as its last row's successor, so one shuffle and a window inside each bucket do.
    The driver holds one key a bucket.
    """
    n = 4 * partitions(docs.sparkSession)
    keys = docs.select("_order").repartitionByRange(n, "_order")
    heads = keys.groupBy(F.spark_partition_id().alias("p")).agg(F.min("_order").alias("head"))
    heads = np.array(sorted(r["head"] for r in heads.collect()), "S32")
    kind = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("first", T.BooleanType())])

    @F.arrow_udf(kind)
    def place(order: pa.Array) -> pa.Array:
        mine = np.array(order.to_pylist(), "S32")
        bucket = np.searchsorted(heads, mine, "right") - 1
        return pa.StructArray.from_arrays(
            [pa.array(bucket.astype(np.int32)), pa.array(heads[bucket] == mine)], ["bucket", "first"]
        )

    before = F.expr(f"pmod(_place.bucket - 1, {max(len(heads), 1)})")
    own, as_next = F.array("_place.bucket"), F.array(F.col("_place.bucket"), before)
    dealt = docs.withColumn("_place", place("_order"))
    dealt = dealt.select("*", F.posexplode(F.when(F.col("_place.first"), as_next).otherwise(own)).alias("_ghost", "_bucket"))
    along = Window.partitionBy("_bucket").orderBy("_ghost", "_order")
    ahead = [F.lead(c).over(along).alias(f"next_{c}") for c in columns]
    return dealt.select("*", *ahead).filter("_ghost = 0").drop("_place", "_ghost", "_bucket")


def fingerprint_documents(docs: DataFrame, radius: int = RADIUS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``
    and ``n_within``, for ids that divide by QUERY_STEP the number of other fingerprints within
    the radius, else null. Null texts are empty; null keys come last in the order; rows of
    equal key and text are interchangeable; a single row is its own next. An empty table gives
    no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("_order", _order(F.col("doc_id"), F.col("text"))).withColumn("fp", fingerprint("text"))
    rows = with_next(rows, ["text", "fp"])
    n = F.char_length("text")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 3) as int))"), F.expr("substring(next_text, 1, cast(floor(char_length(text) / 3) as int))"))
    rows = rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(edited.cast("binary"), 256).alias("edited_sha256"),
        "fp", fingerprint(edited).alias("edited_fp"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
    rows = materialize(rows, "fingerprints")
    values = materialize(rows.groupBy("fp").agg(F.count("*").alias("n")), "fingerprint-values")
    asked = rows.filter(F.col("doc_id") % QUERY_STEP == 0).select("fp").distinct()
    counts = within_radius(values.select("fp"), asked, radius).groupBy("query").agg((F.count("*") - 1).alias("near"))
    facts = values.join(counts, values["fp"] == counts["query"]).select(F.hex(values["fp"]).alias("fp_hex"), "n", "near")
    facts = materialize(facts, "fingerprint-near")
    rows = attach(rows.withColumn("fp_hex", F.hex("fp")), facts, "fp_hex", "n", rows.count(), F.xxhash64("doc_id", "fp"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fp")).alias("fingerprint"),
        F.lower(F.hex("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), "near_next",
        F.when(F.col("doc_id") % QUERY_STEP == 0, F.col("near")).alias("n_within"),
    )
