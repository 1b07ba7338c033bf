"""Benchmark decontamination: size-partitioned MinHash sketches, exact shingle containment."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import WORD_BYTES, hash_spans, shingle_hashes, steps, text_buffer, word_spans

SHINGLE = 5
CONTAINMENT = 0.8
#: Bytes of item texts whose sketches are sent to tasks at a time.
BLOCK_BYTES = 16 << 20

#: Signs and spaces beyond ASCII that separate words.
_SIGNS = "[\u0080-©«-´¶-¹»-¿  -⁯　-〿]"

MATCHES = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("shared", T.LongType()),
            T.StructField("size", T.LongType()),
            T.StructField("containment", T.DoubleType()),
        ]
    )
)
_ARROW_MATCHES = pa.list_(
    pa.struct(
        [("item_id", pa.int64()), ("shared", pa.int64()), ("size", pa.int64()), ("containment", pa.float64())]
    )
)


def normalised(texts: pa.Array) -> pa.Array:
    """Lower case, signs beyond ASCII as blanks."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), _SIGNS, " ")


def sketch_size(size: int, containment: float) -> int:
    """Shingles to keep so that a text with that share of an item holds one of them.

    A text that holds ``ceil(c * size)`` shingles lacks at most ``size - ceil(c * size)``.
    """
    return size - math.ceil(containment * size - 1e-9) + 1


class Words:
    """Words of a slice of texts: bytes, spans and hashes."""

    def __init__(self, texts: pa.Array):
        self.buf, offsets = text_buffer(normalised(texts))
        self.starts, self.ends, self.bounds = word_spans(self.buf, offsets, WORD_BYTES)
        self.words = hash_spans(self.buf, self.starts, self.ends)

    def shingles(self, row: int, n: int) -> set[bytes]:
        """The distinct shingles of one text, as bytes."""
        a, b = self.bounds[row], self.bounds[row + 1]
        spans = zip(self.starts[a:b].tolist(), self.ends[a:b].tolist())
        words = [self.buf[s:e].tobytes() for s, e in spans]
        if not words:
            return set()
        return {b" ".join(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))}


class Part:
    """Items of one shingle width: which high hash bits occur, and sketches by item size."""

    def __init__(self, sketches: dict[int, tuple[list, list]]):
        self.sizes = []
        self.maybe = np.zeros(1 << 20, bool)
        for _, (kept, owners) in sorted(sketches.items()):
            sketch, owner = np.concatenate(kept), np.concatenate(owners)
            order = np.argsort(sketch, kind="stable")
            self.sizes.append((sketch[order][-1], sketch[order], owner[order]))
            self.maybe[sketch >> np.uint64(44)] = True


class Sketches:
    """Sketches of one block of items, partitioned by the number of shingles of an item.

    A partition keeps the MinHash sketches of its items, the smallest shingle hashes, and the
    largest hash in any of them: shingles of a document beyond that cannot matter there. Its
    sketch sizes follow from its sizes, so short items are searched with short sketches. Items
    of fewer than ``n`` words have partitions of their own, one for each number of words.
    """

    def __init__(self, ids: list[int | None], texts: list[str | None], n: int, containment: float):
        self.containment = containment
        self.same: list[list[int | None]] = []
        self.exact: list[frozenset[bytes]] = []
        self.widths: dict[int, Part] = {}
        words = Words(pa.array(texts, pa.large_string()))
        widths = np.minimum(np.diff(words.bounds), n)
        for width in np.unique(widths[widths > 0]).tolist():
            hashes, first = shingle_hashes(words.words, words.bounds, width)
            known: dict[frozenset[bytes], int] = {}
            sketches: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
            for row in np.flatnonzero(widths == width).tolist():
                own = frozenset(words.shingles(row, width))
                if own in known:
                    self.same[known[own]].append(ids[row])
                    continue
                known[own] = len(self.exact)
                self.exact.append(own)
                self.same.append([ids[row]])
                distinct = np.unique(hashes[first[row] : first[row + 1]])
                sketch = distinct[: sketch_size(len(distinct), containment)]
                kept, owners = sketches[len(distinct).bit_length()]
                kept.append(sketch)
                owners.append(np.full(len(sketch), known[own]))
            self.widths[width] = Part(sketches)

    def search(self, texts: pa.Array) -> list[list[dict]]:
        """For each text the items it holds, by sketch, then counted exactly."""
        words = Words(texts)
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        for width, part in self.widths.items():
            for row, candidates in self._candidates(words, width, part).items():
                held = words.shingles(row, width)
                for c in sorted(candidates):
                    size = len(self.exact[c])
                    shared = len(self.exact[c] & held)
                    if shared >= math.ceil(self.containment * size - 1e-9):
                        out[row] += [
                            {"item_id": i, "shared": shared, "size": size, "containment": shared / size}
                            for i in self.same[c]
                        ]
        return out

    @staticmethod
    def _candidates(words: Words, width: int, part: Part) -> dict[int, set[int]]:
        """Items of a width with a sketch hash among a text's shingles, by text."""
        hashes, first = shingle_hashes(words.words, words.bounds, width)
        at = np.flatnonzero(part.maybe[hashes >> np.uint64(44)])
        found: dict[int, set[int]] = defaultdict(set)
        for ceiling, sketch, owner in part.sizes:
            low = at[hashes[at] <= ceiling]
            left = np.searchsorted(sketch, hashes[low], "left")
            right = np.searchsorted(sketch, hashes[low], "right")
            hit = right > left
            rows = np.searchsorted(first, low[hit], "right") - 1
            for row, a, b in zip(rows.tolist(), left[hit].tolist(), right[hit].tolist()):
                found[row].update(owner[a:b].tolist())
        return found


def blocks(items: DataFrame, item: str, text: str, size: int) -> Iterator[tuple[list, list]]:
    """Item ids and texts in blocks of about ``size`` bytes; one block is held at a time."""
    ids, texts, held = [], [], 0
    for row in items.select(F.col(item).cast("long"), text).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        held += 4 * len(row[1] or "") + 16
        if held >= size:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _searching(shared):
    @F.arrow_udf(MATCHES)
    def search(texts: pa.Array) -> pa.Array:
        return pa.array([r for part in steps(texts) for r in shared.value.search(part)], _ARROW_MATCHES)

    return search


def leaks(
    text: Column | str, items: DataFrame, item: str = "item_id", item_text: str = "text",
    n: int = SHINGLE, containment: float = CONTAINMENT, block_bytes: int = BLOCK_BYTES,
) -> Column:
    """Items whose share of ``containment`` or more of shingles a text holds, as an array.

    The items are the stated query set: they go to the tasks in blocks of bounded size, each
    searched by one column function, so texts are never shuffled. No match is lost: a sketch
    holds one shingle more than a text with enough of the item may lack.

    Words are runs of letters and digits, lower-cased. An item of ``k < n`` words is one shingle of
    ``k`` words, held by every text with these words in a row; one without words, or null, is
    never found. Equal items are all reported. Null and empty texts hold nothing.
    """
    context = items.sparkSession.sparkContext
    found = [
        _searching(context.broadcast(Sketches(ids, texts, n, containment)))(text)
        for ids, texts in blocks(items, item, item_text, block_bytes)
    ]
    if not found:
        return F.lit(None).cast(MATCHES)
    return F.concat(*found) if len(found) > 1 else found[0]


def contaminated(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """Rows ``key, item_id, shared, size, containment`` for each document and item it holds.

    Null and empty texts and empty tables give no rows; repeated documents are reported each,
    with null keys too.
    """
    found = docs.select(F.col(key), leaks(text, items, **options).alias("_leaks"))
    return found.select(key, F.explode("_leaks").alias("m")).select(key, "m.*")


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """Documents that hold no item, with all their columns.

    Null and empty texts stay, repeated rows stay or go together, and without items all stay.
    """
    found = F.coalesce(F.size(leaks(text, items, **options)), F.lit(0))
    return docs.filter(found <= 0)
