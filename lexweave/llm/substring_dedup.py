"""Substring dedup: documents factored against indexed reference blocks, long factors removed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import materialize
from .common import INK_BYTES, _powers as powers, hash_spans, mix, steps, text_buffer, word_spans

#: A factor of fewer words is no duplicate span.
WINDOW = 20
#: Words of an anchor; every window has one.
GRAM = 8
#: Bytes of text in a reference block; a longer text is a block of its own.
BLOCK_BYTES = 1 << 23

#: Kinds of rows that leave a block: a phrase to look up, one to check by windows, a copied run,
#: and an anchor of several phrases.
INDEX, OPEN, COPIED, MANY = range(4)

_STEP = np.uint64(0xD6E8FEB86659FD93)
_OTHER = np.uint64(0xA0761D6478BD642F)


def _runs(words: np.ndarray, at: np.ndarray | slice, n: int, step: np.uint64) -> np.ndarray:
    """Hashes of the ``n`` words from each place on."""
    places = np.arange(len(words) - n + 1)[at] if isinstance(at, slice) else at
    out = np.zeros(len(places), np.uint64)
    for k in range(n):
        out = out * step + words[places + k]
    return mix(out)


def _long_runs(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words of each span, of any length."""
    power, inverse = powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[: len(words)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def _block(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block, end to end, and the first word of each text."""
    buf, offsets = text_buffer(texts)
    starts, ends, bounds = word_spans(buf, offsets, INK_BYTES)
    return hash_spans(buf, starts, ends), bounds


def anchors(words: np.ndarray, bounds: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """Windows of a block and the anchor of each: start, text, anchor's place and hash.

    The anchor is the first of the least hashed runs of ``gram`` words in the window, so equal
    windows have equal anchors at the same distance, and neighbouring windows often share one.
    """
    m = len(words) - window + 1
    if m <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64)
    grams = _runs(words, slice(None), gram, _STEP)
    least, at = grams[:m].copy(), np.zeros(m, np.int64)
    for s in range(1, window - gram + 1):
        other = grams[s : s + m]
        less = other < least
        least[less] = other[less]
        at[less] = s
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:m]
    whole = np.flatnonzero(np.arange(m) + window <= bounds[row + 1])
    return whole, row[whole], whole + at[whole], least[whole]


def _salted(n: int, seed: np.ndarray) -> np.ndarray:
    """Keys that spread rows which need no partner."""
    return mix(mix(np.arange(n, dtype=np.uint64) + _OTHER) + seed.astype(np.uint64))


def _batch(columns: dict[str, tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(v, t) for v, t in columns.values()], list(columns))


def _ranks(part: pa.RecordBatch) -> np.ndarray:
    """Place of each document of a block in the order of documents; equal ones share it."""
    doc, tie = part.column("doc").to_numpy(), part.column("tie").to_numpy()
    order = np.lexsort((tie, doc))
    new = np.r_[False, (doc[order][1:] != doc[order][:-1]) | (tie[order][1:] != tie[order][:-1])]
    rank = np.empty(len(doc), np.int64)
    rank[order] = np.cumsum(new[: len(doc)])
    return rank


def _earliest_of(when: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the earliest row of equal keys, and the rows that are such."""
    if not len(when):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    by = np.lexsort((when, *keys))
    head = np.zeros(len(by), bool)
    head[0] = True
    for key in keys:
        head[1:] |= key[by][1:] != key[by][:-1]
    source = np.empty(len(by), np.int64)
    source[by] = by[np.flatnonzero(head)[np.cumsum(head) - 1]]
    return source, by[head]


def _index_phrases(window: int, gram: int):
    """Factors of documents against their own block, and index rows for all other blocks.

    A phrase is the words of neighbouring windows with one anchor. Of equal phrases of a block
    the earliest is the source of the rest; runs of phrases copied from consecutive places are
    one factor row. An anchor with one phrase in its block goes on as an index row; one with
    several goes on as MANY, and its phrases, which may share windows, come out as OPEN. So an
    anchor is one keyed row a block, however often it occurs.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                words, bounds = _block(part.column("text"))
                place, row, at, h = anchors(words, bounds, window, gram)
                head = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)])
                n = np.diff(np.r_[head, len(at)])
                place, row, h = place[head], row[head], h[head]
                start = place - bounds[row]
                phrase = _long_runs(words, place, place + n + window - 1)
                when = (_ranks(part)[row] << 32) + start
                source, own = _earliest_of(when, n, phrase, h)
                copied = np.flatnonzero(when > when[source])
                first, ends = _merge(row[copied], start[copied], n[copied], place[source[copied]])
                lead = copied[first]
                length = start[copied[ends]] + n[copied[ends]] + window - 1 - start[lead]
                _, inverse, counts = np.unique(h[own], return_inverse=True, return_counts=True)
                several = counts[inverse] > 1
                single, open_ = own[~several], own[several]
                many = np.unique(h[open_])
                pick = np.concatenate([single, open_, lead])
                kind = np.repeat([INDEX, OPEN, COPIED, MANY], [len(single), len(open_), len(lead), len(many)])
                key = np.concatenate([h[single], _salted(len(open_) + len(lead), h[np.concatenate([open_, lead])]), many])
                bare = np.zeros(len(many), np.int64)
                yield _batch({
                    "h": (key.view(np.int64), pa.int64()),
                    "phrase": (np.r_[(phrase[pick] >> np.uint64(33)).astype(np.int64), bare].astype(np.int32), pa.int32()),
                    "kind": (kind.astype(np.int32), pa.int32()),
                    "doc": (np.r_[part.column("doc").to_numpy()[row[pick]], bare], pa.int64()),
                    "tie": (np.r_[part.column("tie").to_numpy()[row[pick]], bare].astype(np.int32), pa.int32()),
                    "start": (np.r_[start[pick], bare].astype(np.int32), pa.int32()),
                    "length": (np.r_[n[np.concatenate([single, open_])] + window - 1, length, bare].astype(np.int32), pa.int32()),
                })

    return index


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Reference blocks of a batch."""
    at = 0
    for part in steps(batch.column(batch.schema.get_field_index("text")), BLOCK_BYTES):
        yield batch.slice(at, len(part))
        at += len(part)


def _merge(row: np.ndarray, start: np.ndarray, n: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greedy factors of copied pieces in order: first and last piece of each.

    A factor goes on while the next piece is copied from the next place of the same source.
    """
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    goes_on = (row[1:] == row[:-1]) & (start[1:] == start[:-1] + n[:-1]) & (source[1:] == source[:-1] + n[:-1])
    first = np.flatnonzero(np.r_[True, ~goes_on])
    return first, np.r_[first[1:] - 1, len(row) - 1]


def _check_windows(window: int):
    """Windows of open phrases one by one, against their own block and for all other blocks.

    Open phrases stand where a factor ends: their anchor repeats, their words as a whole do not.
    Within the block the earliest of equal windows is the source of the rest, and runs of windows
    become factor rows; the earliest ones go on, one index row a distinct window.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                words, bounds = _block(part.column("text"))
                pieces = part.column("pieces")
                row = np.repeat(np.arange(len(part)), pc.list_value_length(pieces).to_numpy(zero_copy_only=False))
                pieces = pc.list_flatten(pieces)
                begin = pieces.field("start").to_numpy().astype(np.int64)
                n = pieces.field("length").to_numpy().astype(np.int64) - window + 1
                order = np.lexsort((begin, row))
                row, begin, n = row[order], begin[order], n[order]
                start = np.arange(n.sum()) + np.repeat(begin - (np.cumsum(n) - n), n)
                row = np.repeat(row, n)
                place = bounds[row] + start
                a = _runs(words, place, window, _STEP)
                b = (_runs(words, place, window, _OTHER) >> np.uint64(33)).astype(np.int32)
                when = (_ranks(part)[row] << 32) + start
                source, own = _earliest_of(when, b, a)
                copied = np.flatnonzero(when > when[source])
                first, ends = _merge(row[copied], start[copied], np.ones(len(copied), np.int64), place[source[copied]])
                lead = copied[first]
                length = start[copied[ends]] + window - start[lead]
                both = np.concatenate([own, lead])
                yield _batch({
                    "a": (np.r_[a[own], _salted(len(lead), a[lead])].view(np.int64), pa.int64()),
                    "b": (b[both].astype(np.int32), pa.int32()),
                    "doc": (part.column("doc").to_numpy()[row[both]], pa.int64()),
                    "tie": (part.column("tie").to_numpy()[row[both]].astype(np.int32), pa.int32()),
                    "start": (start[both].astype(np.int32), pa.int32()),
                    "length": (np.r_[np.zeros(len(own), np.int64), length].astype(np.int32), pa.int32()),
                })

    return check


def spans(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greedy parse of a document into copied spans: factors that touch or overlap are joined."""
    by = np.argsort(starts, kind="stable")
    starts, ends = starts[by], np.maximum.accumulate(starts[by] + lengths[by])
    first = np.flatnonzero(np.r_[True, starts[1:] > ends[:-1]][: len(starts)])
    last = np.r_[first[1:] - 1, len(starts) - 1] if len(first) else first
    return starts[first], ends[last]


_SPAN = T.StructType().add("start", "long").add("length", "long")


@F.arrow_udf(T.StructType().add("n_words", "long").add("spans", T.ArrayType(_SPAN)).add("kept", "string"))
def _kept(texts: pa.Array, starts: pa.Array, lengths: pa.Array) -> pa.Array:
    out = []
    for text, at, size in zip(texts, starts, lengths):
        words = (text.as_py() or "").encode().split()
        if not at.is_valid:
            out.append((len(words), [], b" ".join(words).decode()))
            continue
        found = spans(np.asarray(at.as_py(), np.int64), np.asarray(size.as_py(), np.int64))
        cuts = list(zip(found[0].tolist(), found[1].tolist()))
        kept, done = [], 0
        for a, b in cuts:
            kept.extend(words[done:a])
            done = b
        kept.extend(words[done:])
        out.append((len(words), [{"start": a, "length": b - a} for a, b in cuts], b" ".join(kept).decode()))
    kind = pa.struct([
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
        ("kept", pa.string()),
    ])
    return pa.array([dict(zip(("n_words", "spans", "kept"), x)) for x in out], kind)


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    last = F.lit((1 << 63) - 1)
    return docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    ).select(
        "doc_id", "text", F.coalesce("doc_id", last).alias("doc"),
        F.xxhash64("text").bitwiseAND(0x7FFFFFFF).cast("int").alias("tie"),
    )


def _pieces(plain: DataFrame, window: int, gram: int) -> DataFrame:
    """``doc, tie, start, length, open``: phrases copied as a whole, and those to check by window."""
    index = plain.mapInArrow(
        _index_phrases(window, gram), "h long, phrase int, kind int, doc long, tie int, start int, length int"
    )
    indexed = F.col("kind") == INDEX
    own = F.struct("doc", "tie", "start")
    alike = Window.partitionBy("h")
    met = F.when(indexed, F.col("phrase"))
    index = index.withColumn(
        "several", (F.max("kind").over(alike) == MANY) | (F.min(met).over(alike) < F.max(met).over(alike))
    )
    # rows stay where the window before put them
    index = index.withColumn("first", F.min(F.when(indexed, own)).over(Window.partitionBy("h", "phrase")))
    copied = (F.col("kind") == COPIED) | (indexed & (F.col("first") < own))
    open_ = (F.col("kind") == OPEN) | (indexed & F.col("several"))
    return index.filter(copied | open_).select("doc", "tie", "start", "length", (~copied).alias("open"))


def repeated_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """``doc_id, n_words, spans, kept`` per row: copied spans of words, and the words outside them.

    The corpus is its own reference, cut into blocks of BLOCK_BYTES. Each window of ``window``
    words is anchored at the least hashed of its runs of ``gram`` words, and neighbouring windows
    of one anchor are a phrase; blocks are indexed by anchors and phrases. Documents are factored
    greedily against their own block, where a factor goes on as long as phrases are copied from
    consecutive places of an earlier source, and through one exchange, one row an anchor and
    block, against all other blocks. A phrase whose anchor stands nowhere else is new. One whose
    anchor repeats while its words as a whole do not lies at the boundary of factors: its windows
    are looked up one by one in the same manner. So a word is in a span exactly if a window over
    it also starts earlier: in a document of smaller id, or before it in the same document.

    Words are runs without ASCII white space, unchanged; windows are told apart by 95 bits of
    hashes. Equal rows (id and text) are one document and share its result; different texts of
    one id come in order of a hash of the text; null ids come last. A null, empty or short text
    has no spans; an empty table gives no rows. A frequent anchor or window is one row a block,
    so no key gathers more than a small share of the rows; no text is joined to another. Texts are
    shuffled once: both joins by document read the same exchange.
    """
    if not 0 < gram <= window:
        raise ValueError(f"an anchor of {gram} words does not fit a window of {window}")
    rows = _keyed(docs, key, text)
    pieces = materialize(_pieces(rows.select("doc", "tie", "text"), window, gram), "substring-pieces")
    to_check = pieces.filter("open").groupBy("doc", "tie").agg(F.collect_set(F.struct("start", "length")).alias("pieces"))
    windows = rows.join(to_check, ["doc", "tie"]).mapInArrow(
        _check_windows(window), "a long, b int, doc long, tie int, start int, length int"
    )
    own = F.struct("doc", "tie", "start")
    windows = windows.withColumn("first", F.min(own).over(Window.partitionBy("a", "b")))
    windows = windows.filter((F.col("length") > 0) | (F.col("first") < own))
    length = F.when(F.col("length") > 0, F.col("length")).otherwise(window)
    copied = windows.select("doc", "tie", "start", length.alias("length")).union(
        pieces.filter("NOT open").select("doc", "tie", "start", "length")
    )
    lists = copied.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "length")).alias("factors"))
    found = rows.join(lists, ["doc", "tie"], "left")
    result = _kept("text", F.col("factors.start"), F.col("factors.length"))
    return found.select("doc_id", result.alias("r")).select("doc_id", "r.*")
