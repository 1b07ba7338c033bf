"""Best-fit decreasing packing of documents into windows of tokens."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize
from .common import ranked
from .encoder import encoder

WINDOW = 1024
END_ID = 0

_PIECES = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )
)


class OpenWindows:
    """Segment tree over remaining capacities; a leaf holds the runs of windows that have it."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.filled = [False] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def _mark(self, room: int, value: bool) -> None:
        at = room + self.leaves
        self.filled[at] = value
        while at > 1:
            at //= 2
            self.filled[at] = self.filled[2 * at] or self.filled[2 * at + 1]

    def put(self, room: int, first: int, n: int) -> None:
        if n and room:
            if not self.runs[room]:
                self._mark(room, True)
            self.runs[room].append((first, n))

    def take(self, size: int) -> tuple[int, int, int] | None:
        """A run of the windows with the least room that takes ``size``: room, first, count."""
        at = size + self.leaves
        while not self.filled[at]:
            while at % 2:  # no sibling to the right under this parent
                at //= 2
            if at == 0:
                return None
            at += 1
            if at & (at - 1) == 0:  # past the right end of a level
                return None
        while at < self.leaves:
            at = 2 * at if self.filled[2 * at] else 2 * at + 1
        room = at - self.leaves
        first, n = self.runs[room].pop()
        if not self.runs[room]:
            self._mark(room, False)
        return room, first, n


def best_fit(sizes: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of equal sizes.

    Rows ``rank, n, window, per_window, offset, size``: the n pieces from that rank on, largest
    size first, fill windows from ``window`` on, ``per_window`` in each, from ``offset`` on.
    Equal pieces are interchangeable, and after one piece the same window stays the tightest
    for the next as long as it has room, so a run of windows is filled at once. Work and result
    depend on the number of sizes, at most ``window``, not on the number of pieces.
    """
    tree, plan = OpenWindows(window), []
    rank = opened = 0
    for size in sorted(sizes, reverse=True):
        left = sizes[size]
        while left:
            found = tree.take(size)
            if found is None:
                each = window // size
                found = (window, opened, -(-left // each))
                opened += found[2]
            room, first, n = found
            each = room // size
            used = min(left, n * each)
            plan.append((rank, used, first, each, window - room, size))
            full, part = divmod(used, each)
            tree.put(room - each * size, first, full)
            tree.put(room - part * size, first + full, 1 if part else 0)
            rest = full + (1 if part else 0)
            tree.put(room, first + rest, n - rest)
            rank, left = rank + used, left - used
    return plan


def pack(pieces: DataFrame, order: list[str], window: int = WINDOW, label: str = "packing") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of ``length`` 1 to ``window``.

    The counts of each length, at most ``window`` rows, give the plan; a piece finds its place
    by its rank among all pieces by length and ``order``. Ties in both are interchangeable.
    """
    pieces = materialize(pieces, label)
    sizes = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = np.array(best_fit(sizes, window), np.int64).reshape(-1, 6)
    shared = pieces.sparkSession.sparkContext.broadcast(plan)

    @F.arrow_udf(T.StructType([T.StructField("s", T.LongType()), T.StructField("o", T.LongType())]))
    def place(ranks: pa.Array) -> pa.Array:
        rank = ranks.to_numpy()
        row = shared.value[np.searchsorted(shared.value[:, 0], rank, "right") - 1].reshape(-1, 6)
        inner = rank - row[:, 0]
        sequence = row[:, 2] + inner // row[:, 3]
        offset = row[:, 4] + inner % row[:, 3] * row[:, 5]
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["s", "o"])

    by = [F.col("length").desc(), *[F.col(c).asc_nulls_first() for c in order]]
    placed = ranked(pieces, by, f"{label}-ranks", "_rank").withColumn("_place", place("_rank"))
    return placed.select(
        *pieces.columns,
        F.col("_place.s").alias("sequence_id"),
        F.col("_place.o").alias("offset"),
    )


def token_pieces(
    docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, key: str = "doc_id",
    text: str = "text", keep_ids: bool = True,
) -> DataFrame:
    """Cuts each document's ids and its end id into full windows and a rest.

    Rows ``key, start, length, ids_crc32, doc_tokens`` and, if kept, ``ids``. A null or empty
    text is its end id alone.
    """

    @F.arrow_udf(_PIECES)
    def cut(texts: pa.Array) -> pa.Array:
        rows = []
        coder = encoder(path)
        for t in texts:
            ids = np.append(coder.encode(t.as_py() or ""), np.uint32(end_id)).astype("<u4")
            rows.append(
                [
                    {
                        "start": a,
                        "length": len(part := ids[a : a + window]),
                        "ids_crc32": zlib.crc32(part.tobytes()),
                        "doc_tokens": len(ids),
                        "ids": part.astype(np.int32).tolist() if keep_ids else None,
                    }
                    for a in range(0, len(ids), window)
                ]
            )
        kind = pa.struct(
            [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
             ("doc_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))]
        )
        return pa.array(rows, pa.list_(kind))

    found = docs.select(F.col(key), F.explode(cut(text)).alias("p")).select(key, "p.*")
    return found if keep_ids else found.drop("ids")


def pack_documents(
    docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, key: str = "doc_id",
    text: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """Packs whole documents: ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Overlong documents are cut into full windows first. Repeated rows are packed each; null
    keys stay null; an empty table gives no rows. Only the two columns named are read.
    """
    pieces = token_pieces(docs, path, window, end_id, key, text, keep_ids)
    return pack(pieces, [key, "start", "ids_crc32"], window)
