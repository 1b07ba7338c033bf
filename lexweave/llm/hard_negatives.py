"""Hard negatives: an STR-packed R-tree searched best-first by inner-product intervals."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import partitions, ranked
from .vectors import matrix, whole_vectors

SCALE = 256.0
POSITIVES = NEGATIVES = 5
#: A negative's score in percent of the positive's.
LEAST, MOST = 80, 100
#: Rows of a leaf, and children of an inner node.
LEAF, FANOUT = 128, 8
#: Coordinates that the packing sorts by, those that vary most.
COORDINATES = 3
#: Rows of a block, one subtree that a task holds: at least and at most.
BLOCK = (8 * LEAF, 512 * LEAF)

_FOUND = "aid long, anchor_id long, goal int, vec_id long, rid long, score long"


class Tree:
    """Nodes over the rows of a block in packed order: boxes, and the label of rows that share one."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rids: np.ndarray, labels: np.ndarray):
        self.ids, self.rids = ids, rids
        self.names, self.codes = np.unique(labels, return_inverse=True)
        self.reach = int(np.abs(x).max(initial=0))
        self.x = x.astype(np.float64) if self.reach < 1 << 53 else x.astype(object)
        starts = np.arange(0, len(x), LEAF)
        self.ends = np.r_[starts[1:], len(x)]
        level = [f.reduceat(v, starts, axis=0) for v in (self.x, self.codes) for f in (np.minimum, np.maximum)]
        self.levels = [level]
        while len(level[0]) > 1:
            starts = np.arange(0, len(level[0]), FANOUT)
            level = [f.reduceat(v, starts, axis=0) for v, f in zip(level, (np.minimum, np.maximum) * 2)]
            self.levels.append(level)

    def intervals(self, q: np.ndarray) -> list[tuple[list, list]]:
        """Per level, the least and the largest inner product that any point of a box can have."""
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        return [
            ((plus @ low.T + minus @ high.T).tolist(), (plus @ high.T + minus @ low.T).tolist())
            for low, high, _, _ in self.levels
        ]

    def search(self, q, bounds, code: int, same: bool, rid: int, goals: list, k: int) -> list[list[tuple]]:
        """For each goal ``(low, high)`` the first ``k`` rows ``(-score, id, rid)`` with scores in it.

        Rows share the label ``code`` or differ from it; row ``rid`` is left out. The open box
        that may hold the largest score comes first; boxes that miss every score window, or stay
        strictly below the k-th score found in each, are never opened.
        """
        found: list[list[tuple]] = [[] for _ in goals]
        top = len(self.levels) - 1
        heap = [(-bounds[top][1][i], -top, i) for i in range(len(bounds[top][1]))]
        heapq.heapify(heap)
        while heap:
            up, depth, node = heapq.heappop(heap)
            up, depth = -up, -depth
            down = bounds[depth][0][node]
            open_ = [
                g for g, (low, high) in enumerate(goals)
                if up >= low and down <= high and (len(found[g]) < k or min(up, high) >= -found[g][-1][0])
            ]
            one = self.levels[depth][2][node], self.levels[depth][3][node]
            if not open_ or (same and not one[0] <= code <= one[1]) or (not same and one == (code, code)):
                continue
            if depth:
                for child in range(node * FANOUT, min((node + 1) * FANOUT, len(bounds[depth - 1][1]))):
                    heapq.heappush(heap, (-bounds[depth - 1][1][child], -(depth - 1), child))
                continue
            a, b = node * LEAF, self.ends[node]
            scores = self.x[a:b] @ q
            fits = (self.codes[a:b] == code) == same
            if same:
                fits &= self.rids[a:b] != rid
            for g in open_:
                low, high = goals[g]
                least = max(low, -found[g][-1][0]) if len(found[g]) == k else low
                at = np.flatnonzero(fits & (scores >= least) & (scores <= high))
                if len(at) > k:
                    at = at[np.lexsort((self.rids[a + at], self.ids[a + at], -scores[at]))[:k]]
                if len(at):
                    new = zip((-scores[at]).tolist(), self.ids[a + at].tolist(), self.rids[a + at].tolist())
                    found[g] = sorted([*found[g], *new])[:k]
        return found


def _tree(parts: list[pa.RecordBatch]) -> Tree:
    rows = pa.Table.from_batches(parts).combine_chunks()
    lists = rows["x"].combine_chunks()
    return Tree(
        matrix(lists, len(lists[0])), rows["vec_id"].to_numpy(), rows["rid"].to_numpy(),
        np.array(rows["label"].to_pylist()),
    )


def _answers(tree: Tree, asked: pa.RecordBatch, same: bool, k: int) -> pa.RecordBatch:
    q = matrix(asked.column("x"), len(asked.column("x")[0]))
    dims, most = q.shape[1], int(np.abs(q).max(initial=0))
    # inner products below 2**53 are exact in floating point
    if tree.reach * most * dims < 1 << 53:
        q = q.astype(np.float64)
    else:
        q, tree.x = q.astype(object), tree.x.astype(object)
        tree.levels = [[v.astype(object) if v.ndim > 1 else v for v in level] for level in tree.levels]
    bounds = tree.intervals(q)
    labels = np.array(asked.column("label").to_pylist())
    codes = np.searchsorted(tree.names, labels)
    known = codes < len(tree.names)
    known[known] = tree.names[codes[known]] == labels[known]
    out = []
    goals = asked.column("goals").to_pylist()
    rids, ids = asked.column("rid").to_pylist(), asked.column("vec_id").to_pylist()
    for i in range(len(q)):
        mine = [(low[i], up[i]) for low, up in bounds]
        code = int(codes[i]) if known[i] else -1
        wanted = [(float("-inf"), float("inf"))] if same else [(g["low"], g["high"]) for g in goals[i]]
        names = [0] if same else [g["goal"] for g in goals[i]]
        for name, rows in zip(names, tree.search(q[i], mine, code, same, rids[i], wanted, k)):
            out.extend((rids[i], ids[i], name, vec, rid, int(-score)) for score, vec, rid in rows)
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    columns = list(zip(*out)) if out else [[]] * 6
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in _FOUND.split(", ")])


def _searching(same: bool, k: int):
    """Rows arrive block by block, first those of the tree in packed order, then the queries."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, tree = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks, asks = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.r_[True, (blocks[1:] != blocks[:-1]) | (asks[1:] != asks[:-1])])
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(blocks)]):
                if blocks[a] != block:
                    block, held, tree = blocks[a], [], None
                if not asks[a]:
                    held.append(batch.slice(a, b - a))
                    continue
                if tree is None:
                    tree, held = _tree(held), []
                yield _answers(tree, batch.slice(a, b - a), same, k)

    return search


def pack(stored: DataFrame, n: int) -> DataFrame:
    """Adds ``place``, the row's place in sort-tile-recursive order.

    Rows are sorted by one coordinate and cut into slabs of equal counts, each slab by the next
    coordinate, and so on; every sort is a global rank, so equal values split anywhere.
    """
    spread = stored.select(F.posexplode("x").alias("dim", "v")).groupBy("dim").agg(F.var_pop("v").alias("s"))
    dims = [r["dim"] for r in spread.orderBy(F.desc("s"), "dim").limit(COORDINATES).collect()]
    slabs = max(1, round((n / LEAF) ** (1 / len(dims))))
    order = stored.select("rid", F.lit(0).cast("long").alias("slab"), *[F.col("x")[d].alias(f"c{i}") for i, d in enumerate(dims)])
    width = n
    for i in range(len(dims)):
        order = ranked(order, [F.col("slab"), F.col(f"c{i}"), F.col("rid")], "hard-negatives-order", "place")
        if i < len(dims) - 1:
            inner = -(-width // slabs)
            # slabs have equal counts, so a place tells how far it lies in its slab
            within = F.floor(F.pmod(F.col("place"), F.lit(width)) / inner)
            order = order.withColumn("slab", F.col("slab") * slabs + within).drop("place", f"c{i}")
            width = inner
    return stored.join(order.select("rid", "place"), "rid")


def _best(found: DataFrame, k: int, out: str) -> DataFrame:
    """The first ``k`` of what all blocks found for a goal: highest score, then smallest id."""
    order = Window.partitionBy("aid", "goal").orderBy(F.desc("score"), "vec_id", "rid")
    return found.withColumn(out, F.row_number().over(order)).filter(F.col(out) <= k)


def mine_negatives(
    rows: DataFrame, anchors: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST, scale: float = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products of the vectors ``floor(scale * c)``. An anchor's positives are its
    first ``positives`` other rows of the same label; each positive has the first ``negatives``
    rows of another label with ``least * positive <= 100 * negative <= most * positive``. Higher
    scores come first, then smaller keys, then a fixed order of the rows. ``anchors`` is a
    condition on ``rows``.

    All rows are packed into an R-tree by sort-tile-recursive order, cut into blocks of bounded
    size, one subtree each. Every anchor is searched in every block, best box first, and what the
    blocks found is ranked; no row is left out of the tree and no box is skipped that could hold
    an answer.

    Rows with a null key or label, or without a whole vector (``whole_vectors``), take no part.
    Repeated rows are rows of their own, as anchors and as answers. An anchor without positives,
    or a positive without negatives in its window, gives no rows; neither does an empty table.
    """
    spark = rows.sparkSession
    named = rows.filter(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull())
    whole = whole_vectors(named.withColumn("_anchor", F.coalesce(anchors, F.lit(False))), vector, scale, 0, "_x")
    stored = materialize(whole.select(
        F.monotonically_increasing_id().alias("rid"), F.col(f"`{key}`").cast("long").alias("vec_id"),
        F.col(f"`{label}`").cast("string").alias("label"), F.col("_x").alias("x"), F.col("_anchor").alias("anchor"),
    ), "hard-negatives")
    n = stored.count()
    size = min(BLOCK[1], max(BLOCK[0], -(-n // (2 * partitions(spark)))))
    size = -(-size // LEAF) * LEAF
    n_blocks = max(1, -(-n // size))
    empty = F.lit(None).cast("array<struct<goal:int,low:long,high:long>>")
    columns = ["block", "kind", "place", "rid", "vec_id", "label", "x", "goals"]
    tiles = materialize((pack(stored, n) if n else stored.withColumn("place", F.lit(0).cast("long"))).select(
        F.floor(F.col("place") / size).cast("int").alias("block"), F.lit(0).alias("kind"), "place",
        "rid", "vec_id", "label", "x", empty.alias("goals"),
    ), "hard-negatives-tiles")

    def search(queries: DataFrame, same: bool, k: int) -> DataFrame:
        everywhere = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        asked = everywhere.withColumn("kind", F.lit(1)).withColumn("place", F.col("rid")).select(*columns)
        dealt = tiles.select(*columns).union(asked).repartition(n_blocks, "block")
        return dealt.sortWithinPartitions("block", "kind", "place").mapInArrow(_searching(same, k), _FOUND)

    asking = stored.filter("anchor").select("rid", "vec_id", "label", "x")
    near = materialize(
        _best(search(asking.withColumn("goals", empty), True, positives), positives, "goal_rank"),
        "hard-negatives-positives",
    ).select("aid", F.col("goal_rank").alias("goal"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    goal = F.struct(
        "goal",
        F.expr(f"(positive_score * {least} + pmod(-positive_score * {least}, 100)) div 100").alias("low"),
        F.expr(f"(positive_score * {most} - pmod(positive_score * {most}, 100)) div 100").alias("high"),
    )
    goals = near.groupBy(F.col("aid").alias("rid")).agg(F.collect_list(goal).alias("goals"))  # a few an anchor
    far = _best(search(asking.join(goals, "rid"), False, negatives), negatives, "rank")
    far = far.select("aid", "anchor_id", "goal", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return far.join(near, ["aid", "goal"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
