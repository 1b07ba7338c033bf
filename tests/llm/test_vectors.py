import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexweave.llm import hard_negatives as hard, queries, whitening

ROWS = "vec_id long, embedding array<float>, label int, x array<long>, key string, rank int"
PATH = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Nulls in every column, null and non-finite entries, an odd length, repeated rows, clashing names."""
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)], i % 3, [1], "k", 1) for i in range(300)]
    rows += rows[:3] + [(300, rows[0][1], 1, None, None, None), (301, rows[0][1], 2, None, None, None)]
    rows += [
        (None, rows[1][1], 1, None, None, None), (400, None, 1, None, None, None), (500, rows[2][1], None, None, None, None),
        (600, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1, None, None, None), (700, [float("nan")] * 6, 1, None, None, None),
        (800, [0.0, 0.0, 0.0, 0.0, 0.0, float("inf")], 1, None, None, None), (900, [0.5] * 7, 1, None, None, None), (901, [], 1, None, None, None),
        (None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, ROWS)


@pytest.fixture(scope="module")
def no_vectors(spark):
    return spark.createDataFrame([], ROWS)


def whole(rows, scale, shift, length):
    out = []
    for r in rows:
        v = r.embedding
        if v is not None and len(v) == length and all(c is not None and math.isfinite(c) for c in v):
            out.append((r.vec_id, r.label, [math.floor(scale * c) + shift for c in v]))
    return out


# --- whitening ----------------------------------------------------------------------------


def slow_whitening(vectors, k):
    n, d = len(vectors), len(vectors[0])
    s = [sum(v[i] for v in vectors) for i in range(d)]
    cov = [[sum((n * v[i] - s[i]) * (n * v[j] - s[j]) for v in vectors) for j in range(d)] for i in range(d)]
    v = np.array([[float(Fraction(c, n**3)) for c in row] for row in cov])
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    centred = np.array([[float(Fraction(n * x - t, n)) for x, t in zip(row, s)] for row in vectors])
    deviation = [sum((n * x - t) ** 2 for x, t in zip(row, s)) for row in vectors]
    return centred @ axes / np.sqrt(values), values / np.trace(v), deviation


@pytest.mark.parametrize("plane_rows", [64, 100, whitening.PLANE_ROWS])
def test_whitening_matches_exact_arithmetic(spark, odd_vectors, monkeypatch, plane_rows):
    monkeypatch.setattr(whitening, "PLANE_ROWS", plane_rows)
    vectors = whole(odd_vectors.collect(), 64, 1_000_000, 6)
    white, shares, deviation = slow_whitening([x for _, _, x in vectors], 4)
    got = whitening.whiten(odd_vectors.repartition(3), components=4).collect()
    assert len(got) == len(vectors) == 307
    assert sorted(map(str, [r.vec_id for r in got])) == sorted(str(i) for i, _, _ in vectors)
    assert {r.n for r in got} == {307} and got[0].identity_error < 1e-9
    assert np.allclose(got[0].explained, shares, rtol=1e-9)
    wanted = {(d, i): w for (i, _, _), d, w in zip(vectors, deviation, white)}
    for r in got:
        assert np.allclose(np.abs(r.whitened), np.abs(wanted[r.deviation, r.vec_id]), atol=1e-9)
    signs = {tuple(np.sign(np.array(r.whitened) * wanted[r.deviation, r.vec_id])) for r in got if min(map(abs, r.whitened)) > 1e-6}
    assert len(signs) == 1  # one sign a component, for all rows


def test_cross_products_of_any_size():
    rng = np.random.default_rng(1)
    for top in (1, 2, 700, 1 << 40):
        x = rng.integers(-top, top + 1, (333, 4))
        x[:, 2] = 5  # no planes
        low = x.min(axis=0)
        widths = [int(w).bit_length() for w in x.max(axis=0) - low]
        p = whitening.planes(x, low, widths)
        counts = np.zeros((sum(widths),) * 2, np.int64)
        for i in range(len(counts)):
            counts[i, i:] = np.bitwise_count(p[i] & p[i:]).sum(axis=1, dtype=np.int64)
        made = whitening.scatter(counts, widths, len(x))
        shifted = (x - low).astype(object)
        assert (made == shifted.T @ shifted).all()


def test_whitening_of_flat_and_empty_tables(spark, no_vectors):
    assert whitening.whiten(no_vectors).count() == 0
    same = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(5)], "vec_id long, embedding array<float>")
    assert [(r.whitened, r.deviation, r.n) for r in whitening.whiten(same).collect()] == [([], 0, 5)] * 5
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], "vec_id long, embedding array<double>")
    got = whitening.whiten(line).collect()
    assert all(len(r.whitened) == 1 for r in got) and got[0].identity_error < 1e-12
    wide = spark.createDataFrame([(i, [float(i) * 1e9, -float(i * i)]) for i in range(50)], "vec_id long, embedding array<double>")
    assert whitening.whiten(wide, scale=1.0).count() == 50


def test_whitening_query(spark):
    rows = queries.op11_whitening(spark, PATH)
    assert rows.count() == 500 * 32
    assert rows.agg(F.max("identity_error")).first()[0] < 1e-4
    assert {r.component for r in rows.select("component").distinct().collect()} == set(range(1, 33))


# --- hard negatives -----------------------------------------------------------------------


def slow_negatives(rows, is_anchor, k=5, low=80, high=100):
    """Sorted ``(anchor, positive, rank, negative, scores)``; rows are (id, label, vector)."""
    out = []
    for a, (i, label, q) in enumerate(rows):
        if not is_anchor(i):
            continue
        scored = [(-sum(x * y for x, y in zip(q, v)), j, b) for b, (j, _, v) in enumerate(rows)]
        same = sorted(s for s in scored if rows[s[2]][1] == label and s[2] != a)[:k]
        other = sorted(s for s in scored if rows[s[2]][1] != label)
        for p, j, _ in same:
            fits = [s for s in other if low * -p <= 100 * -s[0] <= high * -p][:k]
            out += [(i, j, r, m, -p, -s) for r, (s, m, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(df, condition, **options):
    return sorted(tuple(r) for r in hard.mine_negatives(df, condition, **options).collect())


@pytest.mark.parametrize("leaf,fanout,block", [(4, 2, (8, 16)), (16, 3, (64, 64)), (hard.LEAF, hard.FANOUT, hard.BLOCK)])
def test_negatives_match_brute_force(odd_vectors, monkeypatch, leaf, fanout, block):
    for name, value in (("LEAF", leaf), ("FANOUT", fanout), ("BLOCK", block)):
        monkeypatch.setattr(hard, name, value)
    rows = [r for r in whole(odd_vectors.collect(), 4, 0, 6) if r[0] is not None and r[1] is not None]
    got = mined(odd_vectors, F.col("vec_id") % 20 == 0, scale=4)
    assert got == slow_negatives(rows, lambda i: i % 20 == 0)
    assert len(got) > 100


def test_negatives_of_equal_and_extreme_vectors(spark, no_vectors):
    rows = [(i, [1.0, 2.0, -1.0, 0.5], i % 2) for i in range(400)] + [(1000, [-1.0, -2.0, 1.0, 0.0], 0)]
    rows += [(2000 + i, [1e6 * i, -1e6, 2.0, 0.0], i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    whole_rows = [(i, y, [math.floor(256 * c) for c in v]) for i, v, y in rows]
    assert mined(df, F.col("vec_id") % 100 == 0) == slow_negatives(whole_rows, lambda i: i % 100 == 0)
    assert hard.mine_negatives(no_vectors, F.col("vec_id") % 100 == 0).count() == 0
    alone = df.filter("vec_id = 1000")
    assert mined(alone, F.lit(True)) == []


def test_negatives_query(spark):
    rows = spark.read.parquet(f"{PATH}/embeddings.parquet").collect()
    made = [(i, (y + 1) % 10 if i % 7 == 0 else y, v) for i, y, v in whole(rows, 256, 0, 64)]
    got = sorted(tuple(r) for r in queries.op12_hard_negatives(spark, PATH).collect())
    assert got == slow_negatives(made, lambda i: i % 100 == 0)


def test_boxes_are_pruned():
    rng = np.random.default_rng(3)
    x = np.sort(rng.integers(-1000, 1000, (4096, 1)), axis=0)
    tree = hard.Tree(x, np.arange(4096), np.arange(4096), np.array(["a", "b"] * 2048))
    opened = []
    q = np.array([[3.0]])
    bounds = [(low[0], up[0]) for low, up in tree.intervals(q)]
    whole_x, tree.x = tree.x, type("Seen", (), {"__getitem__": lambda s, k: (opened.append(k), whole_x[k])[1]})()
    found = tree.search(q[0], bounds, 0, True, -1, [(float("-inf"), float("inf"))], 5)[0]
    assert [-s for s, _, _ in found] == sorted((3 * x[0::2, 0]).tolist())[::-1][:5]
    assert len(opened) <= 2
