import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lexweave.llm import queries, substring_dedup as sub


def slow(rows, window=20):
    """Kept words of (doc_id, text) rows, by a table of all windows."""
    seen, out = {}, []
    docs = sorted(rows, key=lambda r: r[0])
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for s in range(len(words) - window + 1):
            w = tuple(words[s : s + window])
            if w in seen:
                gone.update(range(s, s + window))
            else:
                seen[w] = (i, s)
        out.append((i, len(words), len(gone), " ".join(w for p, w in enumerate(words) if p not in gone)))
    return sorted(out)


def fast(df, **options):
    found = sub.repeated_spans(df, **options).collect()
    return sorted((r.doc_id, r.n_words, sum(s.length for s in r.spans), r.kept) for r in found)


@pytest.mark.parametrize("block", [300, 5_000, sub.BLOCK_BYTES])
def test_spans_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(sub, "BLOCK_BYTES", block)
    rng = random.Random(5)
    passages = [[f"w{rng.randrange(60)}" for _ in range(rng.randint(15, 70))] for _ in range(12)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 5)):
            if rng.random() < 0.6:
                p = rng.choice(passages)
                a = rng.randrange(len(p))
                words += p[a:] if rng.random() < 0.5 else p[: a + 10]
            else:
                words += [f"v{rng.randrange(40)}" for _ in range(rng.randint(1, 30))]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    rows.append((200, " ".join(["same"] * 400)))  # every window stands next to itself
    rows.append((201, " ".join(["a", "b"] * 100)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert fast(df, window=20) == slow(rows)
    assert fast(df, window=6, gram=3) == slow(rows, 6)


def test_whole_table_matches_brute_force(sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert fast(sample) == slow(rows)


def test_odd_rows(odd_docs, no_docs):
    found = {}
    for r in sub.repeated_spans(odd_docs).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert len(found[1]) == 2 and len(found[None]) == 2
    # nine words make no window; equal rows are one document
    assert all(r.spans == [] and r.n_words == 9 for r in found[1] + found[2])
    assert [(r.n_words, r.kept) for r in found[3] + found[4] + found[5]] == [(0, "")] * 3
    assert found[7][0].kept == "x" * 200_000
    assert found[6][0].n_words == 60_000 and found[6][0].spans == []
    assert sub.repeated_spans(no_docs).count() == 0


def test_ties_of_ids(spark):
    text = " ".join(f"t{i}" for i in range(30))
    other = text + " end"
    rows = [(1, text), (1, text), (1, other), (None, text), (None, text + " null")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sub.repeated_spans(df).select("doc_id", F.size("spans").alias("k"), "kept").collect()
    whole = [r for r in found if r.doc_id == 1 and r.k == 0]
    # one of the two texts of id 1 comes first and stays, in all its rows
    assert {r.kept for r in whole} in ({text}, {other})
    assert all(r.kept in ("", "null") for r in found if r.doc_id is None and r.k)
    assert sum(r.k for r in found if r.doc_id is None) == 2


def test_query_digests(spark):
    rows = {r.doc_id: r for r in queries.op13_substring_dedup(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    for i, n, removed, kept in slow([(r.doc_id, r.text) for r in docs]):
        got = rows[i]
        assert (got.n_words, got.n_removed) == (n, removed)
        assert got.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_anchor_must_fit(sample):
    with pytest.raises(ValueError):
        sub.repeated_spans(sample, window=5, gram=6)
