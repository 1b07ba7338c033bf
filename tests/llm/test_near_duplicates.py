import random
from collections import defaultdict

import xxhash

from lexweave.llm import components as parts, simhash_dedup as dedup


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(values):
    """Least id reachable over links of two bits or fewer."""
    ids, root = list(values), {i: i for i in values}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (values[a] ^ values[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints_and_groups_match_brute_force(sample):
    rows = dedup.near_duplicates(sample).collect()
    texts = {r.doc_id: r.text for r in sample.collect()}
    values = {i: slow_fingerprint(t) for i, t in texts.items()}
    assert {r.doc_id: r.fp % 2**64 for r in rows} == values
    assert {r.doc_id: r.component for r in rows} == slow_groups(values)


def test_links_of_calm_and_busy_cells(spark, monkeypatch):
    rng = random.Random(3)
    values = set()
    for _ in range(40):
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            values.add(v)
            v ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                v ^= 1 << rng.randrange(64)
    ids = dict(enumerate(sorted(values)))
    expected = slow_groups(ids)
    prints = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    for bound in (dedup.PAIRWISE, 1):
        monkeypatch.setattr(dedup, "PAIRWISE", bound)
        edges = dedup.link_fingerprints(prints).collect()
        assert all(((a ^ b) % 2**64).bit_count() <= 2 for a, b in edges)
        roots = {r.node % 2**64: r.root for r in parts.components(dedup.link_fingerprints(prints)).collect()}
        groups = defaultdict(set)
        for i, v in ids.items():
            groups[expected[i]].add(roots.get(v, f"alone {i}"))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(201, 260)] + [(5, 5), (300, 301), (301, 300)]
    found = {r.node: r.root for r in parts.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 200 for i in range(200, 260)}, 300: 300, 301: 300}
    assert parts.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(odd_docs, no_docs):
    rows = dedup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[2].component == 1 and by[4].component == by[5].component == by[3].component == 3
    assert {r.component for r in rows if r.doc_id is None} == {None, 3}
    kept = dedup.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 6, 7, 8] and ids.count(None) == 1
    assert dedup.near_duplicates(no_docs).count() == dedup.drop_near_duplicates(no_docs).count() == 0


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(11)
    texts = []
    for _ in range(30):
        text = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(150, 400))]
        texts += [" ".join(text)] * rng.randint(1, 3)
        for _ in range(rng.randint(0, 4)):
            copy = list(text)
            copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = slow_groups({i: slow_fingerprint(t) for i, t in enumerate(texts)})
    kept = [r.doc_id for r in dedup.drop_near_duplicates(docs).collect()]
    assert sorted(kept) == sorted(set(expected.values())) and len(kept) < len(texts) * 0.7


def test_rows_of_one_key_and_clashing_names(spark):
    rows = [
        (1, "alpha beta gamma delta", "=1", 5, "a"), (1, "alpha beta gamma delta", "=1", 6, "b"),
        (1, "other words altogether here", "x", 7, "c"), (None, "no key one two three", "null", 8, "d"),
        (None, "no key one two three", "null", 8, "d"), (None, "different again four five six", None, 9, "e"),
        (2, "ALPHA beta  gamma delta", "=2", 0, "f"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name string, told long, fp string")
    kept = dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    texts = sorted((r.doc_id or 0, r.text) for r in kept.collect())
    assert texts == [
        (0, "different again four five six"), (0, "no key one two three"),
        (1, "alpha beta gamma delta"), (1, "other words altogether here"),
    ]
