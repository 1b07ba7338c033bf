import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from lexweave.llm import decontam, fingerprints, sharding, warc
from lexweave.session import fresh_path


def words_of(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[\u0080-©«-´¶-¹»-¿\u2000-\u206f]", " ", (text or "").lower()))


def shingles(words, n):
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}


def slow_matches(docs, items):
    out = set()
    for d in docs:
        words = words_of(d.text)
        for i in items:
            item = words_of(i.text)
            n = min(len(item), 5)
            own = shingles(item, n) if item else set()
            shared = own & shingles(words, n)
            if own and len(shared) >= 0.8 * len(own) - 1e-9:
                out.add((d.doc_id, i.item_id, len(shared), len(own)))
    return out


def test_decontamination_matches_brute_force(spark, sample):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    text = items.first().text.split()
    short = [(900, " ".join(text[: len(text) // 2]), *[None] * 3), (901, "before it " + " ".join(text).upper() + " after", *[None] * 3)]
    docs = sample.union(spark.createDataFrame(short, sample.schema))
    wanted = slow_matches(docs.collect(), items.collect())
    assert 901 in {w[0] for w in wanted}
    for size in (decontam.BLOCK_BYTES, 2000):
        rows = decontam.contaminated(docs, items, block_bytes=size).collect()
        assert {(r.doc_id, r.item_id, r.shared, r.size) for r in rows} == wanted and len(rows) == len(wanted)
    kept = decontam.drop_contaminated(docs, items)
    assert kept.count() == docs.count() - len({w[0] for w in wanted})


def test_short_items_are_found_inside_documents(spark, no_docs):
    texts = ["we say here: the capital of France is old", "capital of", "of capital france", "the Capital, of france!", "one word", "", None, "x " * 70000 + "capital of france"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0])], "doc_id long, text string")
    rows = [(1, "capital of France"), (2, "word"), (3, "the capital of france is"), (4, "capital of france is"), (5, "capital of france"), (6, "x x"), (7, "here the capital of france is old")]
    items = spark.createDataFrame(rows, "item_id long, text string")
    found = decontam.contaminated(docs, items).collect()
    wanted = slow_matches(docs.distinct().collect(), items.collect())
    assert {(r.doc_id, r.item_id, r.shared, r.size) for r in found} == wanted
    assert len(found) == len(wanted) + len([w for w in wanted if w[0] == 0])  # the repeated document
    assert {w[:2] for w in wanted} >= {(0, 1), (0, 3), (0, 4), (0, 5), (0, 7), (3, 1), (4, 2), (7, 1), (7, 6)}
    assert {r.doc_id for r in decontam.drop_contaminated(docs, items).collect()} == {1, 2, 5, 6}


def test_decontamination_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(1, None), (2, ""), (3, "plain text about rivers and hills"), (4, "plain text about rivers and hills"), (None, "a plain text about rivers and hills and towns"), (5, "two words")]
    items = spark.createDataFrame(rows, "item_id long, text string")
    found = decontam.contaminated(odd_docs, items).collect()
    assert Counter((r.doc_id, r.item_id) for r in found) == Counter({(1, 3): 2, (1, 4): 2, (1, None): 2, (2, 3): 1, (2, 4): 1, (2, None): 1})
    assert decontam.drop_contaminated(odd_docs, items).columns == odd_docs.columns
    assert decontam.drop_contaminated(odd_docs, items).count() == 8
    assert decontam.contaminated(no_docs, items).count() == 0
    assert decontam.drop_contaminated(odd_docs, items.filter("false")).count() == odd_docs.count()


PAGES = "page_id long, url string, html string"


def slow_archive(pages):
    kept = {}
    for p in pages:
        body = (p.html or "").encode()
        if len(body) >= 1000 and p.page_id is not None:
            kept[body] = max(kept.get(body, p.page_id), p.page_id)
    out = Counter()
    for p in pages:
        body = (p.html or "").encode()
        again = p.page_id is not None and kept.get(body, p.page_id) > p.page_id
        out[(p.page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", kept[body] if again else None)] += 1
    return out


@pytest.mark.parametrize("split", [3000, 1 << 24])
def test_archive_round_trip(spark, split):
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(901, "u", "é" * 2000), (902, "u\nv", "é" * 2000), (900, None, "é" * 2000), (902, "u", "é" * 2000), (903, "u", None), (904, "u", ""), (905, "u", "short"), (906, "u", "short"), (None, "u", "é" * 2000), (None, None, None)]
    pages = given.union(spark.createDataFrame(rows, PAGES))
    found = warc.archive_pages(spark, pages, split_bytes=split).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == slow_archive(pages.collect())
    assert warc.archive_pages(spark, pages.filter("false")).count() == 0


def test_records_inside_payloads_are_not_records(spark):
    """A payload that is itself an archive, stored without compression, holds true members."""
    inner = warc.member(warc.record("response", "urn:page:1", "u", None, hashlib.sha1(b"inner").digest(), 5, b"inner"))
    rows = []
    for i in range(40):
        payload = inner * 5 + bytes([i])
        rows.append(("response", f"urn:page:{i}", "u", None, bytearray(hashlib.sha1(payload).digest()), len(payload), bytearray(payload)))
    kinds = "kind string, record_id string, uri string, refers_to string, digest binary, size long, payload binary"
    files = warc.write_warc(spark.createDataFrame(rows, kinds).coalesce(1), fresh_path(spark, "nested"), level=0)
    for split in (500, 777, 4096):
        found = warc.read_warc(files, split).collect()
        assert sorted(r.record_id for r in found) == sorted(r[1] for r in rows)
        assert sum(r.member_bytes for r in found) == files.first().length
        assert {bytes(r.payload) for r in found} == {bytes(r[6]) for r in rows}


def test_damage_stops_the_reader(spark, tmp_path):
    good = warc.member(warc.record("response", "urn:page:1", "u", None, hashlib.sha1(b"x").digest(), 1, b"y"))
    (tmp_path / "a.warc.gz").write_bytes(good)
    files = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz", len(good))], "path string, length long")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_warc(files).collect()


def test_shards_match_the_mixture(sample, odd_docs, no_docs):
    for docs in (sample, odd_docs):
        rows, n = sharding.shard_documents(docs).collect(), docs.count()
        shards = defaultdict(list)
        for r in rows:
            shards[r.shard].append(r)
        sizes = [len(shards[s]) for s in range(40)]
        assert len(rows) == n and max(sizes) - min(sizes) <= 1
        assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in shards.values())
        for source in {r.source for r in rows}:
            counts = [sum(r.source == source for r in shards[s]) for s in range(40)]
            assert max(counts) - min(counts) <= 2
        wanted = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == wanted
    assert sharding.shard_documents(no_docs).count() == 0


def test_null_source_is_apart_from_its_name(spark):
    rows = [(i, f"text {i}", None if i % 2 else "null") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    counts = defaultdict(int)
    for r in sharding.shard_documents(docs).collect():
        counts[r.shard, r.source] += 1
    assert all(counts[s, source] == 5 for s in range(40) for source in (None, "null"))


def test_shards_equal_a_plain_sort(sample):
    rows = [(r.source, hashlib.md5(f"17:{r.doc_id}".encode()).hexdigest(), r.doc_id) for r in sample.collect()]
    sizes, seen, order = Counter(r[0] for r in rows), Counter(), []
    for source, _, key in sorted(rows):
        order.append(((2 * seen[source] + 1) / (2 * sizes[source]), "{" + source + "}", seen[source], key))
        seen[source] += 1
    wanted = {key: i * 40 // len(rows) for i, (*_, key) in enumerate(sorted(order))}
    assert {r.doc_id: r.shard for r in sharding.shard_documents(sample).collect()} == wanted


def test_written_shards_hold_the_texts(spark, sample):
    path = fresh_path(spark, "shards")
    sharding.write_shards(sample, sharding.shard_documents(sample), path)
    back = spark.read.parquet(path)
    assert {(r.doc_id, r.text) for r in back.collect()} == {(r.doc_id, r.text) for r in sample.collect()}


def test_fingerprints_of_edited_and_next_texts(sample):
    rows = {r.doc_id: r for r in fingerprints.fingerprint_documents(sample).collect()}
    docs = sorted(((r.doc_id, r.text) for r in sample.collect()), reverse=True)
    prints = {i: int(r.fingerprint, 16) for i, r in rows.items()}
    for (i, text), (j, following) in zip(docs, [*docs[1:], docs[0]]):
        k = len(text) // 3
        edited = text[: len(text) - k] + following[:k]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_next == pytest.approx(1 - (prints[i] ^ prints[j]).bit_count() / 128)
        assert r.near_edited == pytest.approx(1 - (prints[i] ^ int(r.edited_fingerprint, 16)).bit_count() / 128)
        near = sum((prints[i] ^ v).bit_count() <= 3 for v in set(prints.values())) - 1
        assert r.n_within == (near if i % 20 == 0 else None)
    same = defaultdict(set)
    for i, text in docs:
        same[text].add(prints[i])
    assert all(len(v) == 1 for v in same.values())


def test_fingerprint_search_is_exact(spark):
    import random

    rng, values = random.Random(5), set()
    for _ in range(30):
        v = rng.getrandbits(128)
        for _ in range(6):
            values.add(v)
            v ^= 1 << rng.randrange(128)
    frame = spark.createDataFrame([(bytearray(v.to_bytes(16)),) for v in values], "fp binary")
    for radius in (0, 1, 3, 6):
        found = {(bytes(r.query), bytes(r.fp)) for r in fingerprints.within_radius(frame, frame, radius).collect()}
        assert found == {(a.to_bytes(16), b.to_bytes(16)) for a in values for b in values if (a ^ b).bit_count() <= radius}


def test_fingerprints_of_odd_rows(odd_docs, no_docs):
    rows = fingerprints.fingerprint_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 2)}) == 1
    assert {r.fingerprint for r in rows if r.doc_id in (3, 4)} == {"0" * 32}
    assert fingerprints.fingerprint_documents(no_docs).count() == 0
    one = fingerprints.fingerprint_documents(odd_docs.filter("doc_id = 8")).collect()
    assert one[0].near_next == 1
