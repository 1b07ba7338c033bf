import random

import pytest
from pyspark.sql import functions as F

from lexweave.operators import ordering, token_tables as D
from lexweave.operators.vocabulary import Vocabulary
from lexweave.sources import sinks


def stream(spark, *arrays):
    rows = [(i, list(a), len(a)) for i, a in enumerate(arrays)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, ids ARRAY<INT>, n_tokens BIGINT")
    return D.token_offsets(df)


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("kind", ["sum", "min", "max"])
def test_running_values_match_brute_force(spark, parts, kind):
    pick = random.Random(3)
    keys = pick.sample(range(0, 1 << 30, 997), 400)
    data = [(k, "hot" if pick.random() < 0.7 else pick.choice("abc"), pick.randrange(-50, 50)) for k in keys]
    df = spark.createDataFrame(data, "k BIGINT, g STRING, v BIGINT").repartition(parts)
    out = ordering.running_before(df, "k", F.col("v"), "r", group=("g",), kind=kind)
    got = {r.k: r.r for r in out.collect()}
    function = {"sum": sum, "min": lambda x: min(x, default=None), "max": lambda x: max(x, default=None)}[kind]
    for k, g, _ in data:
        assert got[k] == function([v for kk, gg, v in data if gg == g and kk < k])


def test_ranks_are_exact_over_buckets(spark):
    df = spark.range(0, 20000, 3).withColumn("k", F.col("id") * 5)
    ranked = ordering.rank_before(df, "k", "rk")
    assert ranked.filter(F.col("rk") != F.col("id") / 3).isEmpty()


def test_windows_stay_small_for_hashed_keys(spark):
    rows = spark.range(3000).select(F.xxhash64("id").alias("k"), "id")
    want = {r.k: i for i, r in enumerate(sorted(rows.collect(), key=lambda r: r.k))}
    assert {r.k: r.rk for r in ordering.rank_before(rows, "k", "rk").collect()} == want
    # what a window can see: children of a bucket, and the topmost buckets of all 64-bit keys
    widths = [b - a for a, b in zip((0, *ordering.ID_SHIFTS), (*ordering.ID_SHIFTS, 64))]
    assert max(widths) <= 18


def test_several_running_values_in_one_pass(spark):
    df = spark.range(0, 9000, 7).withColumn("v", F.col("id") % 5)
    out = ordering.running_values(df, "id", {"n": F.lit(1).cast("bigint"), "s": F.col("v")})
    single = ordering.running_before(df, "id", F.col("v"), "s")
    assert {(r.id, r.s) for r in out.collect()} == {(r.id, r.s) for r in single.collect()}
    assert out.filter(F.col("n") != F.col("id") / 7).isEmpty()


def test_first_rows(spark):
    df = spark.range(20, 0, -1).withColumn("t", F.col("id").cast("string"))
    assert [r.t for r in ordering.first_rows(df, 3, "id").collect()] == ["1", "2", "3"]
    assert ordering.first_rows(df, 50, "id").count() == 20
    assert ordering.first_rows(df.limit(0), 2, "id").collect() == []


def test_shifted_window(spark):
    first = D.shifted_windows(stream(spark, [1, 2], [], [3, 4, 5]), 3, 1).orderBy("start").collect()
    assert [(r.start, r.inputs, r.targets) for r in first] == [
        (0, [1, 2, 3], [2, 3, 4]), (1, [2, 3, 4], [3, 4, 5]),
    ]


def test_short_stream_is_an_error(spark):
    with pytest.raises(ValueError, match="3 tokens but needs more than 3"):
        D.require_longer_than(stream(spark, [1, 2, 3]), 3)


def test_split_is_complete_and_cuts_inside_a_row(spark):
    table = stream(spark, range(7), range(7, 10), range(10, 21))
    pieces = D.contiguous_split(table, 0.6).orderBy("from_pos").collect()
    assert sum((list(p.ids) for p in pieces), []) == list(range(21))
    assert sum(p.n_tokens for p in pieces if p.split == "train") == int(21 * 0.6)
    assert [(p.doc_id, p.split, p["first"]) for p in pieces] == [
        (0, "train", 0), (1, "train", 0), (2, "train", 0), (2, "validation", 2),
    ]


def test_sampled_windows_are_real_windows(spark):
    data = list(range(100, 153))
    table = stream(spark, data[:20], data[20:21], data[21:])
    rows = D.sampled_windows(table, 6, spark.range(40).withColumnRenamed("id", "sample"), 9).collect()
    assert len(rows) == 40 and len({r.start for r in rows}) > 10
    for r in rows:
        assert 0 <= r.start < len(data) - 6
        assert (r.inputs, r.targets) == (data[r.start : r.start + 6], data[r.start + 1 : r.start + 7])


def test_few_samples_touch_few_rows(spark):
    table = stream(spark, *[range(i, i + 7) for i in range(300)], range(5_000))
    samples = spark.range(10).withColumnRenamed("id", "sample")
    rows = D.sampled_windows(table, 16, samples, 3).collect()
    data = [t for i in range(300) for t in range(i, i + 7)] + list(range(5_000))
    assert all((r.inputs, r.targets) == (data[r.start : r.start + 16], data[r.start + 1 : r.start + 17]) for r in rows)
    blocks = spark.createDataFrame([(r.start // 16 + k,) for r in rows for k in (0, 1)], "block BIGINT")
    touched = D._touched(table, blocks, 16).count()
    wanted = {s for s, n in ((r.start_pos, r.n_tokens) for r in table.collect())
              if any(s < (b.block + 1) * 16 and s + n > b.block * 16 for b in blocks.collect())}
    assert len(rows) == 10 and touched == len(wanted) <= 20 * 4


def test_batches_drop_only_where_told(spark):
    df = spark.range(10).withColumnRenamed("id", "rk")
    sizes = lambda drop: sorted(r.n_rows for r in D.batches(df, "rk", 4, drop_last=F.lit(drop)).collect())
    assert sizes(True) == [4, 4] and sizes(False) == [2, 4, 4]
    with pytest.raises(ValueError, match="too small"):
        D.require_batches(D.batches(df, "rk", 11, drop_last=F.lit(True)))


def test_cache_reuse_and_increment(spark, docs_of, base):
    stories = ["Élan one.", "two", " "] * 5
    first, reused = D.write_token_cache(docs_of(stories), Vocabulary(), base)
    assert not reused
    again, reused = D.write_token_cache(docs_of(stories), Vocabulary(), base)
    assert reused and again.count() == 10
    changed = stories + ["a story more"]
    changed[0] = "Other."
    later, reused = D.write_token_cache(docs_of(changed), Vocabulary(), base)
    full = D.story_tokens(docs_of(changed), Vocabulary())
    assert not reused
    assert sorted(later.select("doc_id", "ids").collect()) == sorted(full.select("doc_id", "ids").collect())
    _, reused = D.write_token_cache(docs_of(changed), Vocabulary(((4, 5, 260),)), base)
    assert not reused


def folder_rows(spark, base):
    """Rows and tombstones in the newest folder of a cache."""
    rows = spark.read.parquet(sinks.current_version(spark, base)["path"])
    return rows.filter("NOT gone").count(), rows.filter("gone").count()


def test_cache_deltas_and_compaction(spark, docs_of, base):
    texts = [f"story {i}" for i in range(30)]

    def check(reads, added, gone, max_deltas=4):
        live, reused = D.write_token_cache(docs_of(reads), Vocabulary(), base, max_deltas=max_deltas)
        want = D.story_tokens(docs_of(reads), Vocabulary()).select("doc_id", "ids").collect()
        assert not reused and sorted(live.select("doc_id", "ids").collect()) == sorted(want)
        assert folder_rows(spark, base) == (added, gone)
        again, reused = D.write_token_cache(docs_of(reads), Vocabulary(), base)
        assert reused and sorted(again.select("doc_id", "ids").collect()) == sorted(want)

    check(texts, 30, 0)
    check(texts + ["one more"], 1, 0)  # one row added, one row written
    check([*texts[:3], "another", *texts[4:], "one more"], 1, 1)
    check([*texts[:3], "another", *texts[4:]], 0, 1)
    check(texts, 1, 1)  # a text that comes back
    check(texts + ["and on"], 31, 0, max_deltas=3)  # written whole after so many deltas
    with pytest.raises(ValueError, match="no story"):
        D.write_token_cache(docs_of([" "]), Vocabulary(), base)


def test_repeated_rows_change_the_manifest(spark, docs_of, base):
    one = docs_of(["a story", "b story"])
    twice = one.union(one)
    assert D.cache_manifest(one, D.story_tokens(one, Vocabulary()), Vocabulary()).first().source_hash != (
        D.cache_manifest(twice, D.story_tokens(twice, Vocabulary()), Vocabulary()).first().source_hash
    )
    D.write_token_cache(one, Vocabulary(), base)
    live, reused = D.write_token_cache(twice, Vocabulary(), base)
    assert not reused and live.count() == 4
    live, reused = D.write_token_cache(one, Vocabulary(), base)
    assert not reused and live.count() == 2


def test_storage_type(spark):
    sizes = spark.createDataFrame([(260,), (65536,), (65537,), (2**31,)], "v BIGINT")
    assert [r.t for r in sizes.select(D.storage_type(F.col("v")).alias("t")).collect()] == [
        "uint16", "uint16", "int32", "int32",
    ]
    with pytest.raises(Exception, match="too large"):
        spark.range(1).select(D.storage_type(F.lit(2**31 + 1))).collect()
