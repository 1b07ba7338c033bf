"""Steps that carry whole corpora: ids and windows placed as texts, records made once, shots counted in pieces."""

import numpy as np
from pyspark.sql import functions as F

from lexweave.functions.tokens import byte_ids
from lexweave.operators import choice_eval as C
from lexweave.operators import instruction as I
from lexweave.operators import lm_eval as E
from lexweave.operators import token_tables as D
from lexweave.operators.encoding import byte_ids_of, piecewise_count_udf, token_count_udf
from lexweave.operators.vocabulary import Vocabulary, train_vocabulary

TEXTS = ["", None, "a<eos>b", "<unk><pad>", "<eo", "s>é漢 \x00", "<<bos>>", "x" * 300]


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_arrow_byte_ids_equal_the_column_function(spark, docs_of):
    rows = docs_of(TEXTS).repartition(1)
    both = rows.select(byte_ids(F.col("text")).alias("a"), byte_ids_of(F.col("text")).alias("b"))
    assert all(r.a == r.b for r in both.collect())


def test_story_offsets_shuffle_no_id_arrays(spark, docs_of):
    rows = docs_of([t for t in TEXTS if t] * 3)
    plain = D.token_offsets(D.story_tokens(rows, Vocabulary()))
    placed = D.story_offsets(rows, Vocabulary())
    names = ["doc_id", "ids", "n_tokens", "start_pos"]
    assert sorted(map(tuple, placed.select(names).collect())) == sorted(map(tuple, plain.select(names).collect()))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanged and plan.index("byte_ids_of") < plan.index("Exchange")


def test_neighbouring_windows_travel_together(spark, docs_of):
    rng = np.random.default_rng(3)
    rows = docs_of(["y" * int(n) for n in rng.integers(1, 90, 60)])
    stream = D.story_offsets(rows, Vocabulary()).localCheckpoint()
    ids = [i for r in stream.orderBy("start_pos").collect() for i in r.ids]
    for block, stride in ((16, 16), (16, 5), (8, 8)):
        got = {r.start: (r.inputs, r.targets) for r in D.shifted_windows(stream, block, stride).collect()}
        assert got == {
            s: (ids[s : s + block], ids[s + 1 : s + block + 1]) for s in range(0, len(ids) - block, stride)
        }
    sent = E.window_tokens(stream, 16, 4)
    assert sum(len(r.targets) - r.targets.count(-100) for r in sent.collect()) == len(ids) - 1
    assert "__group" in plan_of(sent)


def test_a_record_is_fitted_and_encoded_once(spark):
    rows = spark.createDataFrame(
        [(1, "do", "ab<eos>" * 400, "yes"), (2, "do", "é" * 900, "n" * 900), (3, "do", "", ""), (4, None, "x", "y")],
        "rec_id BIGINT, instruction STRING, input STRING, output STRING",
    )
    coded = I.encode_records(rows, Vocabulary(), 400)
    kept = coded.filter("outcome = 'kept'").select("rec_id", F.posexplode("targets"))
    assert plan_of(kept).count("aggregate(") <= 1
    found = {r.rec_id: r for r in coded.collect()}
    assert found[4].outcome == "prompt_too_long"
    assert found[3].outcome == "empty_response" and found[3].tokens is None
    assert all(len(found[i].tokens) == len(found[i].targets) <= 400 and found[i].input_truncated for i in (1, 2))


def test_shots_counted_in_pieces_equal_whole_prompts(spark, docs_of):
    learned = train_vocabulary(docs_of(["the cat\n\nsat on\n\nthe mat\n\n"] * 5), 290, 2)
    shots = ["the cat\nAnswer: A\n\n", "<eos> mat\nAnswer: B\n\n", "\nblank first\n\n", "no end"]
    rows = spark.createDataFrame(
        [(1, "On the cat.\n\n", shots[:1], "the mat"), (2, "On.\n\n", shots[:2], "<pad>the"),
         (3, "On.\n\n", shots, " the"), (4, "On.\n\n", [], "cat"), (5, None, [], "cat")],
        "idx INT, head STRING, demos ARRAY<STRING>, tail STRING",
    )
    sizes = rows.withColumn("n", piecewise_count_udf(learned)(F.col("head"), F.col("demos"), F.col("tail")))
    each = sizes.select("idx", "head", "demos", "tail", F.posexplode("n").alias("k", "n"))
    whole = F.concat("head", F.array_join(F.slice("demos", F.lit(1), F.col("k")), ""), "tail")
    checked = each.withColumn("m", token_count_udf(learned)(whole)).collect()
    assert len(checked) == 2 + 3 + 5 + 1 and all(r.n == r.m for r in checked)


def test_piecewise_fit_equals_the_whole_fit_in_both_modes(spark, docs_of):
    learned = train_vocabulary(docs_of(["the cat sat on the mat"] * 5), 290, 2)
    rows = spark.createDataFrame(
        [(i, "s", f"q{i}\r\nthe cat", list("abcd"), i % 4) for i in range(6)],
        "idx INT, subject STRING, question STRING, choices ARRAY<STRING>, answer INT",
    )
    asked = C.with_demonstrations(rows, rows, 3)
    names = ["idx", "effective_shots", "prompt_size", "prompt_left_truncated", "prompt"]
    for mode in ("completion", "instruction"):
        for block in (10, 90, 160, 1000):
            whole = C.fit_few_shot_tokens(asked, block, F.lit(mode), token_count_udf(learned))
            pieces = C.fit_few_shot_pieces(asked, block, F.lit(mode), piecewise_count_udf(learned))
            assert sorted(map(tuple, whole.select(names).collect())) == sorted(map(tuple, pieces.select(names).collect()))


def test_a_subject_with_most_questions_is_not_shuffled_to_one_task(spark):
    rows = spark.range(400).selectExpr(
        "id AS idx", "'s' AS subject", "'q' AS question", "array('a', 'b', 'c', 'd') AS choices", "0 AS answer"
    )
    odd = rows.limit(1).selectExpr("idx", "CAST(null AS STRING) AS subject", "question", "choices", "answer")
    found = C.with_demonstrations(rows.unionByName(odd), rows.limit(5), 2)
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.n_demos for r in found.collect()) == [0] + [2] * 400


def columns_of(df, *names: str) -> list[list[str]]:
    """Output columns of the planned operators with these names."""
    def walk(node):
        children = node.children()
        below = [found for i in range(children.size()) for found in walk(children.apply(i))]
        return below + [node] if node.nodeName() in names else below

    nodes = walk(df._jdf.queryExecution().sparkPlan())
    return [[node.output().apply(i).name() for i in range(node.output().size())] for node in nodes]


def test_placing_a_stream_sorts_lengths_and_never_texts(spark, docs_of):
    rows = docs_of([t for t in TEXTS if t] * 3)
    rows = rows.unionByName(rows.limit(2)).unionByName(rows.limit(1))  # repeated rows keep places of their own
    learned = train_vocabulary(docs_of(["the cat sat on the mat"] * 5), 290, 2)
    for vocabulary in (Vocabulary(), learned):
        placed = D.story_offsets(rows, vocabulary)
        ordering = columns_of(placed, "Window", "SortMergeJoin")
        assert ordering and not any({"text", "ids"} & set(names) for names in ordering)
        assert columns_of(placed, "ShuffledHashJoin")
        found = sorted((r.start_pos, r.doc_id, r.n_tokens, tuple(r.ids)) for r in placed.collect())
        ends = [start + n for start, _, n, _ in found]
        assert [start for start, *_ in found] == [0, *ends[:-1]] and all(len(ids) == n for *_, n, ids in found)
        assert [doc for _, doc, *_ in found] == sorted(r.doc_id for r in rows.collect())


def test_windows_inside_a_row_are_not_sent(spark):
    rng = np.random.default_rng(5)
    sizes = [int(n) for n in (*rng.integers(0, 9, 30), 700, *rng.integers(1, 40, 30), 400, 17, 33, *rng.integers(0, 3, 9))]
    ids = rng.integers(0, 260, sum(sizes)).tolist()
    ends = np.cumsum(sizes).tolist()
    rows = [(e - n, n, ids[e - n : e]) for n, e in zip(sizes, ends)]
    stream = spark.createDataFrame(rows, "start_pos BIGINT, n_tokens BIGINT, ids ARRAY<INT>").repartition(3)
    for block, stride in ((16, 16), (16, 8), (16, 3), (16, 1), (5, 20), (40, 7)):
        got = sorted((r.start, r.inputs, r.targets) for r in D.shifted_windows(stream, block, stride).collect())
        assert got == [(s, ids[s : s + block], ids[s + 1 : s + block + 1]) for s in range(0, len(ids) - block, stride)]
        if stride > block:
            continue
        sent = sorted((r.window_id, r.context_start, r.ignored, r.inputs, r.targets) for r in E.window_tokens(stream, block, stride).collect())
        want = []
        for w, first in enumerate(range(1, len(ids), stride)):
            end = min(first + stride, len(ids))
            at = max(0, end - 1 - block)
            skip = first - at - 1
            want.append((w, at, skip, ids[at : end - 1], [-100] * skip + ids[at + 1 + skip : end]))
        assert sent == want


def test_what_crosses_rows_is_bounded_by_the_block(spark):
    rows = [(0, 9000, list(range(9000))), (9000, 7000, list(range(7000)))]
    stream = spark.createDataFrame(rows, "start_pos BIGINT, n_tokens BIGINT, ids ARRAY<INT>")
    start, stop = F.col("start_pos"), F.col("start_pos") + F.col("n_tokens")
    begin, end = (lambda k: k * 8), (lambda k: k * 8 + 17)
    rows = D._touching(stream, F.greatest(F.lit(0), F.ceil((start - 16) / 8)), F.floor((stop - 1) / 8), begin, end, ())
    pieces = D._edge_pieces(rows, begin, end, 512, ()).collect()
    assert 0 < sum(len(p.piece) for p in pieces) < 200


def test_samples_join_prompts_without_their_ids(spark):
    from lexweave.plans.flows import generate_samples

    prompts = spark.createDataFrame([(3, "a", "x" * 50), (9, "b", "<eos>y"), (5, "c", "")], "ord BIGINT, id STRING, prompt STRING")
    table = generate_samples(
        prompts, Vocabulary(), lambda plan: plan.select("sample_index", F.array(F.lit(4)).alias("new_ids")),
        mode="completion", block_size=8, samples_per_prompt=2, seed=1,
    )
    asked = table.select("id", "sample", "sample_index", "seed", "prompt_tokens", "new_ids")
    scanned = [names for names in columns_of(asked, "Scan parquet ") if names]
    assert scanned and not any("prompt_ids" in names for names in scanned)
    assert sorted(map(tuple, asked.collect())) == sorted(
        (name, s, 2 * place + s - 1, 2 * place + s, size, [4])
        for place, (name, size) in enumerate((("a", 50), ("c", 0), ("b", 2))) for s in (1, 2)
    )
