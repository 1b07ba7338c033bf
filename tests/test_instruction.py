import pytest
from pyspark.sql import functions as F

from lexweave.constants import EOS_ID, IGNORE_INDEX, PAD_ID, PROMPT_WITH_INPUT, PROMPT_WITHOUT_INPUT
from lexweave.functions.metrics import train_size
from lexweave.functions.prompts import instruction_prompt
from lexweave.functions.tokens import byte_order
from lexweave.operators import instruction as I
from lexweave.operators.encoding import text_encoder
from lexweave.operators.vocabulary import Vocabulary, train_vocabulary


def records(spark, *rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "rec_id BIGINT, instruction STRING, input STRING, output STRING",
    )


def bytes_to_ids(text):
    order = byte_order()
    return [4 + order.index(b) for b in text.encode()]


def test_templates(spark):
    rows = records(spark, (" Add.\r\n", " 2 + 2 ", ""), ("Name", " \n", ""))
    got = rows.select("rec_id", instruction_prompt(F.col("instruction"), F.col("input")).alias("p")).orderBy("rec_id")
    assert [r.p for r in got.collect()] == [
        PROMPT_WITH_INPUT.format(instruction="Add.", input="2 + 2"),
        PROMPT_WITHOUT_INPUT.format(instruction="Name"),
    ]
    with pytest.raises(Exception, match="instruction cannot be empty"):
        records(spark, ("  ", "", "")).select(instruction_prompt(F.col("instruction"))).collect()


def test_split_is_seeded_disjoint_and_complete(spark):
    rows = records(spark, *[(f"task {i}", "", "x") for i in range(20)])
    take = lambda df: {s: {r.rec_id for r in df.filter(F.col("split") == s).collect()} for s in ("train", "validation")}
    a = take(I.seeded_split(rows, 0.75, 7, 12))
    assert (len(a["train"]), len(a["validation"])) == (9, 3) and not a["train"] & a["validation"]
    assert a == take(I.seeded_split(rows.repartition(5), 0.75, 7, 12))
    assert a != take(I.seeded_split(rows, 0.75, 8, 12))
    whole = take(I.seeded_split(rows, 0.75, 7))
    assert whole["train"] | whole["validation"] == set(range(20))
    with pytest.raises(ValueError, match="two records"):
        I.seeded_split(rows, 0.75, 7, 1)
    with pytest.raises(Exception, match="two records"):
        I.seeded_split(rows.limit(1), 0.75, 7).collect()


def test_published_split_size(spark):
    row = spark.range(1).select(train_size(F.lit(52002), 0.95).alias("n"), train_size(F.lit(2), 0.1).alias("m")).first()
    assert (row.n, row.m) == (49401, 1)


def test_targets_mask_the_prompt(spark):
    row = I.encode_records(records(spark, ("Add.", "2 + 2", "4")), Vocabulary(), 1024).first()
    prompt = bytes_to_ids(PROMPT_WITH_INPUT.format(instruction="Add.", input="2 + 2"))
    answer = bytes_to_ids("4")
    assert row.tokens == prompt + answer
    assert row.targets == [IGNORE_INDEX] * (len(prompt) - 1) + answer + [EOS_ID]
    assert (row.outcome, row.input_truncated, row.response_truncated) == ("kept", False, False)


def test_long_input_goes_before_the_response(spark):
    minimal = len(bytes_to_ids(PROMPT_WITHOUT_INPUT.format(instruction="Sum.")))
    rows = records(spark, ("Sum.", "context " * 100, "response " * 100))
    row = I.encode_records(rows, Vocabulary(), minimal + 5).first()
    assert row.input_truncated and row.response_truncated and len(row.tokens) == minimal + 5


def test_skips_are_counted(spark):
    rows = records(spark, ("Say", "", "hi"), ("Say", "", " \n"), ("word " * 1000, "", "x"))
    coded = I.encode_records(rows, Vocabulary(), 180)
    stats = I.instruction_stats(coded).first()
    assert (stats.total_records, stats.kept_records, stats.empty_responses, stats.prompts_too_long) == (3, 1, 1, 1)
    with pytest.raises(ValueError, match="no instruction records"):
        I.kept_records(coded.filter(F.col("outcome") != "kept"))
    with pytest.raises(ValueError, match="exceeds block_size"):
        I.check_lengths(200, 100)


@pytest.mark.parametrize("learned", [False, True])
def test_fitted_prompts_match_direct_search(spark, docs_of, learned):
    text = "context of the café " * 30
    vocabulary = train_vocabulary(docs_of([text * 3, PROMPT_WITH_INPUT]), 300, 2) if learned else Vocabulary()
    encode = text_encoder(vocabulary)
    rows = records(spark, ("Summarize.", text, ""), ("Summarize.", "short", ""), ("Summarize.", "", ""), ("word " * 300, "", ""), ("é", "a<eos>" * 90, ""))
    minimal = len(encode(PROMPT_WITHOUT_INPUT.format(instruction="Summarize.")))
    for limit in (minimal + 1, minimal + 120):
        got = {r.rec_id: (r.prompt, r.input_truncated) for r in I.fit_prompts(rows, vocabulary, limit).collect()}
        for r in rows.collect():
            plain = PROMPT_WITHOUT_INPUT.format(instruction=r.instruction.strip())
            full = PROMPT_WITH_INPUT.replace("{instruction}", r.instruction.strip())
            given = r.input.strip()
            fits = lambda t: len(encode(t)) + 1 <= limit
            if not fits(plain):
                want = (None, False)
            elif not given:
                want = (plain, False)
            elif fits(full.replace("{input}", given)):
                want = (full.replace("{input}", given), False)
            else:
                low, high = 0, len(given)
                while low < high:
                    mid = (low + high + 1) // 2
                    low, high = (mid, high) if fits(full.replace("{input}", given[:mid])) else (low, mid - 1)
                want = (full.replace("{input}", given[:low]) if low else plain, True)
            assert got[r.rec_id] == want


def test_char_fit_is_the_longest_prefix(spark):
    rows = records(spark, ("Go", "abcdef", ""), ("Go", "", ""), ("Go" * 99, "x", ""))
    base = len(PROMPT_WITH_INPUT.format(instruction="Go", input=""))
    got = [(r.prompt, r.input_truncated) for r in I.fit_prompts_by_chars(rows, base + 4, 1).orderBy("rec_id").collect()]
    assert got[0] == (PROMPT_WITH_INPUT.format(instruction="Go", input="abc"), True)
    assert got[1] == (PROMPT_WITHOUT_INPUT.format(instruction="Go"), False)
    with pytest.raises(Exception, match="prompt 1 does not fit"):
        tight = I.fit_prompts_by_chars(rows.filter("rec_id = 1"), 10, 0)
        I.require_fitting(tight, "rec_id").collect()


def test_learned_encoding_of_records(spark, docs_of):
    rows = records(spark, ("Add the numbers", "2 and 3", "the numbers add to 5"), ("Say hi", "", ""))
    vocabulary = train_vocabulary(docs_of(["the numbers add the numbers and the rest"]), 290, 1)
    encode = text_encoder(vocabulary)
    got = {r.rec_id: r for r in I.encode_records(rows, vocabulary, 1024).collect()}
    prompt = encode(PROMPT_WITH_INPUT.format(instruction="Add the numbers", input="2 and 3"))
    assert got[0].tokens == prompt + encode("the numbers add to 5")
    assert got[1].outcome == "empty_response" and got[1].tokens is None


def test_padding_to_the_longest_of_a_batch(spark):
    rows = spark.createDataFrame(
        [(0, [5, 6], [7, 2]), (1, [5], [2]), (2, [9], [2])], "rk BIGINT, tokens ARRAY<INT>, targets ARRAY<INT>"
    )
    got = I.padded_batches(rows, "rk", 2).orderBy("rk").collect()
    assert [r.tokens for r in got] == [[5, 6], [5, PAD_ID], [9]]
    assert [r.targets for r in got] == [[7, 2], [2, IGNORE_INDEX], [2]]


def test_blank_instruction_without_a_response_is_counted(spark):
    rows = [(1, "  ", "", ""), (2, "Say", "", None), (3, "Say", "", "Hi")]
    df = spark.createDataFrame(rows, "rec_id BIGINT, instruction STRING, input STRING, output STRING")
    got = {r.rec_id: r.outcome for r in I.encode_records(df, Vocabulary(), 200).collect()}
    assert got == {1: "empty_response", 2: "empty_response", 3: "kept"}
