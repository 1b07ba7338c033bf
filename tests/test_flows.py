import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexweave.operators.ngram import NgramModel, ngram_rows
from lexweave.operators.vocabulary import Vocabulary
from lexweave.plans import flows
from lexweave.sources import sinks
from test_choice import items
from test_instruction import records
from test_sources_sinks import text_of


def test_corpus_to_streams_to_model(spark, docs_of):
    docs = docs_of(["The machine learned. It asked a question."] * 40)
    data = flows.pretraining_data(docs, block_size=8, train_fraction=0.75, vocab_size=280)
    assert data.vocabulary.size == 280
    total = sum(d.agg(F.sum("n_tokens")).first()[0] for d in (data.train, data.validation))
    ids = [r.ids for r in data.train.orderBy("start_pos").collect()]
    assert data.train.agg(F.sum("n_tokens")).first()[0] == int(total * 0.75) == sum(map(len, ids))
    assert data.vocabulary.eos_id in ids[0]
    with pytest.raises(ValueError, match="needs more than"):
        flows.pretraining_data(docs, block_size=10_000, vocabulary=data.vocabulary)


def test_instructions(spark):
    rows = records(spark, *[(f"say {i}", "", "hello") for i in range(8)])
    encoded, stats = flows.instruction_data(rows, Vocabulary(), block_size=400, train_fraction=0.75)
    assert {r.split: r.kept_records for r in stats.collect()} == {"train": 6, "validation": 2}
    with pytest.raises(ValueError, match="exceeds"):
        flows.instruction_data(rows, Vocabulary(), block_size=10, max_seq_length=20)


def test_lines_report(spark, docs_of):
    uniform = lambda: lambda ids: np.full((*ids.shape, 260), -math.log(260))
    lines = docs_of(["", " = Title = ", "", " body of the text \n"])
    args = dict(block_size=16, stride=8, batch_size=2)
    whole = flows.evaluate_lines(lines, Vocabulary(), uniform, **args).first()
    assert (whole.tokens, whole.predictions) == (33, 32) and whole.perplexity == pytest.approx(260)
    part = flows.evaluate_lines(lines, Vocabulary(), uniform, max_tokens=20, **args).first()
    assert (part.predictions, part.evaluation_scope) == (19, "prefix_smoke_test")


@pytest.mark.parametrize("mode", ["completion", "instruction"])
def test_preferred_answer(spark, docs_of, mode):
    """A model that has only seen 'A' follow the prompt's ending answers A."""
    ending = "Answer: A" if mode == "completion" else "### Response:\nA"
    table = spark.createDataFrame([(0, ending)], "doc_id BIGINT, text STRING")
    from lexweave.operators.encoding import encode_corpus

    model = NgramModel.fit(ngram_rows(encode_corpus(table, Vocabulary())), 260)
    test = items(spark, 2).withColumn("answer", F.col("idx").cast("int"))
    preds, report = flows.evaluate_choices(
        test, items(spark, 3), Vocabulary(), model, block_size=2000, shots=2, prompt_mode=mode
    )
    assert [r.predicted for r in preds.orderBy("index").collect()] == [0, 0]
    row = report.first()
    assert (row.correct, row.accuracy, row.subject_count, row.requested_shots) == (1, 0.5, 1, 2)


def test_preferred_answer_of_a_user_model(spark):
    """A scorer that favours the byte of 'C' answers C, whatever the prompt mode."""
    favourite = Vocabulary().tokens.index(b"C")

    def make():
        def logs(ids):
            out = np.full((*ids.shape, 260), -6.0)
            out[..., favourite] = -1.0
            return out

        return logs

    test = items(spark, 4).withColumn("answer", F.col("idx").cast("int"))
    for mode in ("completion", "instruction"):
        preds, report = flows.evaluate_choices(
            test, items(spark, 3), Vocabulary(), make, block_size=700, shots=1, prompt_mode=mode
        )
        assert [r.predicted for r in preds.collect()] == [2] * 4
        assert report.first().accuracy == 0.25


def test_sample_report_file(spark, base):
    rows = spark.createDataFrame(
        [(0, "p", 1, 42, "Say", "", "Hi"), (1, "p", 2, 43, "Say", "in", "Ho")],
        "ord INT, id STRING, sample INT, seed INT, prompt STRING, input STRING, output STRING",
    )
    sinks.write_sample_report(rows, base, "ord", dict.fromkeys(sinks.REPORT_SETTINGS, "x"))
    text = text_of(spark, base)
    assert text.startswith("# Samples of generated text\n\n- Checkpoint: `x`\n")
    assert "with them.\n\n## p (sample 1, seed 42)\n\nPrompt:\n\n```text\nSay\n```\n\nModel output:" in text
    assert "```text\nHi\n```\n\n## p (sample 2" in text and text.endswith("```text\nHo\n```\n")


def test_samples_from_prompt_to_report(spark, base):
    from lexweave.constants import REPORT_SETTINGS
    from lexweave.operators.sampling import generate_with_scorer
    from lexweave.plans.flows import generate_samples
    from lexweave.sources import sinks

    vocabulary = Vocabulary()
    space, letter = (vocabulary.tokens.index(b) for b in (b" ", b"x"))

    def make_scorer():
        def score(contexts):  # a blank first, then letters, an end marker after three of those
            out = np.full((len(contexts), vocabulary.size), -50.0)
            for row, context in zip(out, contexts):
                run = len(context) - 1 - max([i for i, t in enumerate(context) if t != letter], default=-1)
                row[vocabulary.eos_id if run == 3 else letter if run or context[-1] == space else space] = 50.0
            return out
        return score

    def generate(plan):
        return generate_with_scorer(
            plan, make_scorer, block_size=64, temperature=1.0, top_k=None, max_new_tokens=8, eos_id=vocabulary.eos_id
        )

    options = dict(block_size=400, samples_per_prompt=2, seed=5)
    rows = [(7, "a", "Say it.", ""), (9, "b", "Say more.", "word " * 200)]
    prompts = spark.createDataFrame(rows, "ord BIGINT, id STRING, instruction STRING, input STRING")
    got = generate_samples(prompts, vocabulary, generate, mode="instruction", **options).orderBy("sample_index").collect()
    assert [(r.id, r.sample, r.seed, r.input_truncated) for r in got] == [
        ("a", 1, 5, False), ("a", 2, 6, False), ("b", 1, 7, True), ("b", 2, 8, True)
    ]
    # new tokens alone, decoded without the end marker and stripped
    assert {r.output for r in got} == {"xxx"} and got[2].prompt_tokens <= 400
    assert got[0].new_ids == [space, letter, letter, letter, vocabulary.eos_id]

    plain = prompts.select("ord", "id", F.col("instruction").alias("prompt"))
    table = generate_samples(plain, vocabulary, generate, mode="completion", **options)
    assert {r.prompt_tokens for r in table.collect()} == {7, 9}
    sinks.write_sample_report(table, base, "sample_index", dict.fromkeys(REPORT_SETTINGS, 1))
    lines = [r.value for r in sinks.read_published(spark, base).collect()]
    assert sum(line.startswith("## ") for line in lines) == 4

    with pytest.raises(Exception, match="does not fit"):
        generate_samples(prompts, vocabulary, generate, mode="instruction", block_size=20, samples_per_prompt=1, seed=1).collect()
