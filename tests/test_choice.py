import numpy as np
import pytest
from pyspark.sql import functions as F

from lexweave.functions.metrics import wilson_bounds
from lexweave.functions.prompts import choice_example, choice_prompt, in_mode, resolve_mode
from lexweave.operators import choice_eval as C, reports as R

QUESTION = ("Which option should be selected? ", ["alpha", " beta", "gamma", "delta"], 1)
HEADER = "The following are multiple choice questions (with answers) about test subject.\n\n"
BODY = "Which option should be selected?\nA. alpha\nB. beta\nC. gamma\nD. delta\nAnswer:"


def items(spark, n=1, subject="test_subject"):
    rows = [(i, QUESTION[0], subject, QUESTION[1], (QUESTION[2] + i) % 4) for i in range(n)]
    return spark.createDataFrame(rows, "idx BIGINT, question STRING, subject STRING, choices ARRAY<STRING>, answer INT")


def one(df, column):
    return df.select(column.alias("r")).first().r


def test_prompt_wording(spark):
    df = items(spark)
    q, c = F.col("question"), F.col("choices")
    assert one(df, choice_example(q, c, F.col("answer"))) == BODY + " B\n\n"
    assert one(df, choice_example(q, c)) == BODY + "\n\n"
    assert one(df, choice_prompt(F.col("subject"), q, c)) == HEADER + BODY
    shots = F.array(F.lit("one\n\n"), F.lit("two\n\n"))
    assert one(df, choice_prompt(F.col("subject"), q, c, shots)) == HEADER + "one\n\ntwo\n\n" + BODY
    wrapped = one(df, in_mode(choice_prompt(F.col("subject"), q, c), F.lit("instruction")))
    assert f"### Instruction:\n{HEADER}{BODY}" in wrapped and wrapped.endswith("### Response:\n")


def test_auto_mode_follows_the_stage(spark):
    df = spark.createDataFrame([("auto", "sft"), ("auto", "pretrain"), ("completion", "sft")], "m STRING, s STRING")
    got = [r.r for r in df.select(resolve_mode(F.col("m"), F.col("s")).alias("r")).collect()]
    assert got == ["instruction", "completion", "completion"]


def test_candidates_follow_the_mode(spark):
    for mode, want in (("completion", [" A", " B", " C", " D"]), ("instruction", list("ABCD"))):
        rows = C.candidates(items(spark), F.lit(mode)).orderBy("label_index").collect()
        assert [r.continuation for r in rows] == want


def test_demonstrations_keep_source_order(spark):
    dev = items(spark, 5).unionByName(items(spark, 1, "rare"))
    got = C.with_demonstrations(items(spark), dev, 2).first()
    assert [d.split("Answer: ")[1][0] for d in got.demos] == ["B", "C"]
    ranks = C.by_subject(dev).filter("subject = 'test_subject'").orderBy("idx").collect()
    assert [r.ord for r in ranks] == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="'rare' has 1 few-shot examples; 2 requested"):
        C.require_demonstrations(items(spark, 1, "rare"), dev, 2)
    with pytest.raises(ValueError, match="'none' has 0"):
        C.require_demonstrations(items(spark, 1, "none"), dev, 1)
    assert C.require_demonstrations(items(spark), dev, 0).first().demos == []


@pytest.mark.parametrize("room,shots,cut", [(10_000, 3, False), (0, 2, False), (-100, 0, False), (-400, 0, True)])
def test_trailing_shots_are_dropped(spark, room, shots, cut):
    rows = C.with_demonstrations(items(spark), items(spark, 3), 3)
    demo = len(BODY) + 4
    limit = len(HEADER) + len(BODY) + 2 * demo + room
    got = C.fit_few_shot(rows, limit, F.lit("completion"), F.length).first()
    assert (got.effective_shots, got.prompt_left_truncated) == (shots, cut)
    assert got.prompt_size == len(got.prompt) and got.prompt.endswith(BODY)
    same = C.fit_few_shot_tokens(rows, limit, F.lit("completion"), F.length).first()
    assert (same.effective_shots, same.prompt, same.prompt_left_truncated) == (shots, got.prompt, cut)


def test_subject_selection(spark):
    df = items(spark).unionByName(items(spark, 1, "other"))
    assert C.select_subjects(df, ["other"]).count() == 1
    with pytest.raises(ValueError, match=r"\['a', 'z'\]"):
        C.select_subjects(df, ["z", "other", "a"])
    asked = spark.createDataFrame([("z",), ("other",)], "subject STRING")
    assert [r.subject for r in C.unknown_subjects(df, asked).collect()] == ["z"]


def scored(spark):
    df = items(spark, 2).withColumn("answer", F.col("idx").cast("int"))
    return df.withColumn("scores", F.array(*[F.lit(s) for s in (-1.0, -2.0, -1.0, -3.0)]))


def test_predictions_and_summaries(spark):
    preds = C.predictions(scored(spark)).orderBy("index")
    rows = preds.collect()
    assert [r.predicted for r in rows] == [0, 0] and [r.correct for r in rows] == [True, False]
    assert rows[0].choice_log_likelihoods == {"A": -1.0, "B": -2.0, "C": -1.0, "D": -3.0}
    assert C.accuracy_summary(preds).first().accuracy == 0.5
    assert C.macro_accuracy(preds).first().subject_count == 1
    assert R.prediction_integrity(preds).first().sequential
    assert not R.prediction_integrity(preds.withColumn("index", F.col("index") + 1)).first().sequential
    steps = C.running_accuracy(preds, 3).collect()
    assert [(s.completed, s.correct_so_far) for s in steps] == [(2, 1)]
    shares = {r.label: (r.predicted, r.gold) for r in R.label_distribution(preds).collect()}
    assert shares == {"A": (2, 1), "B": (0, 1), "C": (0, 0), "D": (0, 0)}


def test_label_scores_in_label_order(spark):
    rows = spark.createDataFrame([(1, 2, -3.0), (1, 0, -1.0), (1, 3, -4.0), (1, 1, -2.0)], "idx INT, label_index INT, score DOUBLE")
    assert C.label_scores(rows, "idx").first().scores == [-1.0, -2.0, -3.0, -4.0]


@pytest.mark.parametrize(
    "correct,low,high", [(3548, 24.56, 25.99), (3342, 23.10, 24.51), (3211, 22.18, 23.57)]
)
def test_published_wilson_intervals(spark, correct, low, high):
    bounds = wilson_bounds(F.lit(correct), F.lit(14042))
    row = spark.range(1).select(*[(b * 100).alias(n) for b, n in zip(bounds, ("lo", "hi"))]).first()
    assert (round(row.lo, 2), round(row.hi, 2)) == (low, high)


def test_run_comparison(spark):
    a = C.predictions(scored(spark))
    b = C.predictions(scored(spark).withColumn("scores", F.transform("scores", lambda s: s - 0.25)))
    row = R.run_agreement(a, b).first()
    assert (row.n_items, row.same_labels, row.max_score_difference) == (2, 2, 0.25)
    runs = [spark.createDataFrame([("wiki", v, 442868)], "k STRING, v DOUBLE, n BIGINT") for v in (929.84, 183.63)]
    out = R.compare_runs(*runs, "k", "v", "n").first()
    assert round(out.relative_change * 100, 2) == -80.25 and out.same_targets


def test_runs_with_different_keys_stay_visible(spark):
    a = spark.createDataFrame([("x", 0.5, 2), ("y", 0.25, 4)], "k STRING, v DOUBLE, n INT")
    b = spark.createDataFrame([("x", 1.0, 2), ("z", 0.75, 4)], "k STRING, v DOUBLE, n INT")
    rows = {r.k: r for r in R.compare_runs(a, b, "k", "v", "n").collect()}
    assert {k: r.held_by for k, r in rows.items()} == {"x": "both", "y": "a", "z": "b"}
    assert rows["x"].difference == 0.5 and rows["y"].difference is None

    def run(*indices):
        rows = [(i, "A", {"A": -1.0}) for i in indices]
        return spark.createDataFrame(rows, "index INT, predicted_label STRING, choice_log_likelihoods MAP<STRING,DOUBLE>")

    row = R.run_agreement(run(0, 1, 2), run(1, 2, 3, 4)).first()
    assert (row.n_items, row.only_a, row.only_b, row.same_labels) == (2, 1, 2, 2)


def toy():
    """A model maker: log-probabilities from the last two tokens, of eight."""

    def make():
        def logs(ids):
            before = np.concatenate([np.zeros_like(ids[:, :1]), ids[:, :-1]], axis=1)
            mixed = (ids * 3 + before * 5)[..., None] + np.arange(8) * (1 + ids[..., None])
            raw = np.sin(mixed)
            return raw - np.log(np.exp(raw).sum(-1, keepdims=True))

        return logs

    return make


def brute_choice(prompt, candidate, block):
    context, total = list(prompt), 0.0
    for token in candidate:
        total += toy()()(np.array([context[-block:]]))[0, -1, token]
        context.append(token)
    return total


CHOICE_SCHEMA = "idx BIGINT, prompt_ids ARRAY<INT>, candidate_ids ARRAY<ARRAY<INT>>"


@pytest.mark.parametrize("rows", [1, 3])
def test_user_models_score_choices(spark, rows):
    data = [
        (0, [1, 2, 3], [[4], [5], [6], [4]]),
        (1, [7], [[0, 1], [0, 2, 5], [3], [0]]),
        (2, [1, 2, 3, 4, 5, 6, 7], [[1, 1], [1, 2], [2, 1], [2]]),
    ]
    df = spark.createDataFrame(data, CHOICE_SCHEMA)
    got = {r.idx: r.scores for r in C.score_choices(df, toy(), 4, rows=rows).collect()}
    for idx, prompt, candidates in data:
        assert got[idx] == pytest.approx([brute_choice(prompt, c, 4) for c in candidates])
    assert C.score_choices(df.limit(0), toy(), 4).collect() == []


def test_four_one_token_labels_need_one_context(spark):
    calls = spark.sparkContext.accumulator(0)

    make = toy()

    def counted():
        model = make()

        def logs(ids):
            calls.add(len(ids))
            return model(ids)

        return logs

    data = [(i, [1, 2, i % 8], [[4], [5], [6], [7]]) for i in range(10)]
    assert len(C.score_choices(spark.createDataFrame(data, CHOICE_SCHEMA), counted, 8).collect()) == 10
    assert calls.value == 10


@pytest.mark.parametrize("item", [(0, [], [[1]]), (0, None, [[1]]), (0, [1], [[]]), (0, [1], []), (0, [1], None)])
def test_choices_without_tokens_fail(spark, item):
    with pytest.raises(Exception, match="needs"):
        C.score_choices(spark.createDataFrame([item], CHOICE_SCHEMA), toy(), 4).collect()
