import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexweave.functions.metrics import learning_rate
from lexweave.operators import history as H, sampling as G, skew


def logits(spark, values):
    rows = [(0, i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "g INT, token INT, logit DOUBLE")


def test_ties_at_the_kth_value_stay(spark):
    rows = G.top_k_distribution(logits(spark, [3, 1, 1, 1, 0]), "g", 1.0, 2, 5).orderBy("token").collect()
    assert [r.token for r in rows] == [0, 1, 2, 3]
    z = math.exp(3) + 3 * math.exp(1)
    assert [r.p for r in rows] == pytest.approx([math.exp(3) / z] + [math.exp(1) / z] * 3)
    assert rows[-1].cum == pytest.approx(1.0)


def test_temperature_and_open_top_k(spark):
    cold = G.top_k_distribution(logits(spark, [2, 1]), "g", 0.5, None, 2).orderBy("token").collect()
    assert cold[0].p == pytest.approx(1 / (1 + math.exp(-2)))
    assert G.top_k_distribution(logits(spark, [1, 2, 3]), "g", 1.0, 99, 3).count() == 3
    with pytest.raises(ValueError, match="positive"):
        G.top_k_distribution(logits(spark, [1]), "g", 0, 1, 1)


CANDIDATES = "context STRING, candidates ARRAY<STRUCT<token: INT, cum: DOUBLE>>"
PROMPTS = "sample_index BIGINT, seed BIGINT, prompt_ids ARRAY<INT>"


def always(spark, table):
    """Contexts that are followed by one token each."""
    return spark.createDataFrame([(c, [(t, 1.0)]) for c, t in table.items()], CANDIDATES)


def generated(prompts, contexts, **options):
    return {r.sample_index: r.new_ids for r in G.batch_generate(prompts, contexts, **options).collect()}


def test_generation_follows_the_longest_known_context(spark):
    table = always(spark, {"": 7, "2": 4, "1,2": 5, "5": 1, "2,5": 9})
    prompts = spark.createDataFrame(
        [(0, 42, [3, 2]), (1, 43, [1, 2]), (2, 44, [2]), (3, 45, []), (4, 46, [8, 8, 5])], PROMPTS
    )
    got = generated(prompts, table, longest=2, max_new_tokens=3, eos_id=4)
    # a row that draws the end token keeps it and goes no further
    assert got == {0: [4], 1: [5, 9, 7], 2: [4], 3: [7, 7, 7], 4: [1, 7, 7]}
    assert generated(prompts, table, longest=1, max_new_tokens=1, eos_id=4)[1] == [4]
    assert generated(prompts.limit(0), table, longest=2, max_new_tokens=3, eos_id=4) == {}


def test_generation_is_repeatable_and_follows_the_distribution(spark):
    spread = G.top_k_distribution(logits(spark, [math.log(3), 0]), "g", 1.0, None, 2)
    table = G.candidate_arrays(spread.withColumn("context", F.lit("")), "context")
    prompts = spark.range(500).select(
        F.col("id").alias("sample_index"), (F.col("id") + 42).alias("seed"), F.array(F.lit(0)).alias("prompt_ids")
    )
    runs = [generated(p, table, longest=1, max_new_tokens=4, eos_id=9) for p in (prompts, prompts.repartition(3))]
    assert runs[0] == runs[1]
    drawn = [t for ids in runs[0].values() for t in ids]
    assert len(drawn) == 2000 and abs(drawn.count(0) / 2000 - 0.75) < 0.04


def test_scorer_and_table_generate_alike(spark):
    rng = random.Random(1)
    weights = {c: [rng.choice([0.0, 1.0, 1.0, 2.5]) for _ in range(6)] for c in ["", *"012345"]}

    def make_scorer():
        def score(contexts):
            assert max(len(c) for c in contexts) <= 1  # the block holds one token
            return np.array([weights["".join(map(str, c))] for c in contexts])
        return score

    prompts = spark.createDataFrame([(i, i * 3, [1, i % 6] if i % 7 else []) for i in range(80)], PROMPTS)
    rows = [(c, t, float(w)) for c, ws in weights.items() for t, w in enumerate(ws)]
    spread = G.top_k_distribution(spark.createDataFrame(rows, "context STRING, token INT, logit DOUBLE"), "context", 0.7, 3, 6)
    table = G.candidate_arrays(spread, "context")
    by_table = generated(prompts, table, longest=1, max_new_tokens=6, eos_id=2)
    scored = G.generate_with_scorer(
        prompts, make_scorer, block_size=1, temperature=0.7, top_k=3, max_new_tokens=6, eos_id=2
    )
    assert {r.sample_index: r.new_ids for r in scored.collect()} == by_table
    assert len({len(ids) for ids in by_table.values()}) > 2


def test_lookup_of_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEYS", 2)
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 2).otherwise(F.col("id")).alias("k"))
    facts = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    want = sorted((r.id, r.k) for r in rows.collect())
    found = skew.lookup(rows, facts, "k", "left").collect()
    assert sorted((r.id, r.k) for r in found) == want
    assert all(r.twice == (2 * r.k if r.k < 500 else None) for r in found)
    assert skew.lookup(rows, facts, "k").count() == sum(k < 500 for _, k in want)


def test_sample_plan_numbers_and_seeds(spark):
    prompts = spark.createDataFrame([(0, "a"), (1, "b")], "ord BIGINT, id STRING")
    rows = G.sample_plan(prompts, "ord", 2, 42).orderBy("sample_index").collect()
    assert [(r.id, r.sample, r.seed) for r in rows] == [("a", 1, 42), ("a", 2, 43), ("b", 1, 44), ("b", 2, 45)]


def test_learning_rate(spark):
    steps = spark.createDataFrame([(0,), (9,), (10,), (60,), (110,), (500,)], "s INT")
    rate = learning_rate(F.col("s"), peak=1.0, floor=0.1, warmup=10, max_steps=110)
    got = [r.r for r in steps.select(rate.alias("r")).collect()]
    assert got == pytest.approx([0.1, 1.0, 1.0, 0.55, 0.1, 0.1])
    with pytest.raises(ValueError):
        learning_rate(F.col("s"), peak=1.0, floor=2.0, warmup=0, max_steps=5)


def history(spark, *rows):
    return spark.createDataFrame([("r", s, v) for s, v in rows], "run_id STRING, step BIGINT, val_loss DOUBLE")


def test_running_best_is_strict(spark):
    rows = H.running_best(history(spark, (1, 3.0), (2, 3.0), (3, 2.0), (5000, 2.5))).orderBy("step").collect()
    assert [r.improved for r in rows] == [True, False, True, False]
    assert [r.best_val_loss for r in rows] == [3.0, 3.0, 2.0, 2.0]


def test_resume_appends_and_replaces(spark):
    rows = H.resumed_history(history(spark, (1, 3.0), (2, 2.0)), history(spark, (2, 2.5), (3, 2.4))).orderBy("step").collect()
    assert [(r.step, r.best_val_loss, r.improved) for r in rows] == [(1, 3.0, True), (2, 2.5, True), (3, 2.4, True)]


def test_steps_that_evaluate_and_log(spark):
    df = spark.range(1, 13).select(F.col("id").alias("step"), F.lit(12).alias("last"))
    assert [r.step for r in H.evaluation_steps(df, 5, "last").collect()] == [5, 10, 12]
    assert [r.step for r in H.log_steps(df, 5).collect()] == [1, 5, 10]
