"""Multiple-choice evaluation: demonstrations, prompt fitting, predictions, summaries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import CHOICE_LABELS, PROMPT_WITHOUT_INPUT
from ..functions.prompts import (
    answer_continuation,
    answer_label,
    choice_example,
    choice_header,
    choice_question,
    in_mode,
)
from ..functions.text import canonical_newlines
from ..session import materialize
from .lm_eval import Scorer
from .ordering import rank_before, running_values
from .skew import lookup


def select_subjects(df: DataFrame, subjects: list[str]) -> DataFrame:
    """Rows of the named subjects; names that do not occur are an error listing them."""
    wanted = sorted(set(subjects))
    found = df.filter(F.col("subject").isin(wanted)).select("subject").distinct()
    have = {r.subject for r in found.collect()}  # at most as many as were asked for
    missing = [s for s in wanted if s not in have]
    if missing:
        raise ValueError(f"unknown subjects: {missing}")
    return df.filter(F.col("subject").isin(wanted))


def unknown_subjects(df: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested subjects (``subject``) that no row has."""
    return requested.join(df.select("subject").distinct(), "subject", "left_anti")


def by_subject(df: DataFrame, order: str = "idx") -> DataFrame:
    """Add ``ord``, the source-order position inside the subject."""
    return rank_before(df, order, "ord", group=("subject",))


def demonstrations(dev: DataFrame, shots: int, order: str = "idx") -> DataFrame:
    """``subject, demos, n_demos``: texts of the first ``shots`` rows of each subject.

    The rank filter runs before the shuffle, so a large subject sends ``shots`` rows
    per task.
    """
    first = Window.partitionBy("subject").orderBy(order)
    top = dev.withColumn("rn", F.row_number().over(first)).filter(F.col("rn") <= shots)
    text = choice_example(F.col("question"), F.col("choices"), F.col("answer"))
    return (
        top.select("subject", "rn", text.alias("demo"))
        .groupBy("subject")
        .agg(F.array_sort(F.collect_list(F.struct("rn", "demo"))).alias("d"))
        .select("subject", F.transform("d", lambda x: x["demo"]).alias("demos"))
        .withColumn("n_demos", F.size("demos"))
    )


def with_demonstrations(test: DataFrame, dev: DataFrame, shots: int) -> DataFrame:
    """Join subject-matched demonstrations; subjects without any get an empty list."""
    if shots < 0:
        raise ValueError("shots cannot be negative")
    empty = F.array().cast("array<string>")
    if shots == 0:
        return test.withColumn("demos", empty).withColumn("n_demos", F.lit(0))
    # few subjects have most questions, so theirs are sent to the questions and not the other way
    demos = materialize(demonstrations(dev, shots), "demonstrations")
    return lookup(materialize(test, "questions"), demos, "subject", "left").withColumns(
        {"demos": F.coalesce("demos", empty), "n_demos": F.coalesce("n_demos", F.lit(0))}
    )


def short_subjects(test: DataFrame, dev: DataFrame, shots: int) -> DataFrame:
    """Subjects with fewer than ``shots`` demonstrations."""
    return (
        with_demonstrations(test.select("subject").distinct(), dev, shots)
        .filter(F.col("n_demos") < shots)
        .select("subject", "n_demos")
    )


def require_demonstrations(test: DataFrame, dev: DataFrame, shots: int) -> DataFrame:
    """Like :func:`with_demonstrations`, failing on the first subject that is short."""
    short = short_subjects(test, dev, shots).orderBy("subject").limit(1).collect()
    if short:
        raise ValueError(
            f"subject {short[0]['subject']!r} has {short[0]['n_demos']} few-shot examples; "
            f"{shots} requested"
        )
    return with_demonstrations(test, dev, shots)


def _parts() -> tuple[Column, Column]:
    """What stands before and after the demonstrations."""
    return choice_header(F.col("subject")), choice_question(F.col("question"), F.col("choices"))


def _prompt(head: Column, tail: Column, k: Column, mode: Column) -> Column:
    shots = F.array_join(F.slice("demos", F.lit(1), k), "")
    return in_mode(F.concat(head, shots, tail), mode)


def fit_few_shot(
    df: DataFrame, block_size: int, mode: Column, measure: Callable[[Column], Column]
) -> DataFrame:
    """Keep as many leading demonstrations as fit: ``prompt, effective_shots,
    prompt_left_truncated, prompt_size``. ``measure`` is a column expression.

    The one-item ``transform`` names the prompt's parts, so a row formats its question
    once and not once per shot count.
    """
    head, tail = _parts()

    def tries(p: Column) -> Column:
        def attempt(k: Column) -> Column:
            prompt = _prompt(p["head"], p["tail"], k, mode)
            return F.struct(k.alias("k"), measure(prompt).cast("int").alias("size"))

        return F.transform(F.sequence(F.lit(0), F.size("demos")), attempt)

    parts = F.array(F.struct(head.alias("head"), tail.alias("tail")))
    return _keep_fitting(df.withColumn("__tries", F.explode(F.transform(parts, tries))), df.columns, block_size, mode)


def _keep_fitting(rows: DataFrame, columns: list[str], block_size: int, mode: Column) -> DataFrame:
    """The last of ``__tries`` that fits, or the first if none does, and its prompt."""
    fitting = F.filter("__tries", lambda t: t["size"] <= block_size)
    best = F.coalesce(F.try_element_at(fitting, F.lit(-1)), F.get("__tries", F.lit(0)))
    rows = rows.withColumn("__best", best)
    return rows.select(
        *columns,
        F.col("__best.k").alias("effective_shots"),
        _prompt(*_parts(), F.col("__best.k"), mode).alias("prompt"),
        F.col("__best.size").alias("prompt_size"),
        (F.col("__best.size") > block_size).alias("prompt_left_truncated"),
    )


def fit_few_shot_tokens(
    df: DataFrame, block_size: int, mode: Column, count_tokens, key: str = "idx"
) -> DataFrame:
    """The same with an Arrow token counter, which higher-order functions cannot call.

    Every row is measured at each of its few shot counts; shot counts are configuration. It builds
    all those prompts, so for a whole table and a vocabulary take ``fit_few_shot_pieces``.
    """
    tries = df.withColumn("k", F.explode(F.sequence(F.lit(0), F.size("demos"))))
    tries = tries.withColumn("prompt", _prompt(*_parts(), F.col("k"), mode)).withColumn(
        "prompt_size", count_tokens(F.col("prompt"))
    )
    fits = F.col("prompt_size") <= block_size
    best = tries.groupBy(key).agg(
        F.max_by(
            F.struct(
                F.col("k").alias("effective_shots"),
                "prompt",
                "prompt_size",
                (~fits).alias("prompt_left_truncated"),
            ),
            F.when(fits, F.col("k")).otherwise(F.when(F.col("k") == 0, -1)),
        ).alias("b")
    )
    return df.join(best.select(key, "b.*"), key)


def fit_few_shot_pieces(df: DataFrame, block_size: int, mode: Column, count_pieces) -> DataFrame:
    """``fit_few_shot`` with a learned vocabulary: ``count_pieces`` is its ``piecewise_count_udf``.

    The sizes for all shot counts come from one call a row, so no prompt is built but the one kept.
    """
    head, tail = _parts()
    opening, closing = PROMPT_WITHOUT_INPUT.split("{instruction}")
    wrapped = mode == "instruction"
    sizes = count_pieces(
        F.when(wrapped, F.concat(F.lit(opening), canonical_newlines(head))).otherwise(head),
        F.when(wrapped, F.transform("demos", canonical_newlines)).otherwise(F.col("demos")),
        F.when(wrapped, F.concat(canonical_newlines(tail), F.lit(closing))).otherwise(tail),
    )
    tries = F.transform(sizes, lambda n, k: F.struct(k.alias("k"), n.alias("size")))
    return _keep_fitting(df.withColumn("__tries", F.explode(F.array(tries))), df.columns, block_size, mode)


def candidates(df: DataFrame, mode: Column) -> DataFrame:
    """One row per item and label: ``label_index, label, continuation``."""
    labels = F.array(
        *[F.struct(F.lit(i).alias("i"), F.lit(l).alias("l")) for i, l in enumerate(CHOICE_LABELS)]
    )
    return df.withColumn("__c", F.explode(labels)).select(
        *df.columns,
        F.col("__c.i").alias("label_index"),
        F.col("__c.l").alias("label"),
        answer_continuation(F.col("__c.l"), mode).alias("continuation"),
    )


def score_choices(
    items: DataFrame,
    make_scorer: Callable[[], Scorer],
    block_size: int,
    key: str = "idx",
    rows: int = 8,
) -> DataFrame:
    """``key, scores``: log-probability sums of an item's candidates under a user model.

    ``items`` has ``prompt_ids`` and ``candidate_ids``, one array per candidate. A context
    is the prompt and what precedes a candidate's token, cut from the left to
    ``block_size``; candidates that begin alike share contexts, so four labels of one
    token need one. ``make_scorer`` is as for ``score_windows``; contexts go to it
    ``rows`` at a time. An empty or null prompt or candidate fails the job.
    """

    def contexts_of(batch: pd.DataFrame):
        """Contexts of a batch of items and the ``(item, candidate, token)`` read after each."""
        contexts, reads = [], []
        for item, (prompt, choices) in enumerate(zip(batch["prompt_ids"], batch["candidate_ids"])):
            if prompt is None or choices is None or not len(prompt) or not len(choices):
                raise ValueError("an item needs prompt tokens and candidates")
            places: dict[bytes, int] = {}
            for number, candidate in enumerate(choices):
                if candidate is None or not len(candidate):
                    raise ValueError("a candidate needs at least one token")
                for taken, token in enumerate(candidate):
                    said = np.asarray(candidate[:taken], np.int64)
                    place = places.setdefault(said.tobytes(), len(contexts))
                    if place == len(contexts):
                        contexts.append(np.concatenate([prompt, said])[-block_size:].astype(np.int64))
                        reads.append([])
                    reads[place].append((item, number, token))
        return contexts, reads

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for batch in batches:
            contexts, reads = contexts_of(batch)
            scores = [np.zeros(len(c)) for c in batch["candidate_ids"]]
            for low in range(0, len(contexts), rows):
                part = contexts[low : low + rows]
                sizes = np.array([len(c) for c in part])
                real = np.arange(sizes.max()) < sizes[:, None]
                inputs = np.zeros(real.shape, np.int64)
                inputs[real] = np.concatenate(part)
                ends = scorer(inputs)[np.arange(len(part)), sizes - 1]
                for at, wanted in enumerate(reads[low : low + rows]):
                    for item, candidate, token in wanted:
                        scores[item][candidate] += ends[at, token]
            yield pd.DataFrame({key: batch[key], "scores": scores})

    kind = items.schema[key].dataType.simpleString()
    return items.select(key, "prompt_ids", "candidate_ids").mapInPandas(
        run, f"`{key}` {kind}, scores ARRAY<DOUBLE>"
    )


def label_scores(scored: DataFrame, *keys: str) -> DataFrame:
    """``keys, scores``: the four scores of an item in label order."""
    return scored.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("label_index", "score"))), lambda s: s["score"]
        ).alias("scores")
    )


def arg_max(scores: Column) -> Column:
    """Index of the best score; the lowest index wins a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def predictions(df: DataFrame) -> DataFrame:
    """Prediction records from ``idx, subject, question, choices, answer, scores`` and, where
    present, ``prompt_size``, ``effective_shots`` and ``prompt_left_truncated``."""
    rows = df.withColumn("predicted", arg_max(F.col("scores")))
    extra = [c for c in ("effective_shots", "prompt_left_truncated") if c in df.columns]
    if "prompt_size" in df.columns:
        extra.insert(0, F.col("prompt_size").alias("prompt_tokens"))
    return rows.select(
        F.col("idx").alias("index"),
        "subject",
        "question",
        "choices",
        F.col("answer").alias("gold"),
        answer_label(F.col("answer")).alias("gold_label"),
        "predicted",
        answer_label(F.col("predicted")).alias("predicted_label"),
        (F.col("predicted") == F.col("answer")).alias("correct"),
        F.map_from_arrays(F.array(*[F.lit(l) for l in CHOICE_LABELS]), "scores").alias(
            "choice_log_likelihoods"
        ),
        *extra,
    )


# --- summaries --------------------------------------------------------------------


def accuracy_summary(preds: DataFrame, *by: str) -> DataFrame:
    """``total, correct, accuracy`` over predictions, grouped if asked."""
    return preds.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if("correct").alias("correct"),
        (F.count_if("correct") / F.count("*")).alias("accuracy"),
    )


def subject_summary(preds: DataFrame) -> DataFrame:
    return accuracy_summary(preds, "subject")


def macro_accuracy(preds: DataFrame) -> DataFrame:
    """Unweighted mean of subject accuracies."""
    return subject_summary(preds).agg(
        F.count("*").alias("subject_count"), F.avg("accuracy").alias("macro_subject_accuracy")
    )


def evaluation_report(
    preds: DataFrame, *, prompt_mode: str, shots: int, limit: int | None = None
) -> DataFrame:
    """One summary row of a finished run, from one pass over the predictions."""
    subjects = preds.groupBy("subject").agg(
        F.count("*").alias("n"),
        F.count_if("correct").alias("hits"),
        F.count_if("prompt_left_truncated").alias("cut"),
    )
    return subjects.agg(
        F.sum("n").alias("total"),
        F.sum("hits").alias("correct"),
        (F.sum("hits") / F.sum("n")).alias("accuracy"),
        F.avg(F.col("hits") / F.col("n")).alias("macro_subject_accuracy"),
        F.count("*").alias("subject_count"),
        F.sum("cut").alias("prompt_left_truncated"),
    ).select(
        F.lit("answer_label_conditional_log_likelihood").alias("scoring"),
        F.lit(prompt_mode).alias("prompt_mode"),
        F.lit(shots).alias("requested_shots"),
        "total",
        "correct",
        "accuracy",
        "macro_subject_accuracy",
        "subject_count",
        "prompt_left_truncated",
        F.lit("full_selection" if limit is None else "prefix_smoke_test").alias("evaluation_scope"),
    )


def shots_histogram(preds: DataFrame) -> DataFrame:
    return preds.groupBy("effective_shots").agg(
        F.count("*").alias("n_items"),
        F.count_if("prompt_left_truncated").alias("n_truncated"),
    )


def running_accuracy(preds: DataFrame, every: int, order: str = "index") -> DataFrame:
    """Accuracy after every ``every``-th prediction and after the last."""
    if every <= 0:
        raise ValueError("every must be positive")
    hit = F.col("correct").cast("bigint")
    rows = running_values(preds, order, {"__n": F.lit(1).cast("bigint"), "__c": hit})
    total = preds.agg(F.count("*")).scalar()
    done = (F.col("__n") + 1).cast("bigint")
    correct = (F.col("__c") + hit).cast("bigint")
    return rows.select(done.alias("completed"), correct.alias("correct_so_far")).filter(
        (F.col("completed") % every == 0) | (F.col("completed") == total)
    ).withColumn("accuracy", F.col("correct_so_far") / F.col("completed"))
