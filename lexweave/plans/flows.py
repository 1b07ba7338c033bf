"""End-to-end flows, from raw tables to datasets and reports."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..constants import EOS_TOKEN
from ..functions.text import story_chunk, strip
from ..functions.tokens import byte_token_count, take_last
from ..operators import choice_eval, instruction, lm_eval, sampling, token_tables
from ..operators.encoding import decode_ids, encode_corpus, piecewise_count_udf, token_ids
from ..operators.ngram import NgramModel, score_continuations
from ..operators.ordering import rank_before
from ..operators.skew import with_facts
from ..operators.vocabulary import Vocabulary, train_vocabulary
from ..session import materialize
from ..sources import corpus, records


@dataclass(frozen=True)
class TrainingData:
    vocabulary: Vocabulary
    train: DataFrame
    validation: DataFrame


def pretraining_data(
    docs: DataFrame,
    *,
    block_size: int,
    train_fraction: float = 0.9,
    vocabulary: Vocabulary | None = None,
    vocab_size: int = 10_000,
    min_frequency: int = 2,
) -> TrainingData:
    """Stories to two token streams: guard, vocabulary, encode, place, split.

    The streams are stored; cut windows from them with ``shifted_windows`` or draw them
    with ``sampled_windows``.
    """
    stories = corpus.non_empty_stories(corpus.require_corpus(docs))
    if vocabulary is None:
        # end markers take part in learning as ordinary text
        marked = stories.withColumn("text", story_chunk(F.col("text")))
        corpus.require_markers(marked, EOS_TOKEN)
        vocabulary = train_vocabulary(marked, vocab_size, min_frequency)
    tokens = materialize(token_tables.story_tokens(stories, vocabulary), "tokens")
    pieces = materialize(
        token_tables.contiguous_split(token_tables.token_offsets(tokens), train_fraction), "split"
    )
    sides = []
    for name in ("train", "validation"):
        side = pieces.filter(F.col("split") == name)
        start = side.agg(F.min("from_pos")).scalar()
        side = side.withColumn("start_pos", F.col("from_pos") - start)
        token_tables.require_longer_than(side, block_size)
        sides.append(side.select("doc_id", "ids", "n_tokens", "start_pos"))
    return TrainingData(vocabulary, *sides)


def instruction_data(
    rows: DataFrame,
    vocabulary: Vocabulary,
    *,
    block_size: int,
    train_fraction: float = 0.95,
    seed: int = 42,
    max_seq_length: int | None = None,
    max_records: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Records to a stored table of encoded rows with their split, and its counters."""
    length = instruction.check_lengths(max_seq_length or block_size, block_size)
    checked = records.require_valid(rows, "rec_id", records.instruction_rules(False))
    halves = instruction.seeded_split(checked, train_fraction, seed, max_records)
    encoded = materialize(instruction.encode_records(halves, vocabulary, length), "instructions")
    instruction.kept_records(encoded)
    return encoded, instruction.instruction_stats(encoded, "split")


def evaluate_lines(
    lines: DataFrame,
    vocabulary: Vocabulary,
    make_scorer: lm_eval.Scorer,
    *,
    block_size: int,
    stride: int | None = None,
    batch_size: int = 4,
    max_tokens: int | None = None,
    key: str = "doc_id",
) -> DataFrame:
    """Raw lines, as one preserved text, to a perplexity report with a user scorer."""
    stride = lm_eval.check_stride(block_size, stride)
    chunks = token_tables.line_blocks(lines, key)
    encoded = token_tables.with_counts(encode_corpus(chunks, vocabulary, key))
    stream = materialize(token_tables.token_offsets(materialize(encoded, "lines"), key), "lines")
    if max_tokens is not None:
        stream = lm_eval.prefix_tokens(stream, max_tokens)
    windows = lm_eval.window_tokens(stream, block_size, stride)
    scored = lm_eval.score_windows(windows, make_scorer, batch_size)
    metrics = lm_eval.token_weighted_metrics(scored, F.col("nll_sum"), F.col("predictions"))
    return lm_eval.evaluation_report(
        metrics,
        lm_eval.evaluation_windows(stream.drop("ids"), block_size, stride),
        tokens=token_tables.stream_length(stream),
        batch_size=batch_size,
        stride=stride,
        max_tokens=max_tokens,
    )


def evaluate_choices(
    test: DataFrame,
    dev: DataFrame | None,
    vocabulary: Vocabulary,
    model: NgramModel | Callable[[], lm_eval.Scorer],
    *,
    block_size: int,
    shots: int = 0,
    prompt_mode: str = "completion",
) -> tuple[DataFrame, DataFrame]:
    """Questions to stored predictions and their summary row.

    ``model`` is an n-gram model or a function that makes a scorer in each task.
    """
    if prompt_mode not in {"completion", "instruction"}:
        raise ValueError("prompt_mode must be 'completion' or 'instruction'")
    if shots and dev is None:
        raise ValueError("shots need few-shot records")
    records.require_valid(test, "idx", records.choice_rules())
    mode = F.lit(prompt_mode)
    rows = choice_eval.require_demonstrations(test, test if dev is None else dev, shots)
    if vocabulary.merges:
        fitted = choice_eval.fit_few_shot_pieces(rows, block_size, mode, piecewise_count_udf(vocabulary))
    else:
        fitted = choice_eval.fit_few_shot(rows, block_size, mode, byte_token_count)
    fitted = materialize(fitted, "prompts")
    prompt_ids = encode_corpus(fitted.select("idx", F.col("prompt").alias("text")), vocabulary, "idx")
    asked = choice_eval.candidates(prompt_ids.withColumnRenamed("ids", "prompt_ids"), mode)
    # four fixed texts, encoded once
    texts = asked.select(F.col("continuation").alias("text")).distinct()
    coded = encode_corpus(texts.withColumn("c", F.col("text")), vocabulary, "c")
    items = asked.join(
        coded.select(F.col("c").alias("continuation"), F.col("ids").alias("candidate_ids")), "continuation"
    )
    if isinstance(model, NgramModel):
        scores = choice_eval.label_scores(
            score_continuations(items, model, "idx", "label_index"), "idx"
        )
    else:
        last = F.any_value(take_last(F.col("prompt_ids"), block_size))
        labels = F.array_sort(F.collect_list(F.struct("label_index", "candidate_ids")))
        together = items.groupBy("idx").agg(
            last.alias("prompt_ids"), F.transform(labels, lambda l: l["candidate_ids"]).alias("candidate_ids")
        )
        scores = choice_eval.score_choices(together, model, block_size)
    preds = materialize(choice_eval.predictions(fitted.join(scores, "idx")), "predictions")
    return preds, choice_eval.evaluation_report(preds, prompt_mode=prompt_mode, shots=shots)


def generate_samples(
    prompts: DataFrame,
    vocabulary: Vocabulary,
    generate: Callable[[DataFrame], DataFrame],
    *,
    mode: str,
    block_size: int,
    samples_per_prompt: int,
    seed: int,
    order: str = "ord",
) -> DataFrame:
    """Samples of every prompt: fit, plan, encode, generate, decode, strip.

    ``prompts`` has a unique bigint ``order``, ``id`` and, by mode, ``prompt`` or ``instruction``
    and ``input``. Instructions are cut to the block like training records; one that cannot fit
    fails the job. A prompt is encoded once for all its samples. ``generate`` maps
    ``sample_index, seed, prompt_ids`` (the last ``block_size`` tokens) to ``sample_index,
    new_ids``: ``batch_generate`` or ``generate_with_scorer`` with their settings.

    Returns ``order, id, sample, sample_index, seed, prompt, input, input_truncated,
    prompt_tokens, new_ids, output``, which the sample report takes.
    """
    if mode == "instruction":
        fitted = instruction.fit_prompts(prompts, vocabulary, block_size, reserve=0)
        rows = instruction.require_fitting(fitted, "id")
    elif mode == "completion":
        rows = prompts.withColumn("input", F.lit("")).withColumn("input_truncated", F.lit(False))
    else:
        raise ValueError("mode must be 'completion' or 'instruction'")
    # keys alone are ranked; stored texts meet their places once and are encoded then
    stored = materialize(rows.withColumn("__row", F.monotonically_increasing_id()), "sample-texts")
    places = rank_before(stored.select(order, "__row"), order, "__place").drop(order)
    encoded = with_facts(stored, places, "__row").withColumn("prompt_ids", token_ids(vocabulary)(F.col("prompt")))
    placed = materialize(encoded.withColumn("prompt_tokens", F.size("prompt_ids")), "sample-prompts")
    plan = sampling.sample_plan(placed, "__place", samples_per_prompt, seed)
    context = take_last(F.col("prompt_ids"), block_size)
    made = materialize(generate(plan.select("sample_index", "seed", context.alias("prompt_ids"))), "samples")
    shown = F.col("instruction") if mode == "instruction" else F.col("prompt")
    output = strip(decode_ids(F.col("new_ids"), vocabulary, skip_special=True))
    drawn = plan.select("sample_index", "sample", "seed", "__row").join(made, "sample_index")
    return placed.join(drawn, "__row").select(
        order, "id", "sample", "sample_index", "seed", shown.alias("prompt"), "input", "input_truncated",
        "prompt_tokens", "new_ids", output.alias("output"),
    )
