"""Top-k sampling, seeded draws, batch generation and sample plans."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import uniform_draw
from ..functions.tokens import take_last
from ..session import materialize
from .skew import lookup


def top_k_distribution(
    logits: DataFrame, group: str, temperature: float, top_k: int | None, vocab_size: int
) -> DataFrame:
    """``group, token, p, cum``: softmax over the k best logits of each group.

    Candidates equal to the k-th stay, so more than k may survive. A group holds one
    row per vocabulary token at most.
    """
    if temperature <= 0:
        raise ValueError("temperature must be positive")
    rows = logits.withColumn("z", F.col("logit") / F.lit(float(temperature)))
    if top_k is not None:
        k = min(top_k, vocab_size)
        # rank() keeps exactly the rows at or above the k-th value
        best = Window.partitionBy(group).orderBy(F.desc("z"))
        rows = rows.withColumn("rank", F.rank().over(best)).filter(F.col("rank") <= k).drop("rank")
    whole = Window.partitionBy(group)
    rows = rows.withColumn("w", F.exp(F.col("z") - F.max("z").over(whole)))
    rows = rows.withColumn("p", F.col("w") / F.sum("w").over(whole))
    running = Window.partitionBy(group).orderBy("token").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return rows.withColumn("cum", F.sum("p").over(running)).drop("z", "w")


def candidate_arrays(distribution: DataFrame, group: str) -> DataFrame:
    """One row per group with its candidates in token order; bounded by the vocabulary."""
    return distribution.groupBy(group).agg(
        F.array_sort(F.collect_list(F.struct("token", "cum"))).alias("candidates")
    )


def pick(candidates: Column, draw: Column) -> Column:
    """First candidate whose running probability reaches the draw; rounding falls to the last."""
    hits = F.filter(candidates, lambda c: c["cum"] >= draw)
    return F.coalesce(F.get(hits, F.lit(0)), F.element_at(candidates, -1))["token"]


def sample_plan(
    prompts: DataFrame, order: str, samples_per_prompt: int, seed: int
) -> DataFrame:
    """``sample, sample_index, seed`` for each prompt; ``order`` is its zero-based position."""
    if samples_per_prompt <= 0:
        raise ValueError("samples_per_prompt must be positive")
    rows = prompts.withColumn(
        "sample", F.explode(F.sequence(F.lit(1), F.lit(samples_per_prompt)))
    )
    index = F.col(order) * samples_per_prompt + F.col("sample") - 1
    return rows.withColumn("sample_index", index.cast("bigint")).withColumn(
        "seed", F.col("sample_index") + seed
    )


def context_key(tokens: Column) -> Column:
    """Name of a context in a candidate table; the empty context is the empty string."""
    return F.array_join(tokens, ",")


def batch_generate(
    prompts: DataFrame,
    contexts: DataFrame,
    *,
    longest: int,
    max_new_tokens: int,
    eos_id: int,
    key: str = "sample_index",
) -> DataFrame:
    """``key, new_ids``: sampled continuations of all prompts, one token a step.

    ``prompts`` has ``key, seed, prompt_ids``; ``contexts`` one row ``context, candidates`` per
    known run of up to ``longest`` tokens (``context_key``), the empty one included. Each step
    takes the candidates of the longest known run that ends the text so far. A row that draws
    the end token keeps it and leaves; a step's state is a table in shared storage, and contexts
    that many rows have reached are looked up by broadcast.
    """
    table = materialize(contexts.select("context", "candidates"), "contexts")
    state = prompts.select(
        key, "seed", take_last(F.col("prompt_ids"), longest).alias("tail"), F.array().cast("array<int>").alias("new_ids")
    )
    finished = None
    for step in range(max_new_tokens):
        stored = materialize(state, "generation")
        # the empty context is known, so a row draws a token each step
        ended = (F.size("new_ids") > 0) & (F.try_element_at("new_ids", F.lit(-1)) == eos_id)
        done = stored.filter(ended).select(key, "new_ids")
        finished = done if finished is None else finished.unionByName(done)
        active = stored.filter(~ended)
        if active.isEmpty():
            return finished
        sizes = F.sequence(F.lit(0), F.size("tail"))
        asked = active.withColumn("size", F.explode(sizes)).withColumn(
            "context", context_key(F.slice("tail", F.size("tail") - F.col("size") + 1, F.col("size")))
        )
        draw = uniform_draw(F.col("seed").cast("string"), F.lit(str(step)))
        drawn = lookup(asked, table, "context").withColumn("token", pick(F.col("candidates"), draw))
        best = drawn.groupBy(key).agg(F.max_by(F.struct("seed", "tail", "new_ids", "token"), "size").alias("s"))
        token = F.array("s.token")
        state = best.select(
            key, F.col("s.seed").alias("seed"), take_last(F.concat("s.tail", token), longest).alias("tail"),
            F.concat("s.new_ids", token).alias("new_ids"),
        )
    last = state.select(key, "new_ids")
    return last if finished is None else finished.unionByName(last)


def _draw(seed: int, step: int) -> float:
    return int(hashlib.md5(f"{seed}:{step}".encode()).hexdigest()[:8], 16) / 4294967296.0


def draw_tokens(logits: np.ndarray, draws: np.ndarray, temperature: float, top_k: int | None) -> np.ndarray:
    """One token per row of logits: top-k with ties kept, softmax, the draw's place in it."""
    z = logits / temperature
    k = logits.shape[1] if top_k is None else min(top_k, logits.shape[1])
    least = np.partition(z, -k, axis=1)[:, -k][:, None]
    weights = np.where(z >= least, np.exp(z - z.max(axis=1, keepdims=True)), 0.0)
    running = np.cumsum(weights / weights.sum(axis=1, keepdims=True), axis=1)
    hit = (running >= draws[:, None]) & (weights > 0)
    last = logits.shape[1] - 1 - np.argmax(weights[:, ::-1] > 0, axis=1)
    return np.where(hit.any(axis=1), hit.argmax(axis=1), last)


def generate_with_scorer(
    prompts: DataFrame,
    make_scorer: Callable[[], Callable[[list[np.ndarray]], np.ndarray]],
    *,
    block_size: int,
    temperature: float,
    top_k: int | None,
    max_new_tokens: int,
    eos_id: int,
    key: str = "sample_index",
) -> DataFrame:
    """``key, new_ids`` from a scorer that maps contexts to one row of logits each.

    ``make_scorer`` runs once per task. Rows are independent, so a batch steps through all its
    tokens inside its task; contexts are the last ``block_size`` tokens, and rows that drew the
    end token leave the batch.
    """
    if temperature <= 0:
        raise ValueError("temperature must be positive")

    def generate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for batch in batches:
            texts = [np.asarray(ids, np.int64) for ids in batch["prompt_ids"]]
            starts, seeds = [len(t) for t in texts], batch["seed"].tolist()
            active = list(range(len(texts)))
            for step in range(max_new_tokens):
                if not active:
                    break
                logits = np.asarray(scorer([texts[i][-block_size:] for i in active]), np.float64)
                draws = np.array([_draw(seeds[i], step) for i in active])
                for i, token in zip(active, draw_tokens(logits, draws, temperature, top_k)):
                    texts[i] = np.append(texts[i], token)
                active = [i for i in active if texts[i][-1] != eos_id]
            new = [t[n:].astype(np.int32) for t, n in zip(texts, starts)]
            yield pd.DataFrame({key: batch[key], "new_ids": new})

    kind = prompts.schema[key].dataType.simpleString()
    return prompts.select(key, "seed", "prompt_ids").mapInPandas(generate, f"`{key}` {kind}, new_ids ARRAY<INT>")
