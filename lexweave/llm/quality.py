"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import materialize
from .common import INK_BYTES, WORD_BYTES, hash_spans, mix, steps, text_buffer, word_spans
from .labelled import held_out, training_rows

#: Labelled rows to learn from, and the learners that share them.
TRAINING_ROWS = 24_000
LEARNERS = 6
BUCKETS = 1 << 20
#: Follow-the-regularised-leader: step size, its offset, and both penalties.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.1, 0.0
PASSES = 4
GOOD = 0.7

_WORD, _SIGN, _PAIR, _SAME = (np.uint64(x) for x in (3, 5, 7, 11))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams: bucket, value, and the first entry of each text.

    One- and two-grams of blank-separated words, each word also reduced to its signs and
    letter case, and a mark for a word that repeats the one before it. A bucket's value is the
    logarithm of its count; values of a text have length one.
    """
    buf, offsets = text_buffer(pc.fill_null(texts, ""))
    starts, ends, bounds = word_spans(buf, offsets, INK_BYTES)
    n = len(starts)
    lower = buf.copy()
    capital = (buf >= 65) & (buf <= 90)
    lower[capital] += 32
    words = hash_spans(lower, starts, ends)
    # the shape: signs stay, letters fold into one sign each for lower and upper case
    shape = np.where(WORD_BYTES[buf], np.where(capital, 65, np.where((buf >= 48) & (buf <= 57), 48, 97)), buf).astype(np.uint8)
    head = np.zeros(len(buf), bool)
    head[1:] = shape[1:] == shape[:-1]
    begin = np.zeros(len(buf) + 1, bool)
    begin[starts] = True
    keep = ~head | begin[:-1]
    places = np.concatenate([[0], np.cumsum(keep)])
    shapes = hash_spans(shape[keep], places[starts], places[ends]) if n else words
    of = np.repeat(np.arange(len(texts)), np.diff(bounds))
    inner = np.zeros(n, bool)
    inner[1:] = of[1:] == of[:-1]
    second = np.flatnonzero(inner)
    same = second[words[second] == words[second - 1]]
    hashes = np.concatenate([
        mix(words ^ _WORD),
        mix(shapes ^ _SIGN),
        mix(words[second - 1] * _PAIR + words[second]),
        mix(shapes[second - 1] * _PAIR + shapes[second] + _SIGN),
        np.full(len(same), mix(np.array([_SAME]))[0]),
    ])
    owner = np.concatenate([of, of, of[second], of[second], of[same]])
    bucket = (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
    joint, counts = np.unique(owner * BUCKETS + bucket, return_counts=True)
    owner, bucket = joint // BUCKETS, joint % BUCKETS
    value = np.log1p(counts)
    norm = np.sqrt(np.bincount(owner, value * value, minlength=len(texts)))
    return bucket, value / norm[owner], np.searchsorted(owner, np.arange(len(texts) + 1))


def learn(texts: list[str], labels: np.ndarray, passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Weights and bias of one learner, one text at a time in the order given."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    rows = []
    for part in steps(pa.array(texts, pa.large_string())):
        bucket, value, first = features(part)
        rows += [(bucket[a:b].astype(np.int32), value[a:b].astype(np.float32)) for a, b in zip(first, first[1:])]
    for _ in range(passes):
        for (bucket, value), y in zip(rows, labels):
            at = np.append(bucket, BUCKETS)  # the last weight is the bias, without penalty
            x = np.append(value.astype(np.float64), 1.0)
            w = _weights(z[at], n[at])
            w[-1] = -z[BUCKETS] / ((BETA + np.sqrt(n[BUCKETS])) / ALPHA)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
            g = (p - y) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = _weights(z, n)
    return w[:-1], -z[BUCKETS] / ((BETA + np.sqrt(n[BUCKETS])) / ALPHA)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        """Chance of label 1: a sparse dot product a text."""
        out = []
        for part in steps(texts):
            bucket, value, first = features(part)
            terms = self.weights[bucket] * value
            sums = np.concatenate([[0.0], np.cumsum(terms)])
            # cumulative sums over a slice would differ by its neighbours: round them off
            out.append(np.round(sums[first[1:]] - sums[first[:-1]], 9))
        margin = np.concatenate(out) + self.bias if out else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _learner(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["turn", "text"], kind="stable")
    weights, bias = learn(group["text"].tolist(), group["label"].to_numpy(np.float64))
    kept = np.flatnonzero(weights)
    return pd.DataFrame(
        {"bucket": np.append(kept, BUCKETS), "weight": np.append(weights[kept], bias)}
    )


def fit(rows: DataFrame, learners: int = LEARNERS) -> Model:
    """Learns from ``text, label`` rows, a bounded sample, split over learners; weights average.

    Each learner has at most its share of the sample, so no task holds more. Without rows all
    weights are zero and every score is one half.
    """
    seed = F.xxhash64("text", F.lit(23))
    dealt = rows.select("text", F.col("label").cast("double").alias("label"), seed.alias("turn"))
    dealt = dealt.withColumn("learner", F.pmod("turn", F.lit(learners)))
    found = dealt.groupBy("learner").applyInPandas(_learner, "bucket long, weight double")
    found = materialize(found, "quality-learners")
    count = max(found.filter(F.col("bucket") == BUCKETS).count(), 1)
    table = found.groupBy("bucket").agg(F.sum("weight").alias("w")).toPandas()  # a row a bucket
    weights = np.zeros(BUCKETS + 1)
    weights[table.bucket] = table.w / count
    return Model(weights[:-1].astype(np.float32), float(weights[-1]))


def quality_score(text: Column | str, model: Model, docs: DataFrame) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.score(texts), pa.float64())

    return scored(text)


def score_quality(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS,
                  threshold: float = GOOD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, held_out, score, predicted`` of every row; null and empty texts score by the bias.

    Only the text decides a score. One projection over the documents.
    """
    model = fit(training_rows(docs, labels, "quality", bound, key, text))
    scored = docs.select(F.col(key), held_out(key).alias("held_out"), quality_score(text, model, docs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
