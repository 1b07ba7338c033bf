"""Toxic passages: maximum-scoring segments of token log-odds, extreme-value calibrated."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import materialize
from .common import WORD_BYTES, hash_spans, steps, text_buffer, word_spans
from .labelled import TRAINING_ROWS, held_out, training_rows

#: Buckets of hashed words, and as many of word beginnings of STEM bytes.
BUCKETS = 1 << 18
STEM = 6
#: Total weight of the Dirichlet prior, spread like the tokens of all labelled texts.
PRIOR = 5000.0
#: Standard errors a log-odds must be away from zero to count.
CERTAIN = 3.0
#: What a token that says nothing takes off a segment's score.
DRIFT = 0.4
#: Labelled rows of this fold calibrate; the token scores come from the others.
CALIBRATION_FOLD = 3
BINS = 64
TOXIC = 0.3


# --- tokens --------------------------------------------------------------------------------


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
    """Word buckets, stem buckets, the first word of each text, and byte spans of the words."""
    buf, offsets = text_buffer(pc.utf8_lower(pc.fill_null(texts, "")))
    starts, ends, bounds = word_spans(buf, offsets, WORD_BYTES)
    low = np.uint64(BUCKETS - 1)
    words = (hash_spans(buf, starts, ends) & low).astype(np.int64)
    stems = (hash_spans(buf, starts, np.minimum(ends, starts + STEM)) & low).astype(np.int64)
    return words, stems + BUCKETS, bounds, (starts, ends, offsets)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and other texts of one task that hold a token, by bucket.

    A text counts once, so a token that one text repeats is no evidence by itself.
    """
    counts = np.zeros((2, 2 * BUCKETS), np.int64)
    for batch in batches:
        label = batch.column("label").to_numpy()
        at = 0
        for part in steps(batch.column("text")):
            words, stems, bounds, _ = tokens(part)
            of = np.repeat(np.arange(len(part)), np.diff(bounds))
            for found in (words, stems):
                once = np.unique(of * (2 * BUCKETS) + found)
                y = label[at + once // (2 * BUCKETS)]
                np.add.at(counts, (y, once % (2 * BUCKETS)), 1)
            at += len(part)
    seen = np.flatnonzero(counts.sum(axis=0))
    yield pa.record_batch([pa.array(seen), pa.array(counts[1, seen]), pa.array(counts[0, seen])], ["bucket", "toxic", "other"])


def log_odds(toxic: np.ndarray, other: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of each token between two groups under a Dirichlet prior, and standard errors."""
    both = toxic + other
    alpha = prior * (both + 0.01) / (both.sum() + 0.01 * len(both))
    t, o = toxic + alpha, other + alpha
    odds = np.log(t / (t.sum() - t)) - np.log(o / (o.sum() - o))
    return odds, np.sqrt(1 / t + 1 / o)


# --- segments ------------------------------------------------------------------------------


def maximal_segments(at: list[int], score: list[float], drift: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments, as (score, first, last token), in linear time.

    ``at`` and ``score`` are the tokens that add to a segment; every other token takes ``drift``.
    A new token joins the nearest earlier segment that starts lower, if it lifts that segment's
    highest sum; links to that earlier segment make each one be looked at once.
    """
    held: list[list] = []  # start sum, end sum, first, last, nearest earlier with a lower start
    total, last = 0.0, -1
    for i, s in zip(at, score):
        total -= drift * (i - last - 1)
        low, high, first = total, total + s, i
        total, last = high, i
        j = len(held) - 1
        while True:
            while j >= 0 and held[j][0] >= low:
                j = held[j][4]
            if j < 0 or held[j][1] >= high:
                held.append([low, high, first, i, j])
                break
            low, first, link = held[j][0], held[j][2], held[j][4]
            del held[j:]
            j = link
    return [(h[1] - h[0], h[2], h[3]) for h in held]


def decay(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of ``sum(share * exp(x * score)) = 1``: the tail of segment scores."""
    low, high = 0.0, 1.0
    value = lambda x: float((shares * np.exp(x * scores)).sum())
    while value(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 1 else (low, middle)
    return high


@dataclass
class Model:
    """Token scores, the tail of the segment scores of clean text, and the calibration."""

    scores: np.ndarray
    rate: float
    edges: np.ndarray
    chance: np.ndarray
    #: False if no labelled row was there to calibrate with; every score is then 0.5.
    calibrated: bool = True

    def segments(self, texts: pa.Array) -> list[list[tuple[float, int, int]]]:
        """Significant segments of each text: bits beyond chance, first and last word."""
        words, stems, bounds, _ = tokens(texts)
        value = np.where(
            np.abs(self.scores[words]) >= np.abs(self.scores[stems]), self.scores[words], self.scores[stems]
        )
        up = np.flatnonzero(value > DRIFT)
        cut = np.searchsorted(up, bounds)
        out = []
        for row in range(len(texts)):
            found = []
            if cut[row] < cut[row + 1]:
                here = up[cut[row] : cut[row + 1]]
                n = int(bounds[row + 1] - bounds[row])
                chance = math.log(n + 1)  # places a segment can start
                for s, a, b in maximal_segments((here - bounds[row]).tolist(), (value[here] - DRIFT).tolist(), DRIFT):
                    beyond = self.rate * s - chance
                    if beyond > 0:  # fewer than one such segment is expected by chance
                        found.append((beyond, a, b))
            out.append(found)
        return out

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Sum of what a text's significant segments have beyond chance."""
        return np.array([sum(s for s, _, _ in found) for found in self.segments(texts)])

    def score(self, texts: pa.Array) -> np.ndarray:
        """The chance of label 1 at that evidence."""
        if not len(texts):
            return np.zeros(0)
        found = np.concatenate([self.evidence(p) for p in steps(texts)])
        return np.interp(np.log1p(found), self.edges, self.chance)


def monotone(ones: np.ndarray, all_: np.ndarray) -> np.ndarray:
    """Shares that never fall, by pooling neighbours that do."""
    pools: list[list[float]] = []
    for a, n in zip(ones, all_):
        pools.append([a, n, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            a2, n2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + a2, pools[-1][1] + n2, pools[-1][2] + k2]
    return np.concatenate([np.full(int(k), a / max(n, 1e-9)) for a, n, k in pools])


def fit(rows: DataFrame) -> Model:
    """Learns from ``fold, text, label``. Without labels of both kinds every score is the share.

    Counts are summed by Spark; the driver holds one row a bucket, 2 * BUCKETS at most, and
    BINS rows of calibration counts.
    """
    learned = rows.filter(F.col("fold") != CALIBRATION_FOLD).select("text", "label")
    counted = learned.mapInArrow(_count, "bucket long, toxic long, other long")
    table = counted.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toPandas()
    toxic, other = np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    toxic[table.bucket], other[table.bucket] = table.toxic, table.other
    scores, rates = np.full(2 * BUCKETS, 0.0), []
    for kind in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        if toxic[kind].sum() and other[kind].sum():
            odds, error = log_odds(toxic[kind], other[kind], PRIOR)
            sure = np.abs(odds) - CERTAIN * error > 0
            scores[kind] = np.where(sure, odds, 0.0)
            share = (other[kind] + 0.01) / (other[kind].sum() + 0.01 * BUCKETS)
            rates.append(decay(np.where(scores[kind] > DRIFT, scores[kind], 0.0) - DRIFT, share))
    model = Model(scores, min(rates, default=1.0), np.array([0.0]), np.array([0.5]))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def evidence(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([shared.value.evidence(p) for p in steps(texts)]) if len(texts) else [], pa.float64())

    checked = rows.filter(F.col("fold") == CALIBRATION_FOLD)
    strength = F.log1p(evidence("text"))
    bins = checked.select(F.least(F.ceil(strength * 8), F.lit(BINS - 1)).alias("bin"), "label")
    bins = bins.groupBy("bin").agg(F.sum("label").alias("ones"), F.count("*").alias("n")).collect()
    ones, total = np.zeros(BINS), np.zeros(BINS)
    for r in bins:
        ones[r["bin"]], total[r["bin"]] = r["ones"], r["n"]
    share = (ones.sum() + 0.5) / (total.sum() + 1)
    used = np.flatnonzero(total) if total.any() else np.arange(1)
    model.calibrated = bool(total.any())
    model.edges = used / 8
    model.chance = monotone(ones[used] + share / 2, total[used] + 0.5)
    return model


def toxic_score(text: Column | str, model: Model) -> Column:
    shared = _share(model)

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.score(texts), pa.float64())

    return scored(text)


def _share(model: Model):
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession().sparkContext.broadcast(model)


def toxic_passages(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every significant passage: ``key, passage, beyond``; words of the lower-cased text."""
    shared = _share(model)
    kind = pa.list_(pa.struct([("passage", pa.string()), ("beyond", pa.float64())]))

    @F.arrow_udf("array<struct<passage:string,beyond:double>>")
    def found(texts: pa.Array) -> pa.Array:
        rows = []
        for part in steps(texts):
            buf, _ = text_buffer(pc.utf8_lower(pc.fill_null(part, "")))
            _, _, bounds, (starts, ends, _) = tokens(part)
            for row, segments in enumerate(shared.value.segments(part)):
                rows.append([
                    {"passage": buf[starts[bounds[row] + a] : ends[bounds[row] + b]].tobytes().decode("utf-8", "replace"), "beyond": s}
                    for s, a, b in segments
                ])
        return pa.array(rows, kind)

    return docs.select(F.col(key), F.explode(found(text)).alias("p")).select(key, "p.*")


def score_toxicity(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS,
                   threshold: float = TOXIC, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, held_out, score, predicted`` of every row; null and empty texts have no evidence.

    Only the text decides a score: equal texts have equal scores. One projection over the
    documents; without usable labels every score is 0.5.
    """
    model = fit(materialize(training_rows(docs, labels, "toxic", bound, key, text), "toxic-rows"))
    scored = docs.select(F.col(key), held_out(key).alias("held_out"), toxic_score(text, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS,
               threshold: float = TOXIC, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that score under the threshold, with all their columns.

    Without labels to calibrate with nothing is known to be toxic, and all documents stay.
    """
    model = fit(materialize(training_rows(docs, labels, "toxic", bound, key, text), "toxic-rows"))
    return docs.filter(toxic_score(text, model) < threshold) if model.calibrated else docs
