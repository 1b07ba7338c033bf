"""Count-based language model: estimation, corpus scoring and candidate scoring.

Contexts are bounded by powers of the vocabulary. An n-gram is one number (``gram_key``),
and a fitted model keeps one table from such numbers to log-probabilities, so scoring is one
lookup of the distinct n-grams and one that hands the results back.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import IGNORE_INDEX
from ..session import materialize
from .skew import lookup

#: Bits of a token in an n-gram's number; zero stands for no token.
TOKEN_BITS = 21
_TOKEN = (1 << TOKEN_BITS) - 1


def gram_key(c2: Column, c1: Column, token: Column) -> Column:
    """Three tokens in one long; a missing context, or no token, leaves its place empty.

    Without a token the number stands for the context, with whatever was never seen after it.
    """
    def place(tokens: Column, at: int) -> Column:
        return F.shiftleft(F.coalesce(tokens + 1, F.lit(0)).cast("long"), at * TOKEN_BITS)

    return place(c2, 2).bitwiseOR(place(c1, 1)).bitwiseOR(place(token, 0))


def _backed_off(key: Column) -> Column:
    """What to look for, best first: rank and number of the n-gram and context of each order."""
    third, second = key.bitwiseAND(_TOKEN << 2 * TOKEN_BITS), key.bitwiseAND(_TOKEN << TOKEN_BITS)
    token = key.bitwiseAND(_TOKEN)
    nothing = F.lit(None).cast("long")

    def ask(rank: int, number: Column, known: Column | None = None) -> Column:
        return F.struct(F.lit(rank).alias("rank"), (number if known is None else F.when(known, number).otherwise(nothing)).alias("probe"))

    two, one = third != 0, second != 0
    context = third.bitwiseOR(second)
    return F.array(
        ask(0, key, two), ask(1, context, two),
        ask(2, second.bitwiseOR(token), one), ask(3, second, one), ask(4, token),
    )


def _grams(context: Column, ids: Column) -> Column:
    """``c2, c1, token`` of each token in ``ids``, with ``context`` (two at most) before.

    Three shifted slices side by side; the work is linear in the row.
    """
    missing = F.array_repeat(F.lit(None).cast("int"), F.lit(2) - F.size(context))
    tokens, n = F.concat(missing, context, ids), F.size(ids)
    return F.arrays_zip(
        F.slice(tokens, F.lit(1), n).alias("c2"),
        F.slice(tokens, F.lit(2), n).alias("c1"),
        ids.alias("token"),
    )


def _exploded(rows: DataFrame, keys: tuple[str, ...], grams: Column) -> DataFrame:
    exploded = rows.select(*keys, F.posexplode(grams).alias("pos", "g"))
    names = zip(("c2", "c1", "token"), exploded.schema["g"].dataType.names)
    return exploded.select(*keys, "pos", *[F.col("g")[old].alias(new) for new, old in names])


def ngram_rows(table: DataFrame, *keys: str, context: Column | None = None) -> DataFrame:
    """``keys, pos, c2, c1, token``: every token with the two before it.

    ``context`` is an array of the tokens before a row; exported stories all follow the
    same end marker, so a stream needs no look at the row before.
    """
    before = F.array().cast("array<int>") if context is None else context
    rows = table.select(*keys, "ids", before.alias("__context"))
    return _exploded(rows, keys, _grams(F.col("__context"), F.col("ids")))


def target_rows(records: DataFrame, *keys: str) -> DataFrame:
    """``keys, pos, c2, c1, token``: the targets of encoded records that are not masked.

    A target follows the token at its own place in ``tokens``; the first has one token before it.
    """
    before = F.concat(F.array(F.lit(None).cast("int")), F.col("tokens"))
    grams = F.arrays_zip(
        F.slice(before, F.lit(1), F.size("tokens")).alias("c2"),
        F.col("tokens").alias("c1"),
        F.col("targets").alias("token"),
    )
    return _exploded(records, keys, grams).filter(F.col("token") != IGNORE_INDEX)


def ngram_counts(grams: DataFrame, *keys: str) -> DataFrame:
    """``keys, c2, c1, token, n``: equal n-grams folded before anything moves."""
    return grams.groupBy(*keys, "c2", "c1", "token").agg(F.count("*").alias("n"))


class NgramModel:
    """Unigram, bigram and trigram counts with add-k smoothing and back-off.

    The longest context seen in training decides: two tokens, one token, none.
    """

    @classmethod
    def fit(cls, grams: DataFrame, vocab_size: int, k: float = 0.1) -> "NgramModel":
        """Count once, keep the counts in shared storage, use them many times."""
        return cls(materialize(ngram_counts(grams), "ngrams"), vocab_size, k)

    def __init__(self, counts: DataFrame, vocab_size: int, k: float = 0.1):
        if k <= 0:
            raise ValueError("k must be positive")
        self.k, self.vocab_size = float(k), vocab_size
        self.tri = (
            counts.filter(F.col("c2").isNotNull() & F.col("c1").isNotNull())
            .groupBy("c2", "c1", "token").agg(F.sum("n").alias("n3"))
        )
        self.bi = counts.filter(F.col("c1").isNotNull()).groupBy("c1", "token").agg(
            F.sum("n").alias("n2")
        )
        self.uni = counts.groupBy("token").agg(F.sum("n").alias("n1"))
        self.total = self.uni.agg(F.sum("n1")).scalar()

    def table(self) -> DataFrame:
        """``ord, c2, c1, token, n, context_n, logp`` of every counted n-gram."""
        tri = self.tri.join(self._context3(), ["c2", "c1"]).select(
            F.lit(3).alias("ord"), "c2", "c1", "token", F.col("n3").alias("n"), F.col("m3").alias("context_n")
        )
        bi = self.bi.join(self._context2(), "c1").select(
            F.lit(2).alias("ord"), F.lit(None).cast("int").alias("c2"), "c1", "token",
            F.col("n2").alias("n"), F.col("m2").alias("context_n"),
        )
        uni = self.uni.select(
            F.lit(1).alias("ord"), F.lit(None).cast("int").alias("c2"),
            F.lit(None).cast("int").alias("c1"), "token", F.col("n1").alias("n"),
            self.total.alias("context_n"),
        )
        rows = tri.unionByName(bi).unionByName(uni)
        return rows.withColumn("logp", self._smooth(F.col("n"), F.col("context_n")))

    def _context3(self) -> DataFrame:
        return self.tri.groupBy("c2", "c1").agg(F.sum("n3").alias("m3"))

    def _context2(self) -> DataFrame:
        return self.bi.groupBy("c1").agg(F.sum("n2").alias("m2"))

    def _smooth(self, n: Column, context_n: Column) -> Column:
        return F.log(
            (F.coalesce(n, F.lit(0)) + self.k) / (context_n + self.k * self.vocab_size)
        )

    @cached_property
    def probabilities(self) -> DataFrame:
        """``probe, logp``: every counted n-gram, and every context for what it never saw."""
        none = F.lit(None).cast("int")

        def order(counts: DataFrame, n: str, c2: Column, c1: Column, *context: str) -> DataFrame:
            m = F.sum(n).over(Window.partitionBy(*context)) if context else self.total
            rows = counts.withColumn("m", m)  # a context has a row per vocabulary token at most
            seen = rows.select(gram_key(c2, c1, F.col("token")).alias("probe"), self._smooth(F.col(n), F.col("m")).alias("logp"))
            if not context:
                return seen
            after = rows.groupBy(*context).agg(F.first("m").alias("m"))
            return seen.unionByName(after.select(gram_key(c2, c1, none).alias("probe"), self._smooth(F.lit(0), F.col("m")).alias("logp")))

        return materialize(
            order(self.tri, "n3", F.col("c2"), F.col("c1"), "c2", "c1")
            .unionByName(order(self.bi, "n2", none, F.col("c1"), "c1"))
            .unionByName(order(self.uni, "n1", none, none)),
            "ngram-probabilities",
        )

    def score(self, grams: DataFrame) -> DataFrame:
        """Add ``logp, ord`` to rows with ``c2, c1, token``; fold equal rows first where that is many.

        Distinct n-grams ask for all their orders at once and keep the best answer. Frequent
        n-grams and contexts are looked up apart (``lookup``), so none floods a task.
        """
        rows = materialize(grams.withColumn("__gram", gram_key(F.col("c2"), F.col("c1"), F.col("token"))), "grams")
        distinct = rows.select("__gram").distinct()
        asked = distinct.select("__gram", F.explode(_backed_off(F.col("__gram"))).alias("ask"))
        asked = materialize(asked.select("__gram", "ask.rank", "ask.probe").filter("probe IS NOT NULL"), "gram-probes")
        answers = lookup(asked, self.probabilities, "probe").groupBy("__gram").agg(
            F.min_by("logp", "rank").alias("logp"), F.min("rank").alias("__rank")
        )
        never = self._smooth(F.lit(0), self.total)  # a token that training lacks, after nothing known
        order = 3 - F.floor(F.coalesce("__rank", F.lit(4)) / 2)
        scored = lookup(rows, answers, "__gram", "left")
        return scored.select(*grams.columns, F.coalesce("logp", never).alias("logp"), order.cast("int").alias("ord"))


def continuation_rows(items: DataFrame, *keys: str) -> DataFrame:
    """N-gram rows of candidate continuations (``prompt_ids, candidate_ids``).

    Each candidate token is conditioned on the prompt and the candidate so far. An empty
    prompt or candidate fails the job.
    """
    checked = F.when(
        (F.size("prompt_ids") > 0) & (F.size("candidate_ids") > 0),
        F.slice("prompt_ids", F.greatest(F.lit(1), F.size("prompt_ids") - 1), F.lit(2)),
    ).otherwise(F.raise_error(F.lit("prompt and candidate continuations cannot be empty")))
    rows = items.select(*keys, checked.alias("__tail"), "candidate_ids")
    return _exploded(rows, keys, _grams(F.col("__tail"), F.col("candidate_ids")))


def score_continuations(items: DataFrame, model: NgramModel, *keys: str) -> DataFrame:
    """``keys, score, positions``: log-probability sum per candidate.

    Distinct n-grams are scored once, and endings that many prompts share are handed back by
    broadcast.
    """
    scored = model.score(continuation_rows(items, *keys))
    return scored.groupBy(*keys).agg(F.sum("logp").alias("score"), F.count("*").alias("positions"))
