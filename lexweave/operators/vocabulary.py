"""Byte-pair vocabulary: word counts, pair counts, distributed merge learning.

Learning keeps the distinct words with their counts in shared storage. A round ranks the
pairs and cuts every word where a neighbouring pair counts less than a floor. Merges that
count at least the floor can neither cross such a cut nor be changed by what lies beyond
it, so the counted distinct pieces decide all of them, often hundreds, at once. The driver
sees at most ``CANDIDATES`` pairs and ``PIECE_CHARS`` symbols of pieces a round: the floor
rises until they fit.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import BYTE_VOCAB_SIZE, EOS_TOKEN, PAD_TOKEN, SPECIAL_TOKENS
from ..functions.text import line_pieces, pretokens
from ..functions.tokens import (
    MAX_SYMBOLS,
    adjacent_pairs,
    byte_order,
    plain_byte_symbols,
    symbol,
    symbol_id,
)
from ..session import materialize

CANDIDATES = 8192
#: Ranked pairs of the first round; later rounds double or halve them with the pieces' size.
FIRST_PAIRS = 64
PIECE_CHARS = 1 << 20
_WORD_END = "\0"


@dataclass(frozen=True)
class Vocabulary:
    """Merges in rank order as ``(left_id, right_id, new_id)``; size is set by the caller."""

    merges: tuple[tuple[int, int, int], ...] = ()
    tokens: tuple[bytes, ...] = field(default=())

    def __post_init__(self):
        tokens = [t.encode() for t in SPECIAL_TOKENS] + [bytes([b]) for b in byte_order()]
        for left, right, new in self.merges:
            if new == len(tokens):
                tokens.append(tokens[left] + tokens[right])
        object.__setattr__(self, "tokens", tuple(tokens))

    @property
    def size(self) -> int:
        return len(self.tokens)

    def token_id(self, token: str) -> int:
        if token not in SPECIAL_TOKENS:
            raise ValueError(f"vocabulary does not define {token}")
        return SPECIAL_TOKENS.index(token)

    @property
    def eos_id(self) -> int:
        return self.token_id(EOS_TOKEN)

    @property
    def pad_id(self) -> int:
        return self.token_id(PAD_TOKEN)

    @property
    def fingerprint(self) -> str:
        lines = [*SPECIAL_TOKENS, *(f"{l} {r} {n}" for l, r, n in self.merges)]
        return hashlib.sha256("\n".join(lines).encode()).hexdigest()

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, bytearray(t), i < len(SPECIAL_TOKENS)) for i, t in enumerate(self.tokens)]
        return spark.createDataFrame(rows, "token_id INT, token BINARY, special BOOLEAN")

    def merge_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, *m) for i, m in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank INT, left_id INT, right_id INT, new_id INT")

    def save(self, spark: SparkSession, path: str) -> None:
        self.vocab_table(spark).coalesce(1).write.parquet(f"{path}/vocab")
        self.merge_table(spark).coalesce(1).write.parquet(f"{path}/merges")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Vocabulary":
        """Read a saved vocabulary; its size is a configuration value, not data."""
        vocab = spark.read.parquet(f"{path}/vocab")
        required_special_tokens(vocab)
        rows = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
        return cls(tuple((r.left_id, r.right_id, r.new_id) for r in rows))


def required_special_tokens(vocab: DataFrame) -> DataFrame:
    """Fail when a vocabulary table lacks one of the fixed special tokens."""
    found = vocab.filter("special").select(F.decode("token", "UTF-8").alias("t"), "token_id")
    have = {r.t: r.token_id for r in found.limit(len(SPECIAL_TOKENS) + 1).collect()}
    missing = [t for i, t in enumerate(SPECIAL_TOKENS) if have.get(t) != i]
    if missing:
        raise ValueError(f"vocabulary is missing special tokens: {missing}")
    return vocab


def word_histogram(docs: DataFrame, text: str = "text", by_line: bool = False) -> DataFrame:
    """``word, n`` over a corpus. ``by_line`` learns line by line, newline kept."""
    column = F.col(text)
    found = (
        F.flatten(F.transform(line_pieces(column), pretokens)) if by_line else pretokens(column)
    )
    return docs.select(F.explode(found).alias("word")).groupBy("word").agg(
        F.count("*").alias("n")
    )


def _pair_rows(words: DataFrame) -> DataFrame:
    return words.select(F.explode(adjacent_pairs(F.col("sym"))).alias("pair"), "n")


def pair_counts(histogram: DataFrame) -> DataFrame:
    """``left_id, right_id, n``: adjacent byte tokens weighted by word count."""
    words = histogram.select(plain_byte_symbols(F.col("word")).alias("sym"), "n")
    counts = _pair_rows(words).groupBy("pair").agg(F.sum("n").alias("n"))
    return counts.select(
        symbol_id(F.substring("pair", 1, 1)).alias("left_id"),
        symbol_id(F.substring("pair", 2, 1)).alias("right_id"),
        "n",
    )


def _store_words(words: DataFrame) -> DataFrame:
    """Words that can still merge, spread evenly for the rounds to come."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(
        words.repartition(parts, "sym").filter(F.char_length("sym") > 1), "bpe-words"
    )


def _heavy_pairs(ranked: list[tuple[str, int]], limit: int, min_frequency: int) -> tuple[list[str], int]:
    """Of ranked pairs those that count more than the one after the first ``limit``, and the floor.

    Without ties at the limit these are ``limit`` pairs; none if all of them tie.
    """
    if len(ranked) <= limit:
        return [pair for pair, _ in ranked], min_frequency
    floor = ranked[limit][1] + 1
    return [pair for pair, n in ranked[:limit] if n >= floor], floor


def _pieces_of(words: pa.Array, heavy: np.ndarray) -> tuple[str, list[tuple[int, int]]]:
    """Words end to end, and the runs of symbols whose neighbouring pairs are all heavy."""
    line = _WORD_END.join(words.to_pylist())
    codes = np.frombuffer(line.encode("utf-32-le"), "<u4").astype(np.uint64)
    pairs = (codes[:-1] << np.uint64(32)) | codes[1:]
    at = np.searchsorted(heavy, pairs)
    at[at == len(heavy)] = 0
    inside = np.concatenate([[False], heavy[at] == pairs, [False]])
    starts = np.flatnonzero(~inside[:-1] & inside[1:])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    return line, list(zip(starts.tolist(), ends.tolist()))


def _pair_codes(heavy: list[str]) -> np.ndarray:
    return np.sort(np.array([ord(p[0]) << 32 | ord(p[1]) for p in heavy], np.uint64))


def _cut(heavy: list[str]):
    codes = _pair_codes(heavy)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            line, runs = _pieces_of(batch.column(0), codes)
            word_ends = np.cumsum([len(w) + 1 for w in batch.column(0).to_pylist()])
            owner = np.searchsorted(word_ends, [a for a, _ in runs], "right")
            counts = batch.column(1).to_numpy()[owner].tolist()
            total: dict[str, int] = defaultdict(int)
            for (a, b), n in zip(runs, counts):
                total[line[a:b]] += n
            yield pa.record_batch(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["piece", "n"]
            )

    return cut


def _rewrite(heavy: list[str], merged: dict[str, str]):
    codes = _pair_codes(heavy)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            line, runs = _pieces_of(batch.column(0), codes)
            parts, done = [], 0
            for a, b in runs:
                parts += line[done:a], merged[line[a:b]]
                done = b
            parts.append(line[done:])
            words = "".join(parts).split(_WORD_END)
            yield pa.record_batch([pa.array(words, pa.string()), batch.column(1)], ["sym", "n"])

    return rewrite


class _Tokens:
    """Tokens and merges found so far."""

    def __init__(self):
        self.by_id = list(Vocabulary().tokens)
        self.known = {t: i for i, t in enumerate(self.by_id)}
        self.symbols = {symbol(i): i for i in range(len(self.by_id))}
        self.merges: list[tuple[int, int, int]] = []

    def joined(self, pair: str) -> bytes:
        return self.by_id[self.symbols[pair[0]]] + self.by_id[self.symbols[pair[1]]]

    def add(self, pair: str) -> str:
        """Take a pair as the next merge; a token spelled like an older one keeps its id."""
        token = self.joined(pair)
        if token not in self.known:
            self.known[token] = len(self.by_id)
            self.symbols[symbol(len(self.by_id))] = len(self.by_id)
            self.by_id.append(token)
        new = self.known[token]
        self.merges.append((self.symbols[pair[0]], self.symbols[pair[1]], new))
        return symbol(new)


def _merge_pieces(
    pieces: list[str], counts: list[int], floor: int, vocab_size: int, tokens: _Tokens
) -> list[str]:
    """Merge the best pair of the pieces until it counts less than ``floor``; the pieces after.

    A merge whose token exists already may add to pairs that lie beyond the cuts, so it is only
    taken as the first of a round, and ends it.
    """
    pieces = list(pieces)
    total: dict[str, int] = defaultdict(int)
    holders: dict[str, set[int]] = defaultdict(set)
    for i, (piece, n) in enumerate(zip(pieces, counts)):
        for pair in map("".join, zip(piece, piece[1:])):
            total[pair] += n
            holders[pair].add(i)
    # symbols sort like ids, so ties go to the smallest ids
    heap = [(-n, pair) for pair, n in total.items() if n >= floor]
    heapq.heapify(heap)
    first = True
    while heap and len(tokens.by_id) < vocab_size:
        n, pair = heapq.heappop(heap)
        if total[pair] != -n:
            continue
        again = tokens.joined(pair) in tokens.known
        if again and not first:
            break
        new = tokens.add(pair)
        changed = set()
        for i in holders.pop(pair):
            old = pieces[i]
            pieces[i] = old.replace(pair, new)
            if pieces[i] == old:
                continue
            for p in map("".join, zip(old, old[1:])):
                total[p] -= counts[i]
                changed.add(p)
            for p in map("".join, zip(pieces[i], pieces[i][1:])):
                total[p] += counts[i]
                holders[p].add(i)
                changed.add(p)
        for p in changed:
            if total[p] >= floor:
                heapq.heappush(heap, (-total[p], p))
        if again:
            break
        first = False
    return pieces


def learn_vocabulary(histogram: DataFrame, vocab_size: int = 10_000, min_frequency: int = 2) -> Vocabulary:
    """Greedy byte-pair merges from a word histogram.

    The best pair has the highest count, ties go to the smallest ids. Learning ends at
    ``vocab_size`` or when no pair reaches ``min_frequency``.
    """
    if vocab_size < BYTE_VOCAB_SIZE:
        raise ValueError("vocab_size must leave room for the byte alphabet")
    if vocab_size > MAX_SYMBOLS:
        raise ValueError(f"vocab_size above {MAX_SYMBOLS} has no symbol form")
    if min_frequency <= 0:
        raise ValueError("min_frequency must be positive")

    words = _store_words(histogram.select(plain_byte_symbols(F.col("word")).alias("sym"), "n"))
    tokens, limit = _Tokens(), FIRST_PAIRS
    while len(tokens.by_id) < vocab_size:
        pairs = _pair_rows(words).groupBy("pair").agg(F.sum("n").alias("n"))
        top = pairs.filter(F.col("n") >= min_frequency).orderBy(F.desc("n"), "pair").limit(limit + 1)
        ranked = [(r["pair"], r["n"]) for r in top.collect()]
        if not ranked:
            break
        while True:
            heavy, floor = _heavy_pairs(ranked, limit, min_frequency)
            if len(heavy) < 2:
                break
            cut = words.mapInArrow(_cut(heavy), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
            cut = materialize(cut, "bpe-pieces")
            size = cut.agg(F.sum(F.char_length("piece"))).first()[0] or 0
            if size <= PIECE_CHARS:
                break
            limit = max(limit // 2, 1)
        if len(heavy) < 2:
            # ties or long pieces leave the best pair alone to be sure of
            new = tokens.add(ranked[0][0])
            words = _store_words(words.select(F.replace("sym", F.lit(ranked[0][0]), F.lit(new)).alias("sym"), "n"))
            limit = min(limit * 2, CANDIDATES)
            continue
        found = cut.collect()  # PIECE_CHARS symbols at most
        pieces = [r["piece"] for r in found]
        after = _merge_pieces(pieces, [r["n"] for r in found], floor, vocab_size, tokens)
        if len(tokens.by_id) >= vocab_size:
            break
        words = _store_words(words.mapInArrow(_rewrite(heavy, dict(zip(pieces, after))), "sym string, n long"))
        if size <= PIECE_CHARS // 4:
            limit = min(limit * 2, CANDIDATES)
    return Vocabulary(tuple(tokens.merges))


def train_vocabulary(
    docs: DataFrame,
    vocab_size: int = 10_000,
    min_frequency: int = 2,
    *,
    text: str = "text",
    by_line: bool = True,
) -> Vocabulary:
    """Learn from a corpus; ``by_line`` is the grain of file-based learning."""
    return learn_vocabulary(word_histogram(docs, text, by_line), vocab_size, min_frequency)
