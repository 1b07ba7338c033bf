"""Token counts of whole texts; huge ones by overlapping chunks spliced where they agree."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .encoder import encoder

#: Characters of a chunk and of the overlap that is tried first.
CHUNK = 1 << 16
OVERLAP = 1 << 9
LIMIT = 1024


class Chunk:
    """One chunk's encoding: where its pre-tokens start and how many tokens stand before each."""

    def __init__(self, tokenizer, text: str, start: int, end: int):
        self.start, self.end = start, end
        coded = tokenizer.encode(text[start:end], add_special_tokens=False)
        n = len(coded.ids)
        begins = np.fromiter((o[0] for o in coded.offsets), np.int64, n)
        words = np.fromiter((-1 if w is None else w for w in coded.word_ids), np.int64, n)
        first = np.ones(n, bool)
        first[1:] = (words[1:] != words[:-1]) | (words[1:] < 0)
        self.tokens = np.flatnonzero(first)
        self.begins = begins[self.tokens] + start
        self.n = n

    def before(self, place: int) -> int:
        """Tokens before the pre-token that starts at ``place``; all if none starts there."""
        at = int(np.searchsorted(self.begins, place))
        return int(self.tokens[at]) if at < len(self.tokens) else self.n

    def sure(self, reach: int) -> np.ndarray:
        """Starts that the text after the chunk cannot move.

        A pre-token ends where the pattern stops, one character of lookahead included, so only
        the last one can grow; an added token that the end cuts reaches back ``reach``.
        """
        starts = self.begins[:-1] if len(self.begins) else self.begins
        return starts[starts <= self.end - reach]


def spliced_count(tokenizer, text: str, chunk: int, overlap: int, reach: int) -> int:
    """Tokens of a text from chunks that are encoded on their own.

    Chunk k covers its stride and an overlap before it. If a start that is sure in one chunk is
    also a start in the next, both agree from there on, as matching never looks back from the
    start of a pre-token: the two are spliced at the first such place. Without one the overlap
    doubles; at the last splice at the latest, a true start, the chunks agree.
    """
    total, splice = 0, 0
    current = Chunk(tokenizer, text, 0, min(chunk, len(text)))
    while current.end < len(text):
        end = min(current.end + chunk, len(text))
        width = overlap
        while True:
            start = max(current.end - width, splice)
            following = Chunk(tokenizer, text, start, end)
            common = np.intersect1d(current.sure(reach), following.begins)
            common = common[common >= splice]
            if start == splice:
                common = np.array([splice])
            if len(common):
                break
            width *= 2
        place = int(common[0])
        total += current.before(place) - current.before(splice)
        current, splice = following, place
    return total + current.n - current.before(splice)


@lru_cache(maxsize=4)
def _reach(path: str) -> int:
    added = encoder(path).tokenizer.get_added_tokens_decoder().values()
    return 1 + max((len(t.content) for t in added), default=0)


def count_tokens(path: str, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    coder = encoder(path)
    if len(text) <= chunk or coder.quick is None:
        return len(coder.encode(text))
    return spliced_count(coder.tokenizer, text, chunk, overlap, _reach(path))


def token_count(text: Column | str, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """Number of tokens of a whole text; null counts as empty."""

    @F.arrow_udf(T.LongType())
    def counted(texts: pa.Array) -> pa.Array:
        counts = (count_tokens(path, t.as_py() or "", chunk, overlap) for t in texts)
        return pa.array(np.fromiter(counts, np.int64, len(texts)))

    return counted(text)


def token_counts(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """Per row: ``key, n_bytes, n_tokens, over_limit``.

    A projection without a shuffle. Null texts count as empty; repeated rows and null keys keep
    their rows. Chunks apply to files whose pre-tokens are known to restart anywhere
    (``encoder.quick``); texts under other files are encoded in one go.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    counted = docs.select(
        F.col(key), F.octet_length(whole).cast("long").alias("n_bytes"), token_count(text, path).alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
