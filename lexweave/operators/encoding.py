"""Corpus encoding and decoding, each one projection."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..constants import SPECIAL_TOKENS, WORD_PATTERN
from ..functions.text import words
from ..functions.tokens import byte_ids, byte_order
from .vocabulary import Vocabulary

#: Distinct words whose ids a task remembers.
SEEN_WORDS = 200_000


def word_encoder(vocabulary: Vocabulary) -> Callable[[str], list[int]]:
    """Replay merges on one pre-token; the function is small enough to ship to tasks."""
    ranks = {(l, r): (i, n) for i, (l, r, n) in reversed(list(enumerate(vocabulary.merges)))}
    first = {t[0]: i for i, t in enumerate(vocabulary.tokens) if len(t) == 1}
    specials = {t: i for i, t in enumerate(SPECIAL_TOKENS)}

    def encode(word: str) -> list[int]:
        if word in specials:
            return [specials[word]]
        ids = [first[b] for b in word.encode()]
        while len(ids) > 1:
            options = [ranks[p] + p for p in zip(ids, ids[1:]) if p in ranks]
            if not options:
                break
            _, new, left, right = min(options)
            merged, i = [], 0
            while i < len(ids):
                if ids[i] == left and ids[i + 1 : i + 2] == [right]:
                    merged.append(new)
                    i += 2
                else:
                    merged.append(ids[i])
                    i += 1
            ids = merged
        return ids

    return encode


def text_encoder(vocabulary: Vocabulary) -> Callable[[str], list[int]]:
    """Encode a short text inside a task, for searches that measure many candidates."""
    encode = word_encoder(vocabulary)
    special = "|".join(SPECIAL_TOKENS)
    pattern = WORD_PATTERN
    seen: dict[str, list[int]] = {}

    def encode_text(text: str) -> list[int]:
        import regex

        out: list[int] = []
        for segment in regex.split(f"({special})", text):
            whole = segment in SPECIAL_TOKENS
            for word in [segment] if whole else regex.findall(pattern, segment):
                if word not in seen:
                    if len(seen) > 100_000:
                        seen.clear()
                    seen[word] = encode(word)
                out += seen[word]
        return out

    return encode_text


def _words_to_ids(listed: pa.Array, replay: Callable[[str], list[int]], seen: dict) -> tuple:
    """Codes of all words of a batch of word lists, and ids and id counts of its distinct words."""
    coded = pc.dictionary_encode(listed.flatten())
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    distinct = coded.dictionary.to_pylist()
    if len(seen) > SEEN_WORDS:
        seen.clear()
    for word in distinct:
        if word not in seen:
            seen[word] = np.array(replay(word), np.int32)
    ids = [seen[word] for word in distinct]
    return coded.indices.to_numpy(zero_copy_only=False), ids, np.array([len(i) for i in ids], np.int64)


def _row_ends(listed: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """Where each row's tokens end, from the token counts of all its words; null rows hold none."""
    words = pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(words)]


def token_ids(vocabulary: Vocabulary) -> Callable[[Column], Column]:
    """Column function text -> token ids; null stays null.

    Texts are cut to words inside the JVM. A task replays the merges once per distinct word of an
    Arrow batch, remembering up to SEEN_WORDS, so nothing is shuffled and no word is hot.
    """
    if not vocabulary.merges:
        return byte_ids
    replay = word_encoder(vocabulary)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen: dict[str, np.ndarray] = {}
        for listed in batches:
            codes, ids, counts = _words_to_ids(listed, replay, seen)
            flat = np.concatenate([np.zeros(0, np.int32), *ids])
            first, sizes = (np.cumsum(counts) - counts)[codes], counts[codes]
            # the ids of word k stand in a row from first[k] on
            within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            ends = np.concatenate([[0], _row_ends(listed, sizes)])
            values = pa.array(flat[np.repeat(first, sizes) + within])
            yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values, mask=listed.is_null())

    return lambda text: encode(words(text))


def _byte_values() -> np.ndarray:
    """Token id of each byte value."""
    ids = np.zeros(256, np.int32)
    ids[byte_order()] = len(SPECIAL_TOKENS) + np.arange(256)
    return ids


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def byte_ids_of(texts: pa.Array) -> pa.Array:
    """``byte_ids`` of whole columns of long texts: an Arrow batch at a time, null stays null."""
    ids_of = _byte_values()
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[ends[0] : ends[-1]] if held is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    ids, keep = ids_of[data], np.ones(len(data), bool)
    opened = np.flatnonzero(data == ord("<"))
    for number, token in enumerate(SPECIAL_TOKENS):
        at = opened[opened + len(token) <= len(data)]
        for place, byte in enumerate(token.encode()):
            at = at[data[at + place] == byte]
        last = at + len(token) - 1
        at = at[np.searchsorted(ends, at, "right") == np.searchsorted(ends, last, "right")]  # in one row
        ids[at] = number
        keep[(at[:, None] + np.arange(1, len(token))).ravel()] = False
    kept = np.concatenate([[0], np.cumsum(keep)])[ends]
    return pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), pa.array(ids[keep]), mask=texts.is_null())


def token_count_udf(vocabulary: Vocabulary) -> Callable[[Column | str], Column]:
    """Column function text -> number of tokens, without building the ids of a text."""
    replay = word_encoder(vocabulary)

    @F.arrow_udf(T.IntegerType())
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen: dict[str, np.ndarray] = {}
        for listed in batches:
            codes, _, counts = _words_to_ids(listed, replay, seen)
            ends = _row_ends(listed, counts[codes])
            yield pa.array(np.diff(ends, prepend=0).astype(np.int32), mask=listed.is_null().to_numpy(zero_copy_only=False))

    return lambda text: count(words(F.col(text) if isinstance(text, str) else text))


def piecewise_count_udf(vocabulary: Vocabulary) -> Callable[[Column, Column, Column], Column]:
    """Column function ``head, shots, tail`` -> token counts of ``head + shots[:k] + tail`` for every k.

    Heads and shots repeat, so a task counts each once; only the tail is a row's own. Where a piece
    ends with two newlines and the next begins with something solid, counts of pieces add up; any
    other text is counted whole.
    """
    encode, replay = text_encoder(vocabulary), word_encoder(vocabulary)

    def opens(text: str) -> bool:
        return bool(text) and not text[0].isspace()

    def adding(before: list[str]) -> bool:
        ends = all(len(p) > 2 and p.endswith("\n\n") and not p[-3].isspace() for p in before)
        return ends and all(map(opens, before[1:]))

    def size_of(text: str, known: dict[str, int]) -> int:
        if text not in known:
            known[text] = len(encode(text))
        return known[text]

    def joined(piece: str, following: str, known: dict[str, int]) -> int:
        """Tokens of ``piece`` before ``following``: its last newline is a word of its own there, unless a special token ends the run."""
        if following.startswith(SPECIAL_TOKENS):
            return size_of(piece, known)
        return size_of(piece[:-1], known) + 1

    def before_tail(before: list[str], known: dict[str, int]) -> tuple | None:
        """Tokens before the tail for every k, if it opens with a word and if with a special token."""
        if not adding(before):
            return None
        done = np.cumsum([0, *(joined(p, q, known) for p, q in zip(before, before[1:]))])
        return tuple(done + [joined(p, first, known) for p in before] for first in ("a", SPECIAL_TOKENS[0]))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def counts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known: dict[str, int] = {}
        seen: dict[str, np.ndarray] = {}
        for heads, shots, tails in batches:
            if len(known) > SEEN_WORDS // 100:
                known.clear()
            codes, _, sizes = _words_to_ids(tails, replay, seen)
            own = np.diff(_row_ends(tails, sizes[codes]), prepend=0)
            head, shot = heads.dictionary_encode(), shots.flatten().dictionary_encode()
            head_texts, shot_texts = head.dictionary.to_pylist(), shot.dictionary.to_pylist()
            shot_codes = shot.indices.to_pylist()
            ends = np.cumsum(pc.fill_null(pc.list_value_length(shots), 0).to_numpy(zero_copy_only=False))
            words_of, stops = tails.flatten(), np.cumsum(pc.fill_null(pc.list_value_length(tails), 0).to_numpy(zero_copy_only=False))
            starts = np.concatenate([[0], stops[:-1]]) if len(stops) else stops
            firsts = [words_of[int(i)].as_py() if i < j else "" for i, j in zip(starts, stops)]
            nulls = pc.or_(pc.or_(heads.is_null(), shots.is_null()), tails.is_null()).to_pylist()
            fronts: dict[tuple, tuple | None] = {}
            out, start = [], 0
            for row, (h, end) in enumerate(zip(head.indices.to_pylist(), ends.tolist())):
                front, start = (h, *shot_codes[start:end]), end
                if nulls[row] or None in front:
                    out.append(None)
                    continue
                before = [head_texts[h], *(shot_texts[c] for c in front[1:])]
                if front not in fronts:
                    fronts[front] = before_tail(before, known)
                first = firsts[row]
                if fronts[front] is None or not opens(first):
                    tail = "".join(tails[row].as_py())
                    out.append([len(encode("".join([*before[: k + 1], tail]))) for k in range(len(before))])
                else:
                    out.append((fronts[front][first in SPECIAL_TOKENS] + own[row]).tolist())
            yield pa.array(out, pa.list_(pa.int32()))

    return lambda head, shots, tail: counts(head, shots, words(tail))


def encode_corpus(
    docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, ids`` for every row: one projection, with or without merges."""
    return docs.select(key, token_ids(vocabulary)(F.col(text)).alias("ids"))


def decode_ids(ids: Column, vocabulary: Vocabulary, skip_special: bool = False) -> Column:
    """Text of a token array; malformed bytes become the replacement character."""
    spelled = b"".join(vocabulary.tokens)
    lengths = np.array([len(t) for t in vocabulary.tokens], np.int64)
    shown = len(SPECIAL_TOKENS) if skip_special else 0

    @F.arrow_udf(T.BinaryType())
    def decode(batch: pa.Array) -> pa.Array:
        data, first = np.frombuffer(spelled, np.uint8), np.cumsum(lengths) - lengths
        values = batch.flatten()
        found = pc.fill_null(values, -1).to_numpy(zero_copy_only=False)
        missing = values.is_null().to_numpy(zero_copy_only=False)
        if ((found < 0) & ~missing).any() or (found >= len(lengths)).any():
            raise ValueError("a token id lies outside the vocabulary")
        sizes = np.where(missing | (found < shown), 0, lengths[found])
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out = data[np.repeat(first[found], sizes) + within]
        ends = np.concatenate([[0], _row_ends(batch, sizes)]).astype(np.int64)
        texts = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(batch), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(out.tobytes())]
        ).cast(pa.binary())
        return pc.if_else(batch.is_null(), pa.scalar(None, pa.binary()), texts)

    return F.make_valid_utf8(decode(ids).cast("string"))
