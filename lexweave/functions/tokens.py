"""Byte-level token ids as string symbols and arrays, all inside the JVM.

A token id is held as one character (``symbol``), so a word is a short string and a
byte-pair merge is a plain ``replace``. Symbols sort like ids.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ..constants import BYTE_RANGES, SPECIAL_TOKENS

_BASE = 0x100
_GAP_START, _GAP = 0xD800, 0x800  # surrogates are not characters
MAX_SYMBOLS = 0x110000 - _BASE - _GAP


def symbol(token_id: int) -> str:
    code = token_id + _BASE
    return chr(code if code < _GAP_START else code + _GAP)


def symbol_id(char: Column) -> Column:
    code = F.ascii(char)
    return F.when(code < _GAP_START, code - _BASE).otherwise(code - _BASE - _GAP).cast("int")


def byte_order() -> list[int]:
    """Byte values in id order; the first one has the id after the special tokens."""
    return [b for low, high in BYTE_RANGES for b in range(low, high + 1)]


def byte_id(value: Column) -> Column:
    """Token id of a byte value, arithmetic over the fixed ranges."""
    start = len(SPECIAL_TOKENS)
    out = None
    for low, high in BYTE_RANGES:
        test, result = value.between(low, high), value - low + start
        out = F.when(test, result) if out is None else out.when(test, result)
        start += high - low + 1
    return out.cast("int")


def byte_symbols(text: Column) -> Column:
    """UTF-8 bytes of a text as symbols; special-token texts become their own symbol."""
    order = byte_order()
    source = "".join(chr(b) for b in order)
    target = "".join(symbol(len(SPECIAL_TOKENS) + i) for i in range(len(order)))
    latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    marked = reduce(
        lambda s, item: F.replace(s, F.lit(item[1]), F.lit(symbol(item[0]))),
        enumerate(SPECIAL_TOKENS),
        latin,
    )
    return F.translate(marked, source, target)


def plain_byte_symbols(text: Column) -> Column:
    """Like :func:`byte_symbols`, but special-token texts count as ordinary bytes."""
    order = byte_order()
    source = "".join(chr(b) for b in order)
    target = "".join(symbol(len(SPECIAL_TOKENS) + i) for i in range(len(order)))
    return F.translate(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), source, target)


def symbol_chars(symbols: Column) -> Column:
    return F.regexp_extract_all(symbols, F.lit("(?s)."), F.lit(0))


def symbols_to_ids(symbols: Column) -> Column:
    return F.transform(symbol_chars(symbols), symbol_id)


def byte_ids(text: Column) -> Column:
    """Token ids under the merge-free (byte alphabet) vocabulary.

    Its symbols lie below the surrogate gap, so a plain character split will do.
    """
    ids = F.transform(F.split(byte_symbols(text), ""), lambda c: F.ascii(c) - _BASE)
    # splitting an empty string gives one empty piece
    return F.when(F.length(text) == 0, F.array().cast("array<int>")).otherwise(ids)


def byte_token_count(text: Column) -> Column:
    """``size(byte_ids(text))`` from lengths alone: a special-token text is one token.

    ``text`` stands in it once, so a filter on the count does not multiply what builds the text.
    """
    for token in SPECIAL_TOKENS:
        text = F.replace(text, F.lit(token), F.lit(" "))
    return F.octet_length(text).cast("int")


def adjacent_pairs(symbols: Column) -> Column:
    """Overlapping two-symbol strings of a word; null below two symbols. Linear."""
    n = F.char_length(symbols) - 1
    chars = symbol_chars(symbols)
    zipped = F.zip_with(F.slice(chars, F.lit(1), n), F.slice(chars, F.lit(2), n), lambda a, b: F.concat(a, b))
    return F.when(n > 0, zipped)


def apply_merges(symbols: Column, merges: list[tuple[int, int, int]]) -> Column:
    """Left-to-right replacement of non-overlapping pairs, in the given order.

    The merges are data of one ``aggregate``, so generated code is the same every round.
    """
    if not merges:
        return symbols
    steps = F.split(F.lit(" ".join("".join(map(symbol, m)) for m in merges)), " ")
    return F.aggregate(
        steps, symbols, lambda s, m: F.replace(s, F.substring(m, 1, 2), F.substring(m, 3, 1))
    )


def pad_right(values: Column, length: Column, fill: int) -> Column:
    return F.concat(values, F.array_repeat(F.lit(fill), length - F.size(values)))


def take_last(values: Column, n: int) -> Column:
    return F.slice(values, F.greatest(F.lit(1), F.size(values) - n + 1), F.lit(n))
