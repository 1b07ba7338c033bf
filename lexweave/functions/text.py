"""Text normalisation, pre-tokens and deterministic draws."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import EOS_TOKEN, SPECIAL_TOKENS, WORD_PATTERN

# Unicode white space plus the four information separators Python also strips.
# The look-behind lets the tail match start only at the start of a run, so a long
# inner run of blanks stays linear.
_BLANK = r"[\s\x1c-\x1f]"
_STRIP = rf"(?U)\A{_BLANK}++|(?<!{_BLANK}){_BLANK}++\z"
_SOLID = r"(?U)[^\s\x1c-\x1f]"
_RSTRIP = rf"(?U)(?<!{_BLANK}){_BLANK}++\z"
_SPECIAL = "<(?:" + "|".join(t[1:-1] for t in SPECIAL_TOKENS) + ")>"
_SPECIAL_EDGE = rf"(?={_SPECIAL})|(?<={_SPECIAL})"


def canonical_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _STRIP, "")


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, _RSTRIP, "")


def normalize_text(text: Column) -> Column:
    """Newlines to ``\\n`` and Unicode white space off both ends."""
    return strip(canonical_newlines(text))


def is_blank(text: Column) -> Column:
    """Nothing but white space; stops at the first character that is not."""
    return ~F.rlike(text, F.lit(_SOLID))


def story_chunk(norm: Column) -> Column:
    """A normalised story followed by its end marker, as exported and tokenised."""
    return F.concat(norm, F.lit(f"\n{EOS_TOKEN}\n"))


def line_chunk(text: Column) -> Column:
    """A raw row with canonical newlines, ended by exactly the newline it lacks."""
    line = canonical_newlines(text)
    return F.when(F.endswith(line, F.lit("\n")), line).otherwise(F.concat(line, F.lit("\n")))


def pretokens(text: Column) -> Column:
    """Byte-level pre-tokens of a text without special tokens."""
    return F.regexp_extract_all(text, F.lit("(?U)" + WORD_PATTERN), F.lit(0))


def segments(text: Column) -> Column:
    """Split around special tokens; each special token is a segment of its own."""
    return F.filter(F.split(text, _SPECIAL_EDGE), lambda s: F.length(s) > 0)


def words(text: Column) -> Column:
    """Pre-tokens of every segment, special tokens kept whole."""
    return F.flatten(
        F.transform(
            segments(text),
            lambda s: F.when(s.isin(*SPECIAL_TOKENS), F.array(s)).otherwise(pretokens(s)),
        )
    )


def line_pieces(text: Column) -> Column:
    """Lines with their newline kept, the grain file-based vocabulary learning sees."""
    return F.regexp_extract_all(text, F.lit(r"[^\n]*\n|[^\n]+"), F.lit(0))


def hex_to_long(text: Column, digits: int) -> Column:
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("bigint")


def uniform_draw(seed: Column, item: Column) -> Column:
    """Number in [0, 1) fixed by (seed, item) alone."""
    return hex_to_long(F.md5(F.concat_ws(":", seed, item)), 8) / F.lit(4294967296.0)


def seeded_key(seed: int, item: Column) -> Column:
    """60-bit shuffle key fixed by (seed, item) alone."""
    return hex_to_long(F.sha2(F.concat(F.lit(f"{seed}:"), item.cast("string")), 256), 15)


def code_fence(text: Column) -> Column:
    """Fence a text with more backticks than its longest run, three at least."""
    runs = F.transform(F.regexp_extract_all(text, F.lit("(`+)"), F.lit(1)), F.length)
    size = F.greatest(F.lit(3), F.coalesce(F.array_max(runs), F.lit(0)) + 1)
    fence = F.repeat(F.lit("`"), size)
    return F.concat(fence, F.lit("text\n"), text, F.lit("\n"), fence)
