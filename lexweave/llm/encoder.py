"""Token ids of texts with a tokenizers file, as the library gives them for the whole text."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

#: The pre-token pattern of byte-level files and its character classes' letters.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters both libraries class alike (a test compares each of them), and run lengths up to
#: which the quick one is quick.
QUICK = re.compile("[^\u0000-ɏͰ-ͳΆ-ϿЀ-ӿ‐-‧‰-⁞]")
LONGEST_RUN = 1000


@lru_cache(maxsize=4)
def load(path: str):
    """The library's own tokenizer, one thread, whole texts."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def _byte_of_sign() -> dict[str, int]:
    """Byte values of the printable signs that byte-level files write for them."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in shown}
    rest = [b for b in range(256) if b not in set(shown)]
    return signs | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def quick(path: str):
    """The same vocabulary as ranks for the faster library, or None if it does not fit.

    It fits byte-level files with the standard pattern, no normaliser, plain added tokens, and
    merges whose results have ids in the order of the merges.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model, added = spec.get("pre_tokenizer") or {}, spec["model"], spec.get("added_tokens", [])
    fits = (
        spec.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", False)
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
    )
    if not fits:
        return None
    merged = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"]["".join(m)] for m in merged]
    if any(a >= b for a, b in zip(order, order[1:])):
        return None
    import tiktoken

    signs = _byte_of_sign()
    special = {t["content"]: t["id"] for t in added}
    ranks = {
        bytes(signs[c] for c in token): i for token, i in model["vocab"].items() if token not in special
    }
    return tiktoken.Encoding(
        os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
    )


def is_quick(text: str) -> bool:
    """Whether the faster library is known to give the same ids in linear time."""
    if QUICK.search(text):
        return False
    words = text.split()
    longest = max(map(len, words), default=0)
    return longest <= LONGEST_RUN and len(text) - sum(map(len, words)) <= len(words) + LONGEST_RUN


class Encoder:
    """Ids of whole texts, without begin, end or added special tokens."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.quick = quick(path)

    def encode(self, text: str) -> np.ndarray:
        if self.quick is not None and is_quick(text):
            return self.quick.encode_to_numpy(text, allowed_special="all", disallowed_special=())
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)
