"""All registered queries and the SQL they are checked against."""

from __future__ import annotations

from . import (
    choice_queries,
    eval_queries,
    instruct_queries,
    sampling_queries,
    text_queries,
    token_queries,
)

_MODULES = (
    text_queries,
    token_queries,
    instruct_queries,
    eval_queries,
    choice_queries,
    sampling_queries,
)


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: s for m in _MODULES for name, s in m.ORACLES.items()}
