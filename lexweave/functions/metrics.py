"""Closed-form metrics and schedules."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from ..constants import WILSON_Z


def perplexity(nll: Column) -> Column:
    return F.exp(nll)  # a double overflow gives Infinity, as wanted


def bits_per_token(nll: Column) -> Column:
    return nll / F.lit(math.log(2.0))


def wilson_bounds(correct: Column, total: Column, z: float = WILSON_Z) -> tuple[Column, Column]:
    """Lower and upper end of the score interval of a proportion."""
    n = total.cast("double")
    p = correct / n
    z2 = F.lit(z * z)
    centre = p + z2 / (2 * n)
    spread = F.lit(z) * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))
    scale = 1 + z2 / n
    return (centre - spread) / scale, (centre + spread) / scale


def learning_rate(
    step: Column, *, peak: float, floor: float, warmup: int, max_steps: int
) -> Column:
    """Linear warm-up, cosine decay to ``floor``, constant from ``max_steps`` on."""
    if not 0 <= floor <= peak or not 0 <= warmup < max_steps:
        raise ValueError("need 0 <= floor <= peak and 0 <= warmup < max_steps")
    span = max(1, max_steps - warmup)
    progress = (step - warmup) / F.lit(float(span))
    cosine = F.lit(floor) + 0.5 * (1 + F.cos(F.lit(math.pi) * progress)) * F.lit(peak - floor)
    rate = F.when(step >= max_steps, F.lit(floor)).otherwise(cosine)
    if warmup:
        rate = F.when(step < warmup, F.lit(peak) * (step + 1) / F.lit(float(warmup))).otherwise(rate)
    return rate


def train_size(total: Column, fraction: float) -> Column:
    """Records of the training side: truncated share, at least one on each side."""
    share = F.floor(total * F.lit(float(fraction))).cast("bigint")
    return F.least(total - 1, F.greatest(F.lit(1).cast("bigint"), share))
