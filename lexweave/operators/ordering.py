"""Running values and ranks in a declared order, without a one-task window.

Rows fall in order-preserving buckets (the order key shifted right). A window runs
inside each bucket only; bucket totals get their own running value, level by level.
Buckets come from the key's bits, so every window is bounded for dense, sparse and
hashed keys alike: at most 2**12 keys in the first level and 2**18 buckets above. A hot
group is cut by the same buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Shifts for keys of any kind, and for evenly spread 60-bit hashed keys.
ID_SHIFTS = (12, 28, 46)
HASH_SHIFTS = (36, 48)

_KINDS = {
    "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


def running_values(
    df: DataFrame,
    key: str,
    values: dict[str, Column],
    *,
    group: tuple[str, ...] = (),
    kind: str = "sum",
    shifts: tuple[int, ...] = ID_SHIFTS,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """Add each named column: the aggregate of its value over all rows before this one.

    Order is ``key`` (bigint), then ``ties``; the two must be unique inside a group.
    Key and group columns must not be null. A first row gets 0 for sums and null for
    min/max.
    """
    aggregate, combine = _KINDS[kind]
    levels = [f"__b{i}" for i in range(len(shifts))]
    buckets = [F.shiftright(F.col(key), s).alias(n) for s, n in zip(shifts, levels)]
    parts = [f"__v{i}" for i in range(len(values))]
    offsets = [f"__p{i}" for i in range(len(values))]
    rows = df.select("*", *[v.alias(n) for v, n in zip(values.values(), parts)], *buckets)

    def total(table: DataFrame, names: list[str]) -> DataFrame:
        return table.groupBy(*group, *names).agg(*[aggregate(p).alias(p) for p in parts])

    def before(table: DataFrame, outer: list[str], order: list[str]) -> DataFrame:
        frame = (
            Window.partitionBy(*group, *outer)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return table.withColumns({p: aggregate(p).over(frame) for p in parts})

    def shifted(table: DataFrame, above: DataFrame, names: list[str]) -> DataFrame:
        # the left side is already partitioned by these keys for its window and stays put
        joined = table.join(above, [*group, *names], "left")
        return joined.withColumns({p: combine(F.col(p), F.col(o)) for p, o in zip(parts, offsets)}).drop(*offsets)

    totals = [total(rows, levels)]
    for depth in range(1, len(levels)):
        totals.append(total(totals[-1], levels[depth:]))
    above = None
    for depth in range(len(levels) - 1, -1, -1):
        outer = levels[depth + 1 :]
        level = before(totals[depth], outer, [levels[depth]])
        if above is not None:
            level = shifted(level, above, outer)
        above = level.withColumnsRenamed(dict(zip(parts, offsets)))
    placed = shifted(before(rows, levels, [key, *ties]), above, levels).drop(*levels)
    return placed.withColumns({n: F.col(p) for n, p in zip(values, parts)}).drop(*parts)


def running_before(df: DataFrame, key: str, value: Column, out: str, **options) -> DataFrame:
    """:func:`running_values` of one value."""
    return running_values(df, key, {out: value}, **options)


def rank_before(df: DataFrame, key: str, out: str, **options) -> DataFrame:
    """Zero-based exact rank in order of ``key``."""
    ranked = running_before(df, key, F.lit(1).cast("bigint"), out, **options)
    return ranked.withColumn(out, F.col(out).cast("bigint"))


def first_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """The ``n`` rows with the smallest keys (bigint, unique, not null), in order.

    Only keys are ranked, in buckets; whole rows are filtered by the last key taken, so
    no task has to hold ``n`` of them.
    """
    last = rank_before(df.select(key), key, "__rank").filter(F.col("__rank") == n - 1)
    bound = last.agg(F.max(key)).scalar()
    return df.filter(F.coalesce(F.col(key) <= bound, F.lit(True))).orderBy(key)
