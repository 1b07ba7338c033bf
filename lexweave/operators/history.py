"""Run histories: evaluation steps, running best, resumed runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ordering import running_before


def evaluation_steps(df: DataFrame, interval: int, last_step: str) -> DataFrame:
    """Steps that evaluate: every ``interval``-th and the last one of the run."""
    return df.filter((F.col("step") % interval == 0) | (F.col("step") == F.col(last_step)))


def is_logged(interval: int) -> Column:
    """Whether a step logs: every ``interval``-th and the first."""
    return (F.col("step") % interval == 0) | (F.col("step") == 1)


def log_steps(df: DataFrame, interval: int) -> DataFrame:
    """Steps that log: every ``interval``-th and the first."""
    return df.filter(is_logged(interval))


def running_best(history: DataFrame, run: str = "run_id", initial: str | None = None) -> DataFrame:
    """Add ``best_val_loss`` up to and with each step and ``improved`` (strictly lower).

    ``initial`` names a column with the best loss before the first step, if any.
    """
    rows = running_before(
        history, "step", F.col("val_loss"), "__best", group=(run,), kind="min"
    )
    before = F.col("__best") if initial is None else F.least(F.col("__best"), F.col(initial))
    return (
        rows.withColumn("__before", before)
        .withColumn("best_val_loss", F.least("__before", "val_loss"))
        .withColumn("improved", F.col("__before").isNull() | (F.col("val_loss") < F.col("__before")))
        .drop("__best", "__before")
    )


def resumed_history(earlier: DataFrame, later: DataFrame, run: str = "run_id") -> DataFrame:
    """Earlier history followed by a resumed run's; the later row wins for a repeated step."""
    repeated = later.select(run, "step").distinct()
    kept = earlier.join(repeated, [run, "step"], "left_anti")
    return running_best(kept.unionByName(later), run)
