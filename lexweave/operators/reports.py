"""Result analyses over prediction tables and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import CHANCE, CHOICE_LABELS
from ..functions.metrics import wilson_bounds


def label_distribution(preds: DataFrame) -> DataFrame:
    """Predicted and gold label counts with shares, one row per label."""
    def counts(column: str, name: str) -> DataFrame:
        return preds.groupBy(F.col(column).alias("label")).agg(F.count("*").alias(name))

    total = preds.agg(F.count("*")).scalar()
    both = counts("predicted_label", "predicted").join(
        counts("gold_label", "gold"), "label", "full_outer"
    )
    spine = preds.sparkSession.createDataFrame([(l,) for l in CHOICE_LABELS], "label STRING")
    rows = spine.join(both, "label", "full_outer").fillna(0, ["predicted", "gold"])
    return rows.withColumns(
        {
            "predicted_share": F.col("predicted") / total,
            "gold_share": F.col("gold") / total,
        }
    )


def wilson_report(summary: DataFrame) -> DataFrame:
    """Add the 95% interval and the gap to chance to ``total, correct`` rows."""
    low, high = wilson_bounds(F.col("correct"), F.col("total"))
    return summary.withColumns(
        {
            "wilson_low": low,
            "wilson_high": high,
            "gap_to_chance": F.col("correct") / F.col("total") - F.lit(CHANCE),
        }
    )


def label_mean_scores(preds: DataFrame) -> DataFrame:
    """Mean log-likelihood per answer label."""
    scores = preds.select(F.explode("choice_log_likelihoods").alias("label", "score"))
    return scores.groupBy("label").agg(F.avg("score").alias("mean_log_likelihood"))


def subject_extremes(subjects: DataFrame, k: int) -> DataFrame:
    """Best and worst ``k`` subjects by accuracy; ties by name."""
    best = subjects.orderBy(F.desc("accuracy"), "subject").limit(k)
    worst = subjects.orderBy("accuracy", "subject").limit(k)
    return best.withColumn("side", F.lit("best")).unionByName(
        worst.withColumn("side", F.lit("worst"))
    )


def compare_runs(a: DataFrame, b: DataFrame, key: str, metric: str, targets: str) -> DataFrame:
    """Difference and relative change of a metric, and whether both counted the same targets.

    Keys of one run only stay, with nulls for the other; ``held_by`` is both, a or b.
    """
    left = a.select(key, F.col(metric).alias("value_a"), F.col(targets).alias("targets_a"), F.lit(True).alias("in_a"))
    right = b.select(key, F.col(metric).alias("value_b"), F.col(targets).alias("targets_b"), F.lit(True).alias("in_b"))
    holder = F.when(F.col("in_b").isNull(), "a").when(F.col("in_a").isNull(), "b").otherwise("both")
    return left.join(right, key, "full").select(
        key,
        "value_a",
        "value_b",
        (F.col("value_b") - F.col("value_a")).alias("difference"),
        F.try_divide(F.col("value_b") - F.col("value_a"), F.col("value_a")).alias("relative_change"),
        (F.col("targets_a") == F.col("targets_b")).alias("same_targets"),
        holder.alias("held_by"),
    )


def run_agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """Equal predicted labels and largest score difference of two scorings.

    ``n_items`` are in both; ``only_a`` and ``only_b`` in one.
    """
    left = a.select("index", "predicted_label", "choice_log_likelihoods", F.lit(True).alias("in_a"))
    right = b.select(
        "index",
        F.col("predicted_label").alias("label_b"),
        F.col("choice_log_likelihoods").alias("scores_b"),
        F.lit(True).alias("in_b"),
    )
    both = left.join(right, "index", "full")
    gaps = F.transform(
        F.map_keys("choice_log_likelihoods"),
        lambda l: F.abs(F.element_at("choice_log_likelihoods", l) - F.element_at("scores_b", l)),
    )
    return both.agg(
        F.count_if(F.col("in_a") & F.col("in_b")).alias("n_items"),
        F.count_if(F.col("in_b").isNull()).alias("only_a"),
        F.count_if(F.col("in_a").isNull()).alias("only_b"),
        F.count_if(F.col("predicted_label") == F.col("label_b")).alias("same_labels"),
        F.max(F.array_max(gaps)).alias("max_score_difference"),
    )


def prediction_integrity(preds: DataFrame) -> DataFrame:
    """Indices are exactly 0..n-1, and correctness recomputed from the rows matches."""
    recomputed = F.col("predicted") == F.col("gold")
    # n rows with minimum 0, maximum n-1 and as many distinct values are exactly 0..n-1
    facts = preds.groupBy("index").agg(
        F.count("*").alias("n"),
        F.count_if("correct").alias("stored"),
        F.count_if(recomputed).alias("recomputed"),
    ).agg(
        F.sum("n").alias("total"),
        F.count("*").alias("distinct_indices"),
        F.min("index").alias("min_index"),
        F.max("index").alias("max_index"),
        F.sum("stored").alias("correct_stored"),
        F.sum("recomputed").alias("correct_recomputed"),
    )
    return facts.withColumn(
        "sequential",
        (F.col("total") == F.col("distinct_indices"))
        & (F.col("min_index") == 0)
        & (F.col("max_index") == F.col("total") - 1),
    )
