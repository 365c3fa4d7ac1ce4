"""The five analyses over the relational conversation table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import exact_percent, exact_ratio, flag, ratio


def _right() -> Column:
    return F.sum(flag("is_correct"))


def batch_accuracy(flat: DataFrame, max_drop_pp: float = 5) -> DataFrame:
    """Accuracy and confidence per batch against the mean of all earlier batches.

    The baseline averages the rounded percentages; the first batch has none, so
    its alert is NULL. Works on as many rows as there are batches.
    """
    stats = flat.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"),
        exact_percent(_right(), F.count(F.lit(1)), 1).alias("accuracy_pct"),
        exact_ratio(F.sum("confidence"), F.count("confidence"), 3).alias("avg_confidence"),
    )
    return running_baseline(stats, max_drop_pp)


def running_baseline(stats: DataFrame, max_drop_pp: float = 5, order: str = "batch") -> DataFrame:
    """Add the running baseline and the alert to statistics per ``order``."""
    earlier = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # Percentages have one decimal, so their exact mean is taken in DECIMAL.
    exact = F.col("accuracy_pct").cast("decimal(5,1)")
    fallen = F.col("_sum") - F.col("_count") * exact
    return (
        stats.withColumns({"_sum": F.sum(exact).over(earlier), "_count": F.count(exact).over(earlier)})
        .withColumn("running_baseline", exact_ratio("_sum", "_count", 1))
        .withColumn("drift_alert", F.when(F.col("_count") > 0, fallen > F.lit(str(max_drop_pp)).cast("decimal(9,3)") * F.col("_count")))
        .drop("_sum", "_count")
        .orderBy(order)
    )


def intent_precision(flat: DataFrame, min_predictions: int = 5) -> DataFrame:
    """How often a predicted intent was right, worst first."""
    return (
        flat.groupBy("predicted_intent")
        .agg(F.count(F.lit(1)).alias("predictions"), _right().alias("correct"))
        .filter(F.col("predictions") >= min_predictions)
        .withColumn("precision_pct", exact_percent("correct", "predictions", 1))
        .orderBy("precision_pct", "predicted_intent")
    )


def confusion_pairs(flat: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent wrong (true, predicted) pairs."""
    wrong = ~F.col("is_correct") & (F.col("true_intent") != F.col("predicted_intent"))
    return (
        flat.filter(wrong).groupBy("true_intent", "predicted_intent")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .orderBy(F.desc("occurrences"), "true_intent", "predicted_intent")
        .limit(n)
    )


def category_accuracy(flat: DataFrame) -> DataFrame:
    """Accuracy per category; rank 1 is the worst, by the unrounded share."""
    stats = flat.groupBy("category").agg(F.count(F.lit(1)).alias("n"), _right().alias("_right"))
    share = ratio("_right", "n")
    return stats.select(
        "category", "n", exact_percent("_right", "n", 1).alias("accuracy_pct"),
        F.rank().over(Window.orderBy(share)).alias("worst_rank"),
    ).orderBy("worst_rank", F.asc_nulls_last("category"))


def handoff_failures(flat: DataFrame, low: float = 0.4, high: float = 0.8) -> DataFrame:
    """Right answers held back and wrong answers let through, counted in one pass."""
    low_, high_ = (F.lit(str(x)).cast("decimal(5,4)") for x in (low, high))
    return flat.agg(
        F.count_if((F.col("confidence") < low_) & F.col("is_correct")).alias("under_confident_but_right"),
        F.count_if((F.col("confidence") > high_) & ~F.col("is_correct")).alias("over_confident_but_wrong"),
    )
