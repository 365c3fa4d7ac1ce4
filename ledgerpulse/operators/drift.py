"""Batches by arrival, their statistics and the alert rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..functions.ordering import equal_freq

BATCHES = 10
BASELINE_BATCHES = 6
MAX_DROP = 0.05
HARDEST = 4


def batch_assign(df: DataFrame, order_by: str, key: str, k: int = BATCHES) -> DataFrame:
    """Add ``batch`` 0..k-1: equal shares of the rows in arrival order."""
    return equal_freq(df, order_by, key, k, "_bucket").withColumn("batch", F.col("_bucket") - 1).drop("_bucket")


def hardest_classes(classes: DataFrame, k: int = HARDEST) -> DataFrame:
    """The ``k`` classes with the lowest F1, ties in label order."""
    return classes.orderBy("f1", "label").limit(k).select("label", "f1")


def hardest_labels(classes: DataFrame, k: int = HARDEST) -> list[str]:
    return [r["label"] for r in hardest_classes(classes, k).collect()]


def batch_stats(df: DataFrame, hard: Sequence[str], label: str = "intent_name") -> DataFrame:
    """Rows, accuracy, mean confidence and share of hard classes per batch."""
    rows = F.count("correct")
    return df.groupBy("batch").agg(
        rows.alias("n"),
        ratio(F.sum(F.col("correct").cast("int")), rows).alias("accuracy"),
        ratio(F.sum("confidence"), F.count("confidence")).alias("avg_confidence"),
        ratio(F.count_if(F.col(label).isin(list(hard))), F.count(F.lit(1))).alias("hard_intent_share"),
    )


def drift_fixed(stats: DataFrame, baseline_batches: int = BASELINE_BATCHES, max_drop: float = MAX_DROP) -> DataFrame:
    """Add ``baseline`` (unweighted mean accuracy of the first batches) and ``alert``."""
    baseline = stats.filter(F.col("batch") < baseline_batches).agg(F.avg("accuracy")).scalar()
    return (
        stats.withColumn("baseline", baseline)
        .withColumn("alert", (F.col("baseline") - F.col("accuracy")) > max_drop)
        .orderBy("batch")
    )


def alert_summary(stats: DataFrame) -> DataFrame:
    return stats.agg(F.count_if("alert").alias("n_alerts"), F.count(F.lit(1)).alias("n_batches"))
