"""Quality and calibration of predictions.

Everything about classes is derived from one table of (actual, predicted)
counts, which has at most classes-squared rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..functions.ordering import bucket_by_edges, quantile_edges, running_totals
from ..sources.workspace import materialize


def confusion(pred: DataFrame, label: str = "intent_name", predicted: str = "pred") -> DataFrame:
    """Rows per (actual, predicted), in label order; pairs that do not occur are left out."""
    return (
        pred.groupBy(F.col(label).alias("actual"), F.col(predicted).alias("predicted"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("actual", "predicted")
    )


def confusion_matrix(counts: DataFrame, labels: list[str]) -> DataFrame:
    """The counts as a square, one column per label in sorted order, zeros filled in."""
    labels = sorted(labels)
    wide = counts.groupBy("actual").pivot("predicted", labels).agg(F.sum("n"))
    return wide.na.fill(0, labels).orderBy("actual")


def confused_pairs(counts: DataFrame, n: int = 10) -> DataFrame:
    """The most frequent wrong pairs, ties in label order."""
    return (
        counts.filter(F.col("actual") != F.col("predicted"))
        .orderBy(F.desc("n"), "actual", "predicted")
        .limit(n)
    )


def accuracy(counts: DataFrame) -> DataFrame:
    right = F.coalesce(F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n"))), F.lit(0))
    return counts.agg(
        F.sum("n").alias("n"), right.alias("correct"), ratio(right, F.sum("n")).alias("accuracy")
    )


def per_class(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every label seen or predicted; 0 where undefined."""
    nothing = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("actual").alias("label"), F.col("n").alias("support"), nothing.alias("predicted"),
            F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(nothing).alias("tp"),
        ),
        F.struct(
            F.col("predicted").alias("label"), nothing.alias("support"), F.col("n").alias("predicted"),
            nothing.alias("tp"),
        ),
    )
    totals = counts.select(F.inline(sides)).groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("_predicted"), F.sum("tp").alias("_tp")
    )
    zero = F.lit(0.0)
    return totals.select(
        "label",
        F.coalesce(ratio("_tp", "_predicted"), zero).alias("precision"),
        F.coalesce(ratio("_tp", "support"), zero).alias("recall"),
        F.coalesce(ratio(2 * F.col("_tp"), F.col("support") + F.col("_predicted")), zero).alias("f1"),
        "support",
    )


def class_report(counts: DataFrame) -> DataFrame:
    """Per class, then accuracy (in the F1 column), macro and weighted averages."""
    classes = per_class(counts)
    none = F.lit(None).cast("double")
    overall = accuracy(counts).select(
        F.lit("accuracy").alias("label"), none.alias("precision"), none.alias("recall"),
        F.col("accuracy").alias("f1"), F.col("n").alias("support"), F.lit(1).alias("_part"),
    )
    measures = ("precision", "recall", "f1")
    macro = classes.agg(*[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support")).select(
        F.lit("macro avg").alias("label"), *measures, "support", F.lit(2).alias("_part")
    )
    weighted = classes.agg(
        *[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures],
        F.sum("support").alias("support"),
    ).select(F.lit("weighted avg").alias("label"), *measures, "support", F.lit(3).alias("_part"))
    return (
        classes.withColumns({"label": F.col("label").cast("string"), "_part": F.lit(0)})
        .unionByName(overall).unionByName(macro).unionByName(weighted)
        .orderBy("_part", "label")
        .drop("_part")
    )


def f1_summary(counts: DataFrame) -> DataFrame:
    """Macro F1 and the number of classes."""
    return per_class(counts).agg(F.avg("f1").alias("macro_f1"), F.count(F.lit(1)).alias("classes"))


def binary_f1(counts: DataFrame, positive: str | int = 1) -> DataFrame:
    return per_class(counts).filter(F.col("label") == F.lit(positive)).select("f1")


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Chance that a positive scores above a negative, ties counting half.

    Rows are first counted per distinct score. The number of negatives below a
    score is then a running total over the scores, in whole numbers throughout.
    """
    per_score = df.filter(F.col(score).isNotNull()).groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg")
    )
    per_score = materialize(per_score, "scores")
    ranked = running_totals(per_score, score, {"_below": F.col("_neg")})
    wide = "decimal(38,0)"
    twice = F.sum((F.col("_pos").cast("decimal(19,0)") * (2 * F.col("_below") + F.col("_neg")).cast("decimal(19,0)")).cast(wide))
    pairs = 2.0 * F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return ranked.agg(
        F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"), ratio(twice, pairs).alias("auc")
    )


def reliability(df: DataFrame, conf: str = "confidence", correct: str = "correct", bins: int = 10) -> DataFrame:
    """Mean confidence and observed accuracy per quantile bin of the confidence.

    A value on an edge belongs to the lower bin; bins without rows are left out.
    """
    edges = quantile_edges(df, conf, bins)
    return (
        df.groupBy(bucket_by_edges(conf, edges).alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            ratio(F.sum(conf), F.count(F.lit(1))).alias("mean_confidence"),
            ratio(F.sum(F.col(correct).cast("int")), F.count(F.lit(1))).alias("observed_accuracy"),
        )
        .orderBy("bin")
    )


def brier(df: DataFrame, conf: str = "confidence", correct: str = "correct") -> DataFrame:
    """Mean squared distance of the confidence from the outcome."""
    gap = F.col(conf).cast("double") - F.col(correct).cast("int")
    return df.agg(F.avg(gap * gap).alias("brier"))
