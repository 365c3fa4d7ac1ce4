"""Aggregates behind the dashboard pages and the published KPI document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from .accounts import AT_RISK_BELOW


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Rows in ``bins`` equal-width bins from the lowest to the highest value, empty ones too."""
    v = F.col(value).cast("double")
    bounds = df.agg(F.min(v).alias("low"), F.max(v).alias("high")).select(F.struct("low", "high")).scalar()
    low, high = bounds["low"], bounds["high"]
    # A single value gets half a unit of room on both sides.
    room = F.when(low == high, 0.5).otherwise(0.0)
    place = F.floor((v - low + room) * bins / (high - low + 2 * room)).cast("int")
    counts = (
        df.filter(v.isNotNull())
        .groupBy(F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").na.fill(0, ["rows"]).orderBy("bin")


def risk_split(scores: DataFrame, threshold: float = AT_RISK_BELOW) -> DataFrame:
    low = F.count_if(F.col("health_score") < threshold)
    return scores.agg(low.alias("at_risk"), (F.count(F.lit(1)) - low).alias("healthy"))


def monitor_kpis(pool: DataFrame, stats: DataFrame) -> DataFrame:
    """Rows, accuracy and classes of the pool, with the alerts of its batches."""
    alerts = stats.agg(F.struct(F.count_if("alert").alias("alerts"), F.count(F.lit(1)).alias("batches"))).scalar()
    return pool.agg(
        F.count(F.lit(1)).alias("rows"),
        ratio(F.sum(F.col("correct").cast("int")), F.count(F.lit(1))).alias("accuracy"),
        F.count_distinct("intent_name").alias("intents"),
    ).withColumns({"n_alerts": alerts["alerts"], "n_batches": alerts["batches"]})


def accuracy_trend(stats: DataFrame) -> DataFrame:
    """Batch accuracy with the baseline and the alert flag; ``stats`` from `drift.drift_fixed`."""
    return stats.select("batch", "accuracy", "baseline", "alert").orderBy("batch")


def wrong_pairs(pool: DataFrame, n: int = 10) -> DataFrame:
    """The most frequent wrong pairs of the pool with a label."""
    return (
        pool.filter(F.col("correct").cast("int") == 0)
        .groupBy("intent_name", "pred")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "intent_name", "pred")
        .limit(n)
        .withColumn("pair", F.concat_ws(" -> ", "intent_name", "pred"))
    )


def category_share(pool: DataFrame) -> DataFrame:
    """Accuracy by category, lowest first; rows without a category are left out."""
    return (
        pool.filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(ratio(F.sum(F.col("correct").cast("int")), F.count(F.lit(1))).alias("accuracy"))
        .orderBy("accuracy", "category")
    )


def _column_of(df: DataFrame, order: list[Column], value: Column) -> Column:
    """Values of a small table as an array in the given order."""
    keys = [o.alias(f"o{i}") for i, o in enumerate(order)]
    rows = F.array_sort(F.collect_list(F.struct(*keys, value.alias("v"))))
    return df.agg(F.transform(rows, lambda r: r["v"])).scalar()


def kpi_document(scores: DataFrame, pool: DataFrame, stats: DataFrame, pairs: int = 8) -> DataFrame:
    """One row with all headline figures, a map of segments and parallel arrays.

    Every part is an aggregate with a bounded number of rows (segments, batches,
    top pairs).
    """
    low = F.col("health_score") < AT_RISK_BELOW
    segments = scores.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    by_size = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "segment", "n")))
    as_map = F.map_from_entries(F.transform(by_size, lambda r: F.struct(r["segment"], r["n"])))
    top = wrong_pairs(pool, pairs)
    batch = [F.col("batch")]
    rank = [-F.col("count"), F.col("intent_name"), F.col("pred")]
    kpis = monitor_kpis(pool, stats).select(
        F.struct(*[F.col(c) for c in ("rows", "accuracy", "n_alerts", "n_batches")])
    ).scalar()
    return scores.agg(
        F.count(F.lit(1)).alias("total_accounts"),
        F.avg("churned").alias("churn_rate"),
        F.count_if(low).alias("at_risk_accounts"),
        F.coalesce(F.sum(F.when(low, F.col("monetary"))), F.lit(0.0)).alias("value_at_risk"),
    ).withColumns({
        "segments": segments.agg(as_map).scalar(),
        "total_conversations": kpis["rows"],
        "accuracy": kpis["accuracy"],
        "n_alerts": kpis["n_alerts"],
        "n_batches": kpis["n_batches"],
        "batch_labels": _column_of(stats, batch, F.col("batch")),
        "batch_accuracy": _column_of(stats, batch, F.col("accuracy")),
        "batch_alert": _column_of(stats, batch, F.col("alert")),
        "confused_pairs": _column_of(top, rank, F.col("pair")),
        "confused_counts": _column_of(top, rank, F.col("count")),
    })


def kpi_values(document: DataFrame) -> DataFrame:
    """The KPI document as rows ``field``, ``item`` and ``value``; arrays come with their label, flags as 0 and 1."""
    single = ("total_accounts", "churn_rate", "at_risk_accounts", "value_at_risk", "total_conversations", "accuracy", "n_alerts", "n_batches")
    entry = lambda field, item, value: F.struct(
        F.lit(field).alias("field"), item.cast("string").alias("item"), value.cast("double").alias("value")
    )
    lists = [F.array(*[entry(c, F.lit(""), F.col(c)) for c in single])]
    lists.append(F.transform(F.map_entries("segments"), lambda e: entry("segments", e["key"], e["value"])))

    def listed(field: str, labels: str) -> Column:
        zipped = F.arrays_zip(F.col(labels).alias("a"), F.col(field).alias("b"))
        return F.transform(zipped, lambda e: entry(field, e["a"], e["b"].cast("int") if field == "batch_alert" else e["b"]))

    lists += [listed("batch_accuracy", "batch_labels"), listed("batch_alert", "batch_labels"), listed("confused_counts", "confused_pairs")]
    return document.select(F.inline(F.concat(*lists)))
