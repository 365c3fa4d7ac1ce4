"""Account features, RFM scores, segments, health score and worklist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import whole_days
from ..functions.numeric import ratio, round_half_even, round_half_up
from ..functions.ordering import bucket_by_cuts, bucket_by_edges, edge_order, edges_between, quantile_order, rows_at_ranks
from .commerce import amount

CUTOFF_DAYS = 90
AT_RISK_BELOW = 30
SCORE_COLUMNS = (
    "customer_id", "recency_days", "frequency", "monetary", "avg_order_value", "tenure_days", "churned", "segment",
    "rfm_score", "churn_probability", "health_score",
)


def customer_activity(tx: DataFrame) -> DataFrame:
    """One row per customer id, guests as one NULL row, from a single pass over the lines.

    ``last_seen`` covers invoices of any kind; the other columns only count
    sales. Guests get no invoice numbers, which keeps the distinct count from
    shuffling them.
    """
    sale = ~F.col("is_cancellation")
    known = F.col("customer_id").isNotNull()
    return tx.groupBy("customer_id").agg(
        F.min(F.when(sale, F.col("invoice_date"))).alias("first_order"),
        F.max(F.when(sale, F.col("invoice_date"))).alias("last_order"),
        F.count_distinct(F.when(sale & known, F.col("invoice"))).alias("frequency"),
        F.sum(F.when(sale, amount())).alias("monetary_exact"),
        F.max("invoice_date").alias("last_seen"),
    )


def account_features(activity: DataFrame, end: Column | None = None) -> DataFrame:
    """Customers with at least one sale, measured against the end of the data.

    The end is the latest invoice of any kind, guests and credit notes included; it is looked up unless it is given.
    """
    end = activity.agg(F.max("last_seen")).scalar() if end is None else end
    out = (
        activity.withColumn("max_date", end)
        .filter(F.col("customer_id").isNotNull() & F.col("last_order").isNotNull())
    )

    def days(later: str, earlier: str) -> Column:
        return whole_days(F.col(later), F.col(earlier)).cast("double")

    return out.select(
        "customer_id", "first_order", "last_order", "frequency", "monetary_exact",
        F.col("monetary_exact").cast("double").alias("monetary"), "max_date",
        days("max_date", "last_order").alias("recency_days"),
        days("last_order", "first_order").alias("tenure_days"),
        days("max_date", "first_order").alias("observed_days"),
    )


def churn_label(features: DataFrame, cutoff_days: int = CUTOFF_DAYS) -> DataFrame:
    """Add the mean order value and ``churned``: more than ``cutoff_days`` whole days silent."""
    return features.withColumn("avg_order_value", ratio("monetary", "frequency")).withColumn(
        "churned", (F.col("recency_days") > cutoff_days).cast("int")
    )


def segment_expr(r: Column, f: Column) -> Column:
    """Segment of a recency and a frequency score; the first rule that holds wins. Labels and limits are fixed values."""
    return (
        F.when((r >= 4) & (f >= 3), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal")
        .when((r <= 2) & (f >= 3), "At Risk (was loyal)")
        .when((r <= 2) & (f <= 2), "Lost")
        .otherwise("New / Occasional")
    )


def rfm_scores(features: DataFrame) -> DataFrame:
    """Add r, f, m scores 1..4, their sum and the segment. ``features`` should be stored.

    Recency is cut at its value quartiles (fewer days, higher score); frequency
    and money at the quartiles of their rank, ties in customer order. Should two
    recency quartiles coincide, the higher score wins.
    """
    ranked = ("frequency", "monetary_exact")
    recency, frequency, money = rows_at_ranks(
        features, [edge_order("recency_days", 4), *[quantile_order(c, "customer_id", 4) for c in ranked]]
    )
    out = features.withColumns({
        "r_score": 5 - bucket_by_edges("recency_days", edges_between(recency, 4)),
        "f_score": bucket_by_cuts("frequency", "customer_id", frequency),
        "m_score": bucket_by_cuts("monetary_exact", "customer_id", money),
    })
    return out.withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score")).withColumn(
        "segment", segment_expr(F.col("r_score"), F.col("f_score"))
    )


def segment_counts(scores: DataFrame) -> DataFrame:
    """Accounts per segment, largest first."""
    return (
        scores.groupBy("segment").agg(F.count(F.lit(1)).alias("accounts")).orderBy(F.desc("accounts"), "segment")
    )


def health_scores(scores: DataFrame, prob_col: str = "churn_probability") -> DataFrame:
    """Add ``health_score`` 0..100: half model, half RFM score."""
    rfm = (F.col("rfm_score") - 3) / F.lit(9.0) * 100
    model = (1 - F.col(prob_col)) * 100
    return scores.withColumn("health_score", round_half_even(0.5 * model + 0.5 * rfm, 1))


def account_scores(scores: DataFrame) -> DataFrame:
    """The published column set."""
    return scores.select(*SCORE_COLUMNS)


def at_risk(scores: DataFrame, threshold: float = AT_RISK_BELOW) -> DataFrame:
    return scores.filter(F.col("health_score") < threshold)


def worklist(scores: DataFrame, threshold: float = AT_RISK_BELOW, n: int = 25) -> DataFrame:
    """The ``n`` accounts at risk with the lowest health."""
    columns = ("customer_id", "health_score", "churn_probability", "segment", "recency_days", "frequency", "monetary")
    return at_risk(scores, threshold).select(*columns).orderBy("health_score", "customer_id").limit(n)


def segment_summary(scores: DataFrame) -> DataFrame:
    """Accounts, mean health, mean churn probability and total value per segment, by name."""
    return (
        scores.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("accounts"),
            round_half_up(F.avg("health_score"), 1).alias("avg_health_score"),
            round_half_up(F.avg("churn_probability"), 3).alias("avg_churn_probability"),
            round_half_up(F.sum("monetary"), 2).alias("total_monetary"),
        )
        .orderBy("segment")
    )


def account_kpis(scores: DataFrame, threshold: float = AT_RISK_BELOW) -> DataFrame:
    """Accounts, churn rate, accounts at risk and their value, in one pass."""
    low = F.col("health_score") < threshold
    return scores.agg(
        F.count(F.lit(1)).alias("accounts"),
        F.avg("churned").alias("churn_rate"),
        F.count_if(low).alias("at_risk_accounts"),
        round_half_up(F.coalesce(F.sum(F.when(low, F.col("monetary"))), F.lit(0.0)), 2).alias("value_at_risk"),
    )
