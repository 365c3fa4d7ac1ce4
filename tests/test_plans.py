"""What the plans must and must not contain, and the same results at cluster-size cells."""

from __future__ import annotations

import re

import oracle
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from ledgerpulse.functions import ordering
from ledgerpulse.operators import accounts, commerce, evaluation
from ledgerpulse.sources import testdata as data

LAZY = [
    "nq_a1_monthly_activity", "nq_a2_cohort_retention", "nq_a5_top_products", "nq_a6_monthly_demand",
    "nq_a7_country_revenue", "nq_a8_revenue_drops", "nq_a9_high_value_customers", "d_customer_dimension",
    "d_product_dimension", "nq_b2_intent_precision", "nq_b3_confusion_pairs", "ev_brier",
]
# Queries that need a global order somewhere.
ORDERED = [
    "nq_a3_rfm_top", "ch_rfm_scores", "w_ntile_accounts", "w_account_ranks", "ml_churn_split", "ev_recency_auc",
    "nq_b1_batch_accuracy", "d_shaped_documents", "ev_reliability", "ev_reliability_values", "ev_confidence_auc",
    "dr_batch_sizes", "dr_resampled", "dr_shuffled_batches", "ml_intent_split",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join(spark, tables, name):
    text = plan(contract.queries()[name](spark, tables))
    assert not re.search(r"Python|MapInPandas|MapInArrow|CartesianProduct|BroadcastNestedLoopJoin", text)


@pytest.mark.parametrize("name", LAZY)
def test_single_task_only_after_an_aggregate(spark, tables, name):
    lines = plan(contract.queries()[name](spark, tables)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            depth = len(re.match(r"^[\s:+\-]*", line).group(0))
            below = [x for x in lines[i + 1 :] if len(re.match(r"^[\s:+\-]*", x).group(0)) > depth]
            assert any("Aggregate" in x or "TakeOrdered" in x for x in below), line


def test_columns_and_filters_reach_the_scan(spark, tables):
    text = plan(commerce.cohort_retention(data.transactions(spark, tables, "customer_id", "invoice_date", "is_cancellation")))
    assert "Not(EqualTo(l_returnflag,R))" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text


def test_joins_follow_the_columns(spark, tables):
    text = plan(data.transactions(spark, tables, "quantity", "is_cancellation"))
    assert "Join" not in text


def test_lines_are_scanned_once(spark, tables):
    """The second use of the same sums reuses their exchange."""
    for name in ("nq_a6_monthly_demand", "nq_a9_high_value_customers"):
        df = contract.queries()[name](spark, tables)
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
        assert "ReusedExchange" in final


def test_without_broadcast_joins(spark, tables):
    """Results do not rest on any table being small."""
    con = oracle.connect(tables)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("nq_a5_top_products", "nq_a7_country_revenue", "d_product_dimension", "d_orphan_lines"):
            df = contract.queries()[name](spark, tables)
            assert "SortMergeJoin" in plan(df)
            assert oracle.compare(df, con, contract.oracle_sql()[name]) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ORDERED)
def test_same_rows_with_small_brackets(spark, tables, name, monkeypatch):
    """The result does not depend on how often the brackets of a rank are cut."""
    monkeypatch.setattr(ordering, "HELD", 5)
    monkeypatch.setattr(ordering, "GRID", 8)
    df = contract.queries()[name](spark, tables)
    assert oracle.compare(df, oracle.connect(tables), contract.oracle_sql()[name]) == []


def test_session_time_zone_does_not_matter(spark, tables):
    con = oracle.connect(tables)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("nq_b1_batch_accuracy", "dr_batch_sizes", "d_shaped_documents", "nq_a4_churn_status", "st_event_windows"):
            assert oracle.compare(contract.queries()[name](spark, tables), con, contract.oracle_sql()[name]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_rank_has_no_single_task(spark, tables):
    """Rows are numbered by where they are stored; the only window adds up one row per range."""
    ranked = ordering.global_rank(data.table(spark, tables, "events"), "ts", "event_id")
    windows = re.findall(r"Window \[(.*)", plan(ranked))
    assert windows and all("_before" in w and "_range" in w for w in windows)


def test_no_cross_join_in_the_area_under_the_curve(spark, tables):
    df = contract.queries()["ev_confidence_auc"](spark, tables)
    df.collect()
    assert "BroadcastNestedLoopJoin" not in plan(df) and "Cartesian" not in plan(df)


def test_hot_keys(spark):
    """One customer and one product with a third of all lines change nothing but counts."""
    lines = spark.range(3000).select(
        F.concat(F.lit("i"), (F.col("id") % 500).cast("string")).alias("invoice"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("stock_code"),
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 50 + 2)).cast("int").alias("customer_id"),
        F.lit("UK").alias("country"),
        F.lit("2010-01-01 00:00:00").cast("timestamp_ntz").alias("invoice_date"),
        F.lit(1).alias("quantity"), F.lit("2.500").cast("decimal(10,3)").alias("price"),
        F.lit(False).alias("is_cancellation"),
    )
    rows = {r["customer_id"]: r for r in accounts.customer_activity(lines).collect()}
    assert (rows[1]["frequency"], float(rows[1]["monetary_exact"])) == (500, 2500.0)
    assert sum(float(r["monetary_exact"]) for r in rows.values()) == 7500.0
    scores = lines.select(F.lit(0.5).alias("s"), (F.col("quantity") * 0).alias("y")).unionByName(
        spark.range(10).select((F.col("id") / 10).alias("s"), F.lit(1).alias("y"))
    )
    assert evaluation.roc_auc(scores, "s", "y").first()["auc"] == pytest.approx(0.45)
