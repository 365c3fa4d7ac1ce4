"""Published figures, worked examples and edge rows."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerpulse.functions import bitmaps, dates, numeric
from ledgerpulse.functions.numeric import round_half_even, round_half_up
from ledgerpulse.operators import accounts, commerce, dashboards, drift, evaluation, ingest, intents, quality, retention
from ledgerpulse.operators.sampling import train_sizes
from ledgerpulse.sources import schemas

# Rows, right answers, mean confidence and alert of the ten published batches (fixed values).
PUBLISHED = [
    (0, 54, 48), (1, 54, 47), (2, 54, 51), (3, 53, 47), (4, 54, 51), (5, 54, 51), (6, 83, 74), (7, 84, 75), (8, 84, 74),
    (9, 84, 71),
]


@pytest.fixture(scope="module")
def published(spark):
    return spark.createDataFrame(PUBLISHED, "batch int, n long, right long").withColumn(
        "accuracy", F.col("right") / F.col("n")
    )


def test_fixed_baseline_flags_the_last_batch_only(published):
    rows = drift.drift_fixed(published).collect()
    assert rows[0]["baseline"] == pytest.approx(0.9132308, abs=1e-7)
    assert [r["alert"] for r in rows] == [False] * 9 + [True]
    assert tuple(drift.alert_summary(drift.drift_fixed(published)).first()) == (1, 10)


def test_running_baseline_flags_the_last_batch_only(published):
    stats = published.withColumn("accuracy_pct", round_half_up(F.col("accuracy") * 100, 1))
    rows = intents.running_baseline(stats).collect()
    assert [r["running_baseline"] for r in rows] == [None, 88.9, 88.0, 90.1, 89.8, 90.7, 91.3, 91.0, 90.8, 90.5]
    assert [r["drift_alert"] for r in rows] == [None] + [False] * 8 + [True]


def test_pool_accuracy(published):
    total = published.agg(F.sum("right"), F.sum("n")).first()
    assert tuple(total) == (589, 658)
    assert total[0] / total[1] == pytest.approx(0.8951367781155015, abs=1e-15)


def test_whatif(spark):
    share = 579035.071 / 1883
    scores = spark.range(1883 + 50).select(
        F.when(F.col("id") < 1883, 10.0).otherwise(30.0).alias("health_score"), F.lit(share).alias("monetary")
    )
    row = retention.retention_whatif(scores).first()
    assert row["at_risk_accounts"] == 1883 and row["accounts_saved"] == 471
    assert row["revenue_retained"] == pytest.approx(144835.64, abs=0.01)
    assert row["total_cost"] == 28245.0 and row["net_impact"] == pytest.approx(116590.64, abs=0.01)


def test_whatif_without_accounts_at_risk(spark):
    scores = spark.createDataFrame([(50.0, 1.0)], "health_score double, monetary double")
    row = retention.retention_whatif(scores).first()
    assert (row["accounts_saved"], row["net_impact"]) == (0, 0.0)


def tx(spark, rows):
    filled = [
        (invoice, code, customer, country, when, quantity, Decimal(price), invoice.startswith("C"))
        for invoice, code, customer, country, when, quantity, price in rows
    ]
    return spark.createDataFrame(filled, schemas.TRANSACTIONS)


def test_churn_boundary(spark):
    end = datetime(2011, 12, 9, 12, 50)
    lines = tx(spark, [
        ("1", "a", 1, "UK", end - timedelta(days=90, minutes=50), 1, "1"),
        ("2", "a", 2, "UK", end - timedelta(days=91), 1, "1"),
        ("3", "a", None, "UK", end, 1, "1"),
    ])
    activity = accounts.customer_activity(lines)
    status = {r["status"]: r["customers"] for r in commerce.churn_status(activity).collect()}
    assert status == {"churned": 2}
    whole = {r["customer_id"]: r for r in accounts.churn_label(accounts.account_features(activity)).collect()}
    assert set(whole) == {1, 2}
    assert (whole[1]["recency_days"], whole[1]["churned"]) == (90.0, 0)
    assert (whole[2]["recency_days"], whole[2]["churned"]) == (91.0, 1)


def test_month_with_credit_notes_only(spark):
    lines = tx(spark, [
        ("1", "a", 1, "UK", datetime(2010, 1, 5), 2, "3.500"),
        ("C2", "a", 1, "UK", datetime(2010, 2, 5), -2, "3.500"),
        ("3", "a", 2, "UK", datetime(2010, 3, 5), 1, "9.000"),
        ("4", "a", None, "UK", datetime(2010, 3, 6), 1, "100.000"),
    ])
    rows = commerce.monthly_activity(lines).collect()
    assert [(r["active_customers"], r["revenue"], r["revenue_mom_change_pct"]) for r in rows] == [
        (1, 7.0, None), (1, None, None), (1, 9.0, None)
    ]


def test_equal_revenues_share_the_running_total(spark):
    day = datetime(2010, 1, 5)
    lines = tx(spark, [("1", c, 1, "UK", day, 1, p) for c, p in (("b", "5"), ("a", "5"), ("c", "1"), ("d", "1"))])
    products = spark.createDataFrame([(c, c.upper()) for c in "abcd"], schemas.PRODUCTS)
    rows = commerce.top_products(lines, products, n=3).collect()
    assert [(r["stock_code"], r["cumulative_pct"]) for r in rows] == [("a", 83.33), ("b", 83.33), ("c", 100.0)]


def test_countries_rank_ties_alike(spark):
    day = datetime(2010, 1, 5)
    lines = tx(spark, [("1", "a", n, c, day, 1, p) for n, (c, p) in enumerate((("B", "5"), ("A", "5"), ("C", "1")))])
    rows = commerce.country_revenue(lines).collect()
    assert [(r["country"], r["revenue_rank"]) for r in rows] == [("A", 1), ("B", 1), ("C", 3)]


def test_cohort_counts_each_customer_once_per_month(spark):
    lines = tx(spark, [
        ("1", "a", 1, "UK", datetime(2009, 12, 1), 1, "1"), ("2", "a", 1, "UK", datetime(2009, 12, 9), 1, "1"),
        ("3", "a", 2, "UK", datetime(2009, 12, 31), 1, "1"), ("4", "a", 2, "UK", datetime(2010, 1, 1), 1, "1"),
        ("5", "a", 2, "UK", datetime(2010, 9, 1), 1, "1"), ("C6", "a", 3, "UK", datetime(2009, 12, 1), 1, "1"),
    ])
    rows = [tuple(r)[1:] for r in commerce.cohort_retention(lines).collect()]
    assert rows == [(0, 2, 2, 100.0), (1, 1, 2, 50.0)]


def test_most_frequent_value_takes_the_lowest_on_a_tie(spark):
    rows = [("k", v) for v in "babac"] + [("none", None), ("none", None), ("rare", None), ("rare", "x")]
    out = ingest.most_frequent(spark.createDataFrame(rows, "k string, v string"), "k", "v")
    assert {r["k"]: r["v"] for r in out.collect()} == {"k": "a", "none": None, "rare": "x"}


def test_bad_customer_ids_become_null(spark):
    texts = ["12345.0", "17", " 8 ", "", "n/a", "1.5", "NaN", "inf", "1e12", None]
    out = spark.createDataFrame([(t,) for t in texts], "t string").select(ingest.whole_number("t")).collect()
    assert [r[0] for r in out] == [12345, 17, 8] + [None] * 7


def test_cancellation_prefix_is_case_sensitive(spark):
    df = spark.createDataFrame([("C1",), ("c1",), ("1C",)], "invoice string")
    assert [r[0] for r in df.select(ingest.is_cancellation("invoice")).collect()] == [True, False, False]


def test_strip_takes_any_white_space(spark):
    df = spark.createDataFrame([("\t\n a b  \r",)], "d string")
    assert df.select(ingest.strip("d")).first()[0] == "a b"


def test_category_lookup(spark):
    assert len(ingest.INTENT_CATEGORIES) == 20 and len(set(ingest.INTENT_CATEGORIES.values())) == 6
    df = ingest.with_category(spark.createDataFrame([("oos",), ("who",)], "intent_name string"), "intent_name")
    assert [r["category"] for r in df.collect()] == ["out_of_scope", None]


@pytest.mark.parametrize("r", range(1, 5))
@pytest.mark.parametrize("f", range(1, 5))
def test_segment_rules(spark, r, f):
    want = {
        (True, True): "Champions" if r == 4 else "Loyal", (True, False): "New / Occasional",
        (False, True): "At Risk (was loyal)", (False, False): "Lost",
    }[(r >= 3, f >= 3)]
    assert spark.range(1).select(accounts.segment_expr(F.lit(r), F.lit(f))).first()[0] == want


def test_split_sizes_of_the_published_report():
    assert train_sizes({0: 2894, 1: 2987}, 0.2) == {0: 2894 - 579, 1: 2987 - 598}


def test_rounding_modes(spark):
    row = spark.range(1).select(
        round_half_up(F.lit(11.25), 1), round_half_even(F.lit(11.25), 1), round_half_up(F.lit(-0.5), 0),
        round_half_even(F.lit(0.5), 0),
    ).first()
    assert tuple(row) == (11.3, 11.2, -1.0, 0.0)


def test_class_never_predicted_scores_zero(spark):
    pred = spark.createDataFrame([("a", "a"), ("a", "a"), ("b", "a")], "intent_name string, pred string")
    counts = evaluation.confusion(pred)
    rows = {r["label"]: r for r in evaluation.class_report(counts).collect()}
    assert (rows["b"]["precision"], rows["b"]["recall"], rows["b"]["f1"], rows["b"]["support"]) == (0, 0, 0, 1)
    assert rows["macro avg"]["f1"] == pytest.approx(0.4) and rows["accuracy"]["f1"] == pytest.approx(2 / 3)
    assert [r["label"] for r in drift.hardest_classes(evaluation.per_class(counts), 1).collect()] == ["b"]


def test_auc_ties_and_monotone_transform(spark):
    rows = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)], "s double, y int")
    assert evaluation.roc_auc(rows, "s", "y").first()["auc"] == pytest.approx(0.875)
    cubed = rows.withColumn("s", F.pow("s", 3))
    assert evaluation.roc_auc(cubed, "s", "y").first()["auc"] == pytest.approx(0.875)


def test_confidence_on_an_edge_goes_down(spark):
    rows = spark.createDataFrame([(c, 1) for c in (0.1, 0.2, 0.2, 0.2, 0.9)], "confidence double, correct int")
    out = evaluation.reliability(rows, bins=2).collect()
    assert [(r["bin"], r["n"]) for r in out] == [(1, 4), (2, 1)]


def test_histogram_of_one_value(spark):
    rows = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    out = dashboards.histogram(rows, "v", 3).collect()
    assert [r["rows"] for r in out] == [0, 2, 0]


def test_unknown_category_is_ranked_but_not_charted(spark):
    flat = spark.createDataFrame([("x", True), (None, False)], "category string, is_correct boolean")
    assert [(r["category"], r["worst_rank"]) for r in intents.category_accuracy(flat).collect()] == [(None, 1), ("x", 2)]
    pool = flat.withColumn("correct", F.col("is_correct").cast("int"))
    assert [r["category"] for r in dashboards.category_share(pool).collect()] == ["x"]


def test_violation_tables(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(2,), (3,), (3,), (None,)], "k int")
    assert [tuple(r) for r in quality.orphans(child, "k", parent).collect()] == [(1, 2)]
    assert {r["k"] for r in quality.duplicate_keys(parent, "k").collect()} == {3, None}
    assert [r[0] for r in quality.key_difference(child.filter("k is not null"), parent.filter("k is not null"), "k").collect()] == [1]
    lines = tx(spark, [("1", "a", 1, "UK", datetime(2010, 1, 1), 1, p) for p in ("0", "1")])
    assert tuple(quality.zero_price_report(lines).first()) == (1, 2)
    assert quality.without_zero_price(lines).count() == 1


@pytest.mark.parametrize("top, bottom, places, times, want", [
    ("1", "8", 2, 1, 0.13), ("-1", "8", 2, 1, -0.13), ("1", "-8", 2, 1, -0.13), ("0.125", "1", 2, 1, 0.13), ("2.5", "1", 0, 1, 3.0),
    ("1", "2000", 1, 100, 0.1), ("999999", "2000000", 1, 100, 50.0), ("9999994", "20000000", 1, 100, 50.0), ("0", "7", 1, 100, 0.0),
    ("49.949999", "1", 1, 1, 49.9), ("49.95", "1", 1, 1, 50.0), ("123456789012.345", "0.001", 1, 1, 123456789012345.0), ("5", "0", 1, 1, None),
])
def test_ratios_are_rounded_once(spark, top, bottom, places, times, want):
    row = spark.range(1).select(F.lit(top).cast("decimal(30,6)").alias("t"), F.lit(bottom).cast("decimal(30,6)").alias("b"))
    assert row.select(numeric.exact_ratio("t", "b", places, times)).first()[0] == want


def test_a_ratio_just_under_a_half_is_not_rounded_twice(spark):
    # 0.24999995 has seven decimals: brought to six it would be 0.25, and 0.3 from there.
    row = spark.sql("SELECT 24999995L AS t, 100000000L AS b")
    assert row.select(numeric.exact_ratio("t", "b", 1)).first()[0] == 0.2


def test_bitmaps_count_like_distinct(spark):
    rows = spark.range(3000).select(
        F.pmod(F.col("id"), F.lit(7)).alias("g"), F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id"), F.lit(90_000)) - 5).cast("int").alias("c")
    )
    rows = rows.unionByName(spark.range(500).select(F.lit(3).cast("bigint").alias("g"), F.lit(42).alias("c")))
    maps = bitmaps.id_bitmaps(rows, ["g"], "c")
    want = {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.count_distinct("c").alias("n")).collect()}
    assert {r["g"]: r["n"] for r in maps.groupBy("g").agg(bitmaps.n_ids().alias("n")).collect()} == want
    one, two = (maps.filter(F.col("g") == g).withColumn("k", F.lit(1)) for g in (1, 2))
    ids = {g: {r["c"] for r in rows.filter(F.col("g") == g).collect()} - {None} for g in (1, 2)}
    met = bitmaps.common_ids(one, two, ["k"]).agg(bitmaps.n_ids().alias("n")).first()["n"]
    assert (met or 0) == len(ids[1] & ids[2])
    assert bitmaps.id_bitmaps(rows.filter("c IS NULL"), ["g"], "c").count() == 0


def test_months_apart(spark):
    row = spark.sql("SELECT DATE'2011-03-01' AS a, DATE'2009-12-01' AS b")
    assert row.select(dates.months_apart(F.col("a"), F.col("b"))).first()[0] == 15
