"""Named queries over invoice lines and accounts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions.ordering import global_rank, ntiles_global
from ..operators import accounts, churn_model, commerce, dashboards, evaluation, ingest, quality, retention, sampling
from ..operators import survival
from ..sources import schemas, tables
from ..sources import testdata as data
from ..sources.workspace import fresh_path, materialize

Query = Callable[[SparkSession, str], DataFrame]
CHURN_TEST_SHARE = 0.2


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    """Doubles cut to a length that does not depend on the order of summation."""
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- inputs -----------------------------------------------------------------


def features(spark: SparkSession, d: str) -> DataFrame:
    """Account features over stored per-customer sums: one pass over the lines serves all that follows.

    The end of the data is looked up once in what was stored, so no later step looks for it.
    """
    tx = data.transactions(spark, d, "invoice", "customer_id", "invoice_date", "quantity", "price", "is_cancellation")
    stored = materialize(accounts.customer_activity(tx), "activity")
    end = stored.agg(F.max("last_seen").cast("string")).first()[0]
    end = F.lit(end).cast(stored.schema["last_seen"].dataType)
    return accounts.churn_label(accounts.account_features(stored, end))


def formula_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores with a formula in the place of the model, so that SQL can check the rest."""
    scored = accounts.rfm_scores(features(spark, d)).withColumn(
        "churn_probability", F.col("recency_days") / (F.col("recency_days") + 90.0)
    )
    return accounts.health_scores(scored)


def fitted(spark: SparkSession, d: str) -> tuple[DataFrame, churn_model.ChurnModel]:
    """All accounts with split and RFM columns, and the model fitted on the training part."""
    split = sampling.split_by_class(
        accounts.rfm_scores(features(spark, d)), "churned", "customer_id", CHURN_TEST_SHARE
    )
    split = materialize(split, "accounts")
    return split, churn_model.churn_model(split.filter(F.col("split") == "train"))


def model_scores(spark: SparkSession, d: str) -> DataFrame:
    split, model = fitted(spark, d)
    return accounts.health_scores(model.score(split))


def test_counts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    split, model = fitted(spark, d)
    scored = materialize(model.score(split.filter(F.col("split") == "test")), "test")
    return scored, evaluation.confusion(scored, "churned", "churn_pred")


# --- analyses over lines ----------------------------------------------------


def monthly_activity(spark: SparkSession, d: str) -> DataFrame:
    return commerce.monthly_activity(
        data.transactions(spark, d, "customer_id", "invoice_date", "quantity", "price", "is_cancellation")
    )


def cohort_retention(spark: SparkSession, d: str) -> DataFrame:
    return commerce.cohort_retention(data.transactions(spark, d, "customer_id", "invoice_date", "is_cancellation"))


def rfm_top(spark: SparkSession, d: str) -> DataFrame:
    return commerce.rfm_quartiles(features(spark, d))


def rfm_all(spark: SparkSession, d: str) -> DataFrame:
    base = features(spark, d).select(
        "customer_id", "frequency", F.col("recency_days").cast("bigint").alias("recency_days"),
        (-F.col("recency_days")).alias("_recency"),
    )
    return ntiles_global(base, {
        "recency_quartile": ("_recency", "customer_id", 4), "frequency_tile": ("frequency", "customer_id", 7),
    }).drop("_recency")


def churn_status(spark: SparkSession, d: str) -> DataFrame:
    tx = data.transactions(spark, d, "customer_id", "invoice_date", "is_cancellation")
    per_customer = tx.groupBy("customer_id").agg(
        F.max(F.when(~F.col("is_cancellation"), F.col("invoice_date"))).alias("last_order"),
        F.max("invoice_date").alias("last_seen"),
    )
    return commerce.churn_status(materialize(per_customer, "last_order"))


def top_products(spark: SparkSession, d: str) -> DataFrame:
    tx = data.transactions(spark, d, "stock_code", "quantity", "price", "is_cancellation")
    return commerce.top_products(tx, data.products(spark, d))


def monthly_demand(spark: SparkSession, d: str) -> DataFrame:
    return commerce.monthly_demand(
        data.transactions(spark, d, "stock_code", "invoice_date", "quantity", "is_cancellation")
    )


def country_revenue(spark: SparkSession, d: str) -> DataFrame:
    return commerce.country_revenue(
        data.transactions(spark, d, "customer_id", "country", "quantity", "price", "is_cancellation")
    )


def revenue_drops(spark: SparkSession, d: str) -> DataFrame:
    return commerce.revenue_drops(
        data.transactions(spark, d, "customer_id", "invoice_date", "quantity", "price", "is_cancellation")
    )


def high_value_customers(spark: SparkSession, d: str) -> DataFrame:
    return commerce.high_value_customers(
        data.transactions(spark, d, "invoice", "customer_id", "quantity", "price", "is_cancellation")
    )


# --- ingest and quality -----------------------------------------------------


def normalized(spark: SparkSession, d: str) -> ingest.StarSchema:
    return ingest.normalize_invoices(data.raw_invoices(spark, d))


def customer_dimension(spark: SparkSession, d: str) -> DataFrame:
    return normalized(spark, d).customers


def product_dimension(spark: SparkSession, d: str) -> DataFrame:
    return normalized(spark, d).products


def fact_table(spark: SparkSession, d: str) -> DataFrame:
    fact = normalized(spark, d).transactions
    return fact.withColumn("price", F.col("price").cast("double"))


def raw_csv_ingest(spark: SparkSession, d: str) -> DataFrame:
    """The raw lines as a gzip export, some with quotes, commas and line breaks, read back and normalised."""
    path = fresh_path(spark, "raw.csv.gz")
    back = {model: raw for raw, model in tables.RAW_TO_MODEL.items()}
    broken = F.when(F.col("quantity") % 3 == 0, F.concat("description", F.lit('\n"boxed", new')))
    export = (
        data.raw_invoices(spark, d).withColumn("description", F.coalesce(broken, "description"))
        .withColumnsRenamed(back).select(schemas.RAW_INVOICES.names)
    )
    # Padding belongs to the data, so it must survive the file.
    export.write.option("header", True).option("compression", "gzip").option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    lines = ingest.typed_invoices(tables.read_raw_invoices(spark, path))
    return lines.groupBy("country").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("customer_id").alias("customers"),
        F.count_if("is_cancellation").alias("cancellations"), F.sum("quantity").alias("units"),
        F.count("description").alias("described"),
        F.count_if(F.col("description").endswith('\n"boxed", new')).alias("broken_lines"),
    )


def stored_fact_month(spark: SparkSession, d: str) -> DataFrame:
    """Revenue by month from the stored fact table, months pruned by folder."""
    path = fresh_path(spark, "transactions")
    tables.write_transactions(data.transactions(spark, d), path)
    stored = spark.read.parquet(path).filter(F.col("invoice_month") >= F.lit("1998-01-01").cast("date"))
    return stored.groupBy("invoice_month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(commerce.amount()).cast("double").alias("amount")
    )


def scores_csv(spark: SparkSession, d: str) -> DataFrame:
    """Account scores written as CSV and read back with their declared types."""
    path = fresh_path(spark, "scores.csv")
    tables.write_scores(accounts.account_scores(formula_scores(spark, d)), path)
    return tables.read_csv(spark, path, schemas.ACCOUNT_SCORES).select(
        "customer_id", "recency_days", "frequency", "churned", "segment", "rfm_score", "health_score"
    )


def replaced_table(spark: SparkSession, d: str) -> DataFrame:
    """A catalog table created, replaced and read by SQL."""
    path = fresh_path(spark, "products")
    name = "ledgerpulse_" + path.rsplit("/", 1)[-1].replace("-", "_")
    source = data.products(spark, d)
    tables.replace_table(source.withColumn("description", F.lit("old")), name, path + "-old")
    tables.replace_table(source, name, path)
    out = materialize(
        tables.read_query(spark, f"SELECT description, count(*) AS products FROM {name} GROUP BY description"), name
    )
    spark.sql(f"DROP TABLE {name}")
    return out


def duplicate_invoices(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_keys(data.transactions(spark, d, "invoice"), "invoice")


def key_checks(spark: SparkSession, d: str) -> DataFrame:
    """Duplicate keys per dimension (none expected), both dimensions from one stored pass over the raw lines."""
    keys = data.raw_invoices(spark, d).select("stock_code", "customer_id", "country", "description").withColumns({
        c: F.lit(None).cast(schemas.RAW_INVOICES[raw].dataType)
        for c, raw in (("invoice", "invoice"), ("quantity", "quantity"), ("invoice_date", "invoicedate"), ("price", "price"))
    })
    star = ingest.normalize_invoices(materialize(keys, "lines"))
    parts = {"customers": star.customers, "products": star.products}
    return quality.union_by_name(
        quality.duplicate_keys(df, schemas.PRIMARY_KEY[name]).agg(
            F.lit(name).alias("table"), F.count(F.lit(1)).alias("violations"))
        for name, df in parts.items()
    )


def priced_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines per stock code once lines without a price are gone; every fiftieth product is given away here."""
    tx = data.transactions(spark, d, "stock_code", "quantity", "price")
    free = F.col("stock_code").cast("int") % 50 == 7
    given = tx.withColumn("price", F.when(free, F.lit(0)).otherwise(F.col("price")).cast(schemas.PRICE))
    return quality.without_zero_price(given).groupBy("stock_code").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("quantity").alias("units")
    )


def _stored_by_keys(spark: SparkSession, d: str) -> str:
    path = fresh_path(spark, "by-keys")
    tables.write_by_keys(data.transactions(spark, d), path, ["stock_code", "invoice"], files=16)
    return path


def invoice_lookup(spark: SparkSession, d: str) -> DataFrame:
    """All lines of the invoices and credit notes of the three largest orders, from the table laid out by keys."""
    largest = data.table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(3)
    numbers = [str(r["o_orderkey"]) for r in largest.select("o_orderkey").collect()]
    found = tables.look_up(spark, _stored_by_keys(spark, d), "invoice", numbers + ["C" + n for n in numbers])
    return found.withColumn("price", F.col("price").cast("double"))


def stock_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Lines and units of the five dearest products, from the table laid out by keys."""
    dearest = data.table(spark, d, "part").orderBy(F.desc("p_retailprice"), "p_partkey").limit(5)
    codes = [str(r["p_partkey"]) for r in dearest.select("p_partkey").collect()]
    return tables.look_up(spark, _stored_by_keys(spark, d), "stock_code", codes).groupBy("stock_code", "is_cancellation").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("quantity").alias("units")
    )


def orphan_documents(spark: SparkSession, d: str) -> DataFrame:
    return quality.orphans(data.table(spark, d, "documents"), "doc_id", data.table(spark, d, "labels"))


def orphan_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines whose stock code has no described product."""
    star = normalized(spark, d)
    return quality.orphans(star.transactions, "stock_code", star.products.filter(F.col("description").isNotNull()))


def length_checks(spark: SparkSession, d: str) -> DataFrame:
    limits = {**schemas.MAX_LENGTH["transactions"], "invoice": 5}
    return quality.too_long(data.transactions(spark, d, "invoice", "stock_code", "country"), limits)


def precision_checks(spark: SparkSession, d: str) -> DataFrame:
    return quality.not_fitting(data.table(spark, d, "orders"), "o_totalprice", DecimalType(7, 2))


def zero_price(spark: SparkSession, d: str) -> DataFrame:
    return quality.zero_price_report(data.transactions(spark, d, "price"))


def guest_share(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.guest_share(data.transactions(spark, d, "customer_id")), 9, "guest_share")


def never_described(spark: SparkSession, d: str) -> DataFrame:
    """Stock codes that only occur without a description."""
    raw = data.raw_invoices(spark, d)
    return quality.key_difference(raw, raw.filter(F.col("description").isNotNull()), "stock_code")


# --- accounts ---------------------------------------------------------------


def account_features(spark: SparkSession, d: str) -> DataFrame:
    out = features(spark, d).select(
        "customer_id", "first_order", "last_order", "frequency", "monetary", "recency_days", "tenure_days",
        "observed_days", "avg_order_value", "churned",
    )
    return rounded(out, 6, "avg_order_value")


def rfm_scores(spark: SparkSession, d: str) -> DataFrame:
    return accounts.rfm_scores(features(spark, d)).select(
        "customer_id", "r_score", "f_score", "m_score", "rfm_score", "segment"
    )


def segment_counts(spark: SparkSession, d: str) -> DataFrame:
    return accounts.segment_counts(accounts.rfm_scores(features(spark, d)))


def health_scores(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        formula_scores(spark, d).select("customer_id", "churn_probability", "rfm_score", "health_score"),
        9, "churn_probability",
    )


def worklist(spark: SparkSession, d: str) -> DataFrame:
    return rounded(accounts.worklist(formula_scores(spark, d)), 9, "churn_probability")


def segment_summary(spark: SparkSession, d: str) -> DataFrame:
    return accounts.segment_summary(formula_scores(spark, d))


def retention_whatif(spark: SparkSession, d: str) -> DataFrame:
    grid = retention.scenario_grid([0.1, 0.25, 0.5], [5.0, 15.0])
    return retention.retention_whatif(formula_scores(spark, d), grid)


def account_kpis(spark: SparkSession, d: str) -> DataFrame:
    return rounded(accounts.account_kpis(formula_scores(spark, d)), 9, "churn_rate")


def health_histogram(spark: SparkSession, d: str) -> DataFrame:
    return dashboards.histogram(formula_scores(spark, d), "health_score")


def risk_split(spark: SparkSession, d: str) -> DataFrame:
    return dashboards.risk_split(formula_scores(spark, d))


def account_ranks(spark: SparkSession, d: str) -> DataFrame:
    """First-come rank of every account by frequency."""
    return global_rank(features(spark, d).select("customer_id", "frequency"), "frequency", "customer_id", "rank")


# --- model and survival -----------------------------------------------------


def churn_split(spark: SparkSession, d: str) -> DataFrame:
    split = sampling.split_by_class(features(spark, d), "churned", "customer_id", CHURN_TEST_SHARE)
    return split.select("customer_id", "churned", "split")


def churn_coefficients(spark: SparkSession, d: str) -> DataFrame:
    split, model = fitted(spark, d)
    return rounded(model.coefficient_table(split), 6, "coefficient")


def churn_scores(spark: SparkSession, d: str) -> DataFrame:
    return rounded(accounts.account_scores(model_scores(spark, d)), 6, "churn_probability", "avg_order_value")


def churn_worklist(spark: SparkSession, d: str) -> DataFrame:
    return rounded(accounts.worklist(model_scores(spark, d)), 6, "churn_probability")


def churn_report(spark: SparkSession, d: str) -> DataFrame:
    _, counts = test_counts(spark, d)
    return rounded(evaluation.class_report(counts), 6, "precision", "recall", "f1")


def churn_quality(spark: SparkSession, d: str) -> DataFrame:
    scored, counts = test_counts(spark, d)
    overall = evaluation.accuracy(counts).withColumn("f1", evaluation.binary_f1(counts, 1).scalar())
    auc = evaluation.roc_auc(scored, "churn_probability", "churned").select("auc").scalar()
    return rounded(overall.withColumn("auc", auc), 6, "accuracy", "f1", "auc")


def recency_auc(spark: SparkSession, d: str) -> DataFrame:
    """AUC of the mean order value for churn, over all accounts."""
    scored = features(spark, d).withColumn("score", F.round("avg_order_value", 1))
    return rounded(evaluation.roc_auc(scored, "score", "churned"), 9, "auc")


def kaplan_meier(spark: SparkSession, d: str) -> DataFrame:
    km = survival.kaplan_meier(features(spark, d))
    return rounded(km, 9, "survival", "lower", "upper")


def median_survival(spark: SparkSession, d: str) -> DataFrame:
    return survival.median_survival(survival.kaplan_meier(features(spark, d)))


def cox_hazards(spark: SparkSession, d: str) -> DataFrame:
    covariates = survival.cox_covariates(features(spark, d))
    model = survival.cox_fit(covariates, "observed_days", "churned", ["frequency", "monetary_root4"])
    return rounded(model.hazard_ratios(covariates), 6, "coefficient", "hazard_ratio")


QUERIES: dict[str, Query] = {
    "nq_a1_monthly_activity": monthly_activity,
    "nq_a2_cohort_retention": cohort_retention,
    "nq_a3_rfm_top": rfm_top,
    "nq_a4_churn_status": churn_status,
    "nq_a5_top_products": top_products,
    "nq_a6_monthly_demand": monthly_demand,
    "nq_a7_country_revenue": country_revenue,
    "nq_a8_revenue_drops": revenue_drops,
    "nq_a9_high_value_customers": high_value_customers,
    "d_customer_dimension": customer_dimension,
    "d_product_dimension": product_dimension,
    "d_fact_table": fact_table,
    "d_duplicate_invoices": duplicate_invoices,
    "d_key_checks": key_checks,
    "d_orphan_documents": orphan_documents,
    "d_orphan_lines": orphan_lines,
    "d_length_checks": length_checks,
    "d_precision_checks": precision_checks,
    "d_zero_price": zero_price,
    "d_priced_lines": priced_lines,
    "d_guest_share": guest_share,
    "d_never_described": never_described,
    "io_raw_csv_ingest": raw_csv_ingest,
    "io_stored_fact_month": stored_fact_month,
    "io_invoice_lookup": invoice_lookup,
    "io_stock_lookup": stock_lookup,
    "io_scores_csv": scores_csv,
    "io_replaced_table": replaced_table,
    "ch_account_features": account_features,
    "ch_rfm_scores": rfm_scores,
    "ch_segment_counts": segment_counts,
    "ch_health_scores": health_scores,
    "ch_worklist": worklist,
    "ch_segment_summary": segment_summary,
    "ch_retention_whatif": retention_whatif,
    "ch_account_kpis": account_kpis,
    "w_ntile_accounts": rfm_all,
    "w_account_ranks": account_ranks,
    "bi_health_histogram": health_histogram,
    "bi_risk_split": risk_split,
    "ml_churn_split": churn_split,
    "ml_churn_coefficients": churn_coefficients,
    "ml_churn_scores": churn_scores,
    "ml_churn_worklist": churn_worklist,
    "ml_churn_report": churn_report,
    "ml_churn_quality": churn_quality,
    "ev_recency_auc": recency_auc,
    "sv_kaplan_meier": kaplan_meier,
    "sv_median_survival": median_survival,
    "sv_cox_hazards": cox_hazards,
}
