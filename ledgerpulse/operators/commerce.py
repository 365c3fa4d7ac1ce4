"""The nine analyses over invoice lines.

Each aggregates before it joins, ranks or sorts, so that everything after the
first shuffle has the size of customers, products, months or countries. Every
top-k has a unique tie-break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bitmaps import common_ids, id_bitmaps, n_ids
from ..functions.dates import month_start
from ..functions.numeric import exact_percent, exact_ratio, ratio, round_money
from ..functions.ordering import ntiles_global


def amount() -> Column:
    return F.col("quantity") * F.col("price")


def sales(tx: DataFrame) -> DataFrame:
    return tx.filter(~F.col("is_cancellation"))


def customer_sales(tx: DataFrame) -> DataFrame:
    """Sales of known customers; guests have no id."""
    return sales(tx).filter(F.col("customer_id").isNotNull())


def monthly_activity(tx: DataFrame) -> DataFrame:
    """Active customers and revenue per month, with the change in percent.

    Credit notes make a customer active but bring no revenue.
    """
    known = tx.filter(F.col("customer_id").isNotNull()).select("customer_id", "is_cancellation", amount().alias("_amount"), month_start("invoice_date").alias("month"))
    # Revenue rides along with the bitmaps, so the lines are read once.
    parts = known.groupBy("month", F.bitmap_bucket_number("customer_id").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("ids"),
        F.sum(F.when(~F.col("is_cancellation"), F.col("_amount"))).alias("_revenue"),
    )
    monthly = parts.groupBy("month").agg(n_ids().alias("active_customers"), F.sum("_revenue").alias("revenue"))
    before = F.lag("revenue").over(Window.orderBy("month"))
    return monthly.select(
        "month", "active_customers", round_money("revenue").alias("revenue"),
        exact_percent(F.col("revenue") - before, before, 1).alias("revenue_mom_change_pct"),
    ).orderBy("month")


def cohort_retention(tx: DataFrame, max_month: int = 6) -> DataFrame:
    """Share of each first-purchase cohort that is active 0..max_month months later.

    Two sets of bitmaps are built: who bought in a month, and whose first month it was (from one row per customer). A cell of the result is
    the number of ids that a cohort shares with a month, so no customer-month is shuffled; everybody is active in
    month 0, which makes that cell the cohort's size.
    """
    bought = customer_sales(tx).select("customer_id", month_start("invoice_date").alias("active_month"))
    months = id_bitmaps(bought, ["active_month"], "customer_id")
    born = bought.groupBy("customer_id").agg(F.min("active_month").alias("cohort_month"))
    cohorts = id_bitmaps(born, ["cohort_month"], "customer_id")
    ages = F.explode(F.sequence(F.lit(0), F.lit(max_month))).alias("month_number")
    # Each bitmap of a cohort meets those of the months that follow, each bitmap of a month the cohorts before it.
    later = cohorts.select("cohort_month", "_bucket", "ids", ages)
    seen = months.select(ages, "active_month", "_bucket", "ids").withColumn(
        "cohort_month", F.add_months("active_month", -F.col("month_number"))
    )
    active = (
        common_ids(later, seen, ["cohort_month", "month_number"])
        .groupBy("cohort_month", "month_number")
        .agg(n_ids().alias("active_customers"))
        .filter("active_customers > 0")
    )
    size = F.max(F.when(F.col("month_number") == 0, F.col("active_customers"))).over(
        Window.partitionBy("cohort_month")
    )
    return (
        active.withColumn("cohort_customers", size)
        .withColumn("retention_pct", exact_percent("active_customers", "cohort_customers", 1))
        .select("cohort_month", "month_number", "active_customers", "cohort_customers", "retention_pct")
        .orderBy("cohort_month", "month_number")
    )


def rfm_quartiles(features: DataFrame, tiles: int = 4, n: int = 20) -> DataFrame:
    """Recency, frequency and money with NTILEs over all accounts; the top ``n`` by money.

    ``features`` is a stored `accounts.account_features`.
    """
    base = features.select(
        "customer_id", F.col("recency_days").cast("bigint").alias("recency_days"), "frequency",
        F.round("monetary_exact", 2).alias("monetary"), (-F.col("recency_days")).alias("_recency"),
    )
    values = (("_recency", "recency"), ("frequency", "frequency"), ("monetary", "monetary"))
    tiled = ntiles_global(base, {f"{name}_quartile": (value, "customer_id", tiles) for value, name in values})
    return (
        tiled.drop("_recency")
        .orderBy(F.desc("monetary"), "customer_id")
        .limit(n)
        .withColumn("monetary", F.col("monetary").cast("double"))
    )


def churn_status(activity: DataFrame, cutoff_days: int = 90) -> DataFrame:
    """Active and churned customers with their share.

    Churned means the last order is more than ``cutoff_days`` times 24 hours
    before the latest invoice of any kind. ``activity`` is
    `accounts.customer_activity`.
    """
    dataset_end = activity.agg(F.max("last_seen")).scalar()
    silence = dataset_end - F.col("last_order")
    churned = silence > F.make_dt_interval(days=F.lit(cutoff_days))
    counts = (
        activity.filter(F.col("customer_id").isNotNull() & F.col("last_order").isNotNull())
        .groupBy(F.when(churned, "churned").otherwise("active").alias("status"))
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    total = F.sum("customers").over(Window.partitionBy())
    return counts.withColumn("pct", exact_percent(F.col("customers"), total, 1))


def product_revenue(tx: DataFrame) -> DataFrame:
    return sales(tx).groupBy("stock_code").agg(F.sum(amount()).alias("revenue"))


def top_products(tx: DataFrame, products: DataFrame, n: int = 15) -> DataFrame:
    """Best products by revenue with the running share of all revenue.

    Products with equal revenue share the running value, so it depends on the
    revenue alone: the running sum is taken over the ``n`` highest distinct
    revenues, however many products tie on one of them.
    """
    revenue = product_revenue(tx).join(products, "stock_code")
    total = revenue.agg(F.sum("revenue")).scalar()
    by_value = (
        revenue.groupBy("revenue").agg(F.sum("revenue").alias("_sum")).orderBy(F.desc("revenue")).limit(n)
    )
    running = by_value.select(
        "revenue", F.sum("_sum").over(Window.orderBy(F.desc("revenue"))).alias("_running")
    )
    top = revenue.orderBy(F.desc("revenue"), "stock_code").limit(n)
    return (
        top.join(F.broadcast(running), "revenue")
        .select(
            "stock_code", "description", "revenue",
            exact_percent(F.col("_running"), total, 2).alias("cumulative_pct"),
        )
        .orderBy(F.desc("revenue"), "stock_code")
        .withColumn("revenue", round_money("revenue"))
    )


def monthly_demand(tx: DataFrame, n: int = 5) -> DataFrame:
    """Units per month of the ``n`` products sold most.

    Lines are added up to product and month once; both the ranking and the
    result are read from that. (A semi-join would be pushed below the sums and
    scan the lines twice; the list is unique, so the inner join keeps the same rows.)
    """
    monthly = sales(tx).groupBy("stock_code", month_start("invoice_date").alias("month")).agg(
        F.sum("quantity").alias("units_sold")
    )
    top = (
        monthly.groupBy("stock_code").agg(F.sum("units_sold").alias("_units"))
        .orderBy(F.desc("_units"), "stock_code")
        .limit(n)
    )
    return monthly.join(F.broadcast(top.select("stock_code")), "stock_code").orderBy("stock_code", "month")


def country_revenue(tx: DataFrame, n: int = 10) -> DataFrame:
    """Countries by revenue. Guests count in the revenue but not as customers."""
    # Guests are a bucket of their own, without ids.
    parts = sales(tx).groupBy("country", F.bitmap_bucket_number("customer_id").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("ids"), F.sum(amount()).alias("_revenue")
    )
    top = (
        parts.groupBy("country")
        .agg(n_ids().alias("customers"), F.sum("_revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "country")
        .limit(n)
    )
    # The rank among the top n is the rank among all.
    rank = F.rank().over(Window.orderBy(F.desc("revenue")))
    return top.select(
        "country", "customers", round_money("revenue").alias("revenue"), rank.alias("revenue_rank")
    ).orderBy("revenue_rank", "country")


def revenue_drops(tx: DataFrame, floor: float = 500, keep: float = 0.2, n: int = 20) -> DataFrame:
    """Sharpest falls against a customer's previous active month.

    Reported when that month was above ``floor`` and less than ``keep`` of it is left.
    """
    monthly = customer_sales(tx).groupBy("customer_id", month_start("invoice_date").alias("month")).agg(
        F.sum(amount()).alias("revenue")
    )
    before = F.lag("revenue").over(Window.partitionBy("customer_id").orderBy("month"))
    fallen = monthly.withColumn("prev_revenue", before).filter(
        (F.col("prev_revenue") > F.lit(str(floor)).cast("decimal(18,6)"))
        & (F.col("revenue") < F.col("prev_revenue") * F.lit(str(keep)).cast("decimal(7,6)"))
    )
    return (
        fallen.select(
            "customer_id", "month", round_money("revenue").alias("revenue"),
            round_money("prev_revenue").alias("prev_revenue"),
            exact_percent(F.col("revenue") - F.col("prev_revenue"), F.col("prev_revenue"), 1).alias("mom_change_pct"),
        )
        .orderBy("mom_change_pct", "customer_id", "month")
        .limit(n)
    )


def high_value_customers(tx: DataFrame, n: int = 15) -> DataFrame:
    """Customers whose mean order is above the mean of all orders.

    Both means come from the same per-customer totals, so the orders are added
    up once and the overall mean reuses that shuffle.
    """
    orders = customer_sales(tx).groupBy("invoice", "customer_id").agg(F.sum(amount()).alias("order_value"))
    per_customer = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("order_value").alias("_total")
    )
    overall = per_customer.agg(ratio(F.sum("_total"), F.sum("orders"))).scalar()
    mean = ratio("_total", "orders")
    return (
        per_customer.filter(mean > overall)
        .select("customer_id", "orders", exact_ratio("_total", "orders", 2).alias("avg_order_value"))
        .orderBy(F.desc("avg_order_value"), "customer_id")
        .limit(n)
    )
