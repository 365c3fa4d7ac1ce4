"""Raw invoice lines to customers, products and transactions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import PRICE

# Intent to category (fixed values).
INTENT_CATEGORIES = {
    "order": "order_management",
    "order_status": "order_management",
    "cancel": "order_management",
    "cancel_reservation": "order_management",
    "confirm_reservation": "order_management",
    "restaurant_reservation": "order_management",
    "pay_bill": "payments_billing",
    "bill_due": "payments_billing",
    "transactions": "payments_billing",
    "spending_history": "payments_billing",
    "transfer": "payments_billing",
    "direct_deposit": "payments_billing",
    "card_declined": "payments_billing",
    "report_fraud": "complaints_security",
    "damaged_card": "complaints_security",
    "lost_luggage": "delivery_logistics",
    "travel_alert": "delivery_logistics",
    "reminder": "scheduling",
    "reminder_update": "scheduling",
    "oos": "out_of_scope",
}


class StarSchema(NamedTuple):
    customers: DataFrame
    products: DataFrame
    transactions: DataFrame


def is_cancellation(invoice: Column | str) -> Column:
    """Credit notes carry a capital C in front of the invoice number."""
    invoice = F.col(invoice) if isinstance(invoice, str) else invoice
    return invoice.cast("string").startswith("C")


def whole_number(c: Column | str) -> Column:
    """Text as an integer; anything that is not a whole number becomes NULL."""
    number = (F.col(c) if isinstance(c, str) else c).try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def strip(c: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def most_frequent(df: DataFrame, by: str, c: str) -> DataFrame:
    """Per key the most frequent non-NULL value, the lowest on a tie; NULL if there is none.

    Counts come first, so a hot key sends one row per value and task, and the
    state per key is a single best value rather than a map of all values.
    """
    counts = df.groupBy(by, c).agg(F.count(c).alias("_n"))
    best = F.min(F.when(F.col("_n") > 0, F.struct((-F.col("_n")).alias("n"), F.col(c).alias("v"))))
    return counts.groupBy(by).agg(best.alias("_best")).select(by, F.col("_best.v").alias(c))


def typed_invoices(raw: DataFrame) -> DataFrame:
    """Raw lines with the cancellation flag and a nullable integer customer id."""
    return raw.withColumns({
        "invoice": F.col("invoice").cast("string"),
        "is_cancellation": is_cancellation("invoice"),
        "customer_id": whole_number("customer_id"),
    })


def customer_dimension(lines: DataFrame) -> DataFrame:
    """Each known customer with the most frequent country."""
    return most_frequent(lines.filter(F.col("customer_id").isNotNull()), "customer_id", "country")


def product_dimension(lines: DataFrame) -> DataFrame:
    """Each stock code with its most frequent description, NULL if it never had one."""
    return most_frequent(lines.withColumn("description", strip("description")), "stock_code", "description")


def fact_table(lines: DataFrame) -> DataFrame:
    return lines.select(
        "invoice", "stock_code", "customer_id", "country", "invoice_date", "quantity",
        F.col("price").cast(PRICE).alias("price"), "is_cancellation",
    )


def normalize_invoices(raw: DataFrame) -> StarSchema:
    """Customers, products and transactions from raw lines (model column names)."""
    lines = typed_invoices(raw)
    return StarSchema(customer_dimension(lines), product_dimension(lines), fact_table(lines))


def with_category(df: DataFrame, intent: str, categories: dict[str, str] = INTENT_CATEGORIES) -> DataFrame:
    """Add ``category`` from a fixed lookup, NULL for an intent that is not in it.

    The lookup is part of the program, so it goes into the plan as a literal
    map instead of a join.
    """
    lookup = F.create_map(*[F.lit(x) for pair in categories.items() for x in pair])
    return df.withColumn("category", F.try_element_at(lookup, F.col(intent)))
