"""The relational model, mapped onto the given test tables.

Joins are added only for the columns asked for, so that a query over three
columns does not pay for five tables. No join is hinted: table statistics and
adaptive execution decide what is small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordering import after_cut, bucket_by_cuts, order_statistics, quantile_ranks
from ..operators.ingest import with_category
from .workspace import dealt

TRANSACTION_COLUMNS = (
    "invoice", "stock_code", "customer_id", "country", "invoice_date", "quantity", "price", "is_cancellation",
)
# Fixed values of the artificial message classifier.
EVENT_CATEGORIES = {"click": "browse", "view": "browse", "purchase": "commerce", "signup": "account", "error": "support"}
EVENT_TYPES = sorted(EVENT_CATEGORIES)
BATCHES = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """These columns of the events, stored for all cores: the ranks of their order are searched for in several reads."""
    rows = table(spark, sf_dir, "events")
    return dealt(rows.select(*columns), *[c for c in ("event_id", "ts") if c in columns] or columns, name="events")


def transactions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Invoice lines; ``columns`` picks from `TRANSACTION_COLUMNS` (default all)."""
    columns = columns or TRANSACTION_COLUMNS
    out = table(spark, sf_dir, "lineitem")
    if {"customer_id", "country", "invoice_date"} & set(columns):
        out = out.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    if "price" in columns:
        out = out.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "country" in columns:
        out = out.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        out = out.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    cancelled = F.col("l_returnflag") == "R"
    mapped: dict[str, Column] = {
        "invoice": F.concat(F.when(cancelled, "C").otherwise(""), F.col("l_orderkey").cast("string")),
        "stock_code": F.col("l_partkey").cast("string"),
        "customer_id": F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")).cast("int"),
        "country": F.col("n_name"),
        "invoice_date": F.col("o_orderdate"),
        "quantity": F.col("l_quantity").cast("int"),
        "price": F.col("p_retailprice").cast("decimal(10,3)"),
        "is_cancellation": cancelled,
    }
    return out.select(*[mapped[c].alias(c) for c in columns])


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("stock_code"), F.col("p_name").alias("description")
    )


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines as exported: text ids, bad ids, padded and missing descriptions.

    Country is the supplier's, so that one customer has several.
    """
    number = F.col("l_linenumber")
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.when(F.col("l_returnflag") == "R", "C").otherwise(""), F.col("l_orderkey").cast("string"))
            .alias("invoice"),
            F.col("l_partkey").cast("string").alias("stock_code"),
            F.when((F.col("l_partkey") % 50 == 7) | (number % 4 == 0), F.lit(None))
            .when(number % 4 == 1, F.upper("p_name"))
            .otherwise(F.concat(F.lit("  "), F.col("p_name"), F.lit("\t")))
            .alias("description"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("o_orderdate").alias("invoice_date"),
            F.col("p_retailprice").alias("price"),
            F.when(F.col("o_custkey") % 5 == 0, "n/a")
            .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
            .alias("customer_id"),
            F.col("n_name").alias("country"),
        )
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def predicted_intent(drifted: Column) -> Column:
    """The artificial classifier; it loses more classes on ``drifted`` rows."""
    k, kind = F.col("_k"), F.col("event_type")
    return (
        F.when(k % 10 == 0, "other")
        .when(drifted & (k % 10).between(1, 3), "other")
        .when((k % 10 == 4) & (kind == "click"), "view")
        .when((k % 10 == 4) & (kind == "view"), "click")
        .when(k % 17 == 3, "purchase")
        .otherwise(kind)
    )


def classified_rows(events: DataFrame, drifted: Column) -> DataFrame:
    """Classified utterances with their arrival time and key; works on streams too."""
    out = events.withColumn("_k", _k()).withColumn("pred", predicted_intent(drifted))
    out = with_category(out.withColumnRenamed("event_type", "intent_name"), "intent_name", EVENT_CATEGORIES)
    hundredths = F.pmod(37 * F.col("_k") + 13 * F.col("event_id"), F.lit(100))
    return out.select(
        "event_id", "ts",
        F.col("props").alias("text"), "intent_name", "category", "pred",
        (hundredths.cast("decimal(5,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(5,4)").alias("confidence"),
        (F.col("pred") == F.col("intent_name")).cast("int").alias("correct"),
    )


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as classified utterances in ten equal batches by arrival.

    Batch borders and the start of the drift (the last 30% of rows) are cut rows
    found once, so no row has to move for them.
    """
    rows = events(spark, sf_dir, "event_id", "ts", "event_type", "props")

    def ranks(n: int) -> list[int]:
        return [*quantile_ranks(n, BATCHES), 7 * n // 10]

    cuts = order_statistics(rows, "ts", ranks, key="event_id")
    # Ten rows or fewer may leave no row before the drift.
    drift = [c for c in cuts if c.target == BATCHES - 1]
    drifted = after_cut("ts", "event_id", drift[0]) if drift else F.lit(True)
    borders = [c for c in cuts if c.target < BATCHES - 1]
    return classified_rows(rows, drifted).withColumn("batch", bucket_by_cuts("ts", "event_id", borders) - 1)


def conversations_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the relational conversation table, without the row number in its id."""
    return classified(spark, sf_dir).select(
        F.col("text").alias("utterance"),
        F.col("intent_name").alias("true_intent"),
        "category",
        F.col("pred").alias("predicted_intent"),
        "confidence",
        F.col("correct").cast("boolean").alias("is_correct"),
        "batch",
    )


def text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real text to classify: whole documents with their language as the class."""
    return table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("intent_name"))


def quality_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second, unbalanced target: the quality label of the documents that have one."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id"), F.when(F.col("quality") == 1, "good").otherwise("poor").alias("intent_name")
    )
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id")
