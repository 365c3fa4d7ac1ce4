"""Readers and writers for CSV, JSON lines, Parquet and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.dates import month_start
from . import schemas

RAW_TO_MODEL = {"stockcode": "stock_code", "invoicedate": "invoice_date"}


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header row and declared types, plain or compressed; a cell that does not parse fails the read.

    ``multi_line`` accepts line breaks inside quotes, at the price of one task
    per file.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_raw_invoices(
    spark: SparkSession, path: str, multi_line: bool = True, partitions: int | None = None
) -> DataFrame:
    """Raw invoice export under model column names.

    Descriptions may hold quoted line breaks, so a file is one task, as a gzip file is anyway; without such
    breaks ``multi_line=False`` lets plain files be split. Only the parsing stays with that task: the rows are dealt out
    behind it, to ``partitions`` tasks or as many as adaptive execution wants.
    """
    raw = read_csv(spark, path, schemas.RAW_INVOICES, multi_line)
    if multi_line or partitions:
        raw = raw.repartition(partitions) if partitions else raw.hint("rebalance")
    return raw.withColumnsRenamed(RAW_TO_MODEL)


def read_json_lines(spark: SparkSession, path: str, schema: StructType = schemas.DOCUMENTS) -> DataFrame:
    """One JSON object per line, typed by ``schema``; a broken line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_query(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Result of a SELECT over the given frames (by name) and catalog tables."""
    return spark.sql(sql, **views) if views else spark.sql(sql)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_scores(scores: DataFrame, path: str) -> None:
    """Account scores as CSV, lowest health first over all part files."""
    write_csv(scores.orderBy("health_score", "customer_id"), path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create the catalog table, or replace it with these rows; ``path`` keeps its files elsewhere."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_transactions(tx: DataFrame, path: str) -> None:
    """Fact table by invoice month, ordered by customer inside each file.

    Takes the place of the date and customer indexes: months are pruned by
    folder, customers by row-group statistics. ``rebalance`` lets adaptive
    execution split a month that holds most of the rows and merge tiny ones.
    """
    (
        tx.withColumn("invoice_month", month_start("invoice_date"))
        .hint("rebalance", F.col("invoice_month"))
        .sortWithinPartitions("invoice_month", "customer_id")
        .write.mode("overwrite").partitionBy("invoice_month").parquet(path)
    )


def z_order(df: DataFrame, columns: Sequence[str], bits: int = 6, out: str = "_z") -> DataFrame:
    """Add ``out``: the bits of the rank of each column, interleaved from the lowest up.

    The rank of a row is the range it falls in when the table is dealt out by that column; the other columns
    break ties, so a value that very many rows share spreads over several ranges.
    """
    ids = []
    for i, c in enumerate(columns):
        rest = [o for o in columns if o != c]
        df = df.repartitionByRange(1 << bits, c, *rest).withColumn(f"_rank{i}", F.spark_partition_id())
        ids.append(f"_rank{i}")
    z = reduce(Column.bitwiseOR, [
        F.shiftleft(F.shiftright(F.col(c), b).bitwiseAND(1), b * len(ids) + i) for b in range(bits) for i, c in enumerate(ids)
    ])
    return df.withColumn(out, z).drop(*ids)


def write_by_keys(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 6) -> None:
    """A table that can be looked up by any of ``columns``: files follow their Z-order.

    A file, and each of its row groups, holds a narrow stretch of every column, which its statistics tell; Bloom filters of the
    columns tell within that stretch. Takes the place of one index per column.
    """
    writer = z_order(df, columns, bits).repartitionByRange(files, "_z", *columns).sortWithinPartitions("_z", *columns).drop("_z").write
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", True)
    writer.mode("overwrite").parquet(path)


def look_up(spark: SparkSession, path: str, column: str, values: Sequence[object]) -> DataFrame:
    """Rows with one of ``values``, asked for so that Parquet can tell from its statistics and filters.

    Spark hands an IN list to Parquet as single values only while it is short, hence the chain of equalities.
    """
    wanted = reduce(Column.__or__, [F.col(column) == F.lit(v) for v in values], F.lit(False))
    return spark.read.parquet(path).filter(wanted)


def write_conversations(flat: DataFrame, path: str) -> None:
    """Classified rows by batch, ordered by category inside each file."""
    (
        flat.hint("rebalance", F.col("batch"))
        .sortWithinPartitions("batch", "category")
        .write.mode("overwrite").partitionBy("batch").parquet(path)
    )
