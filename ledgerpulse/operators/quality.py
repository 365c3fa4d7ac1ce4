"""Checks the database made at load time, as tables of violations."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Primary-key values that are NULL or occur more than once."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter((F.col("rows") > 1) | F.col(key).isNull())


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Foreign-key values without a parent, with the number of rows; NULL is allowed.

    Counting comes before the anti-join, so a hot key is one row in it.
    """
    parent = parent.select(F.col(parent_key or key).alias(key))
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(parent, key, "left_anti")


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Per text column the limit, the longest value and the number of rows over it."""
    checks = [
        F.struct(
            F.lit(c).alias("column"), F.lit(n).alias("max_length"),
            F.max(F.length(c)).alias("longest"), F.count_if(F.length(c) > n).alias("violations"),
        )
        for c, n in limits.items()
    ]
    return df.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


def not_fitting(df: DataFrame, c: str, type_: DecimalType) -> DataFrame:
    """Values a NUMERIC(p, s) column would refuse: too many digits before the point."""
    lost = F.col(c).isNotNull() & F.col(c).try_cast(type_).isNull()
    return df.filter(lost).groupBy(c).agg(F.count(F.lit(1)).alias("rows"))


def length_rules(limits: dict[str, int]) -> dict[str, Column]:
    """Rules that texts are no longer than their columns hold."""
    return {f"{c}_too_long": F.length(c) > n for c, n in limits.items()}


def fit_rule(c: str, type_: DecimalType) -> dict[str, Column]:
    """The rule that a number fits its NUMERIC column."""
    return {f"{c}_not_fitting": F.col(c).isNotNull() & F.col(c).try_cast(type_).isNull()}


def checked_load(df: DataFrame, path: str, key: str, rules: dict[str, Column]) -> dict[str, int]:
    """Write ``df`` to ``path`` in one job, rows that break a rule apart from the others; the rows per reason.

    ``rules`` maps reasons to conditions of a violation (NULL is none). The key must be present and unique; of rows that share
    one all are rejected, as none is the right one. Repeated keys are counted first, so a hot key is one row where the
    rows meet them. Accepted rows are read with `accepted`, the others, with ``reasons``, with `rejects`. The counts come from that column of
    the written files: counts observed during the write would leave the session unable to ship Spark ML's classifiers to its tasks.
    """
    repeated = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    marked = df.join(repeated, key, "left")
    conditions = {"key_missing": F.col(key).isNull(), "key_repeated": F.col("_rows").isNotNull(), **rules}
    reasons = F.array_compact(F.array(*[F.when(broken, F.lit(reason)) for reason, broken in conditions.items()]))
    checked = marked.withColumn("reasons", reasons).select(*df.columns, "reasons")
    checked.withColumn("rejected", (F.size("reasons") > 0).cast("string")).write.partitionBy("rejected").parquet(path)
    written = df.sparkSession.read.parquet(path)
    counts = written.agg(
        F.count_if(F.size("reasons") == 0).alias("accepted"), *[F.count_if(F.array_contains("reasons", r)).alias(r) for r in conditions]
    )
    return counts.first().asDict()


def accepted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("rejected") == "false").drop("rejected", "reasons")


def rejects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("rejected") == "true").drop("rejected")


def zero_price_report(tx: DataFrame) -> DataFrame:
    """Stock-adjustment lines (price zero) against all lines."""
    return tx.agg(
        F.count_if(F.col("price") == 0).alias("zero_price_rows"), F.count(F.lit(1)).alias("rows")
    )


def without_zero_price(tx: DataFrame) -> DataFrame:
    """Optional clean-up. No analysis applies it by itself, as in the reference."""
    return tx.filter(F.col("price") > 0)


def guest_share(tx: DataFrame) -> DataFrame:
    """Lines without a customer id, and their share."""
    guests = F.count_if(F.col("customer_id").isNull())
    return tx.agg(
        F.count(F.lit(1)).alias("rows"), guests.alias("guest_rows"),
        (guests.cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("guest_share"),
    )


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames; columns missing in one are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
