"""Seeded splits, shuffles and draws that a recomputed task repeats exactly."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import after_cut, global_rank, order_statistics_by, rows_at_positions
from ..functions.seeding import seeded_order

SEED = 42


def train_sizes(class_rows: dict, test_fraction: float) -> dict:
    """Training rows per class: proportional, the largest remainders rounded up.

    The test set has ``ceil(test_fraction * n)`` rows over all classes.
    """
    n = sum(class_rows.values())
    train = n - math.ceil(round(test_fraction * n, 9))
    exact = {c: rows * train / n for c, rows in class_rows.items()}
    sizes = {c: math.floor(x) for c, x in exact.items()}
    by_remainder = sorted(exact, key=lambda c: (sizes[c] - exact[c], c))
    for c in by_remainder[: train - sum(sizes.values())]:
        sizes[c] += 1
    return sizes


def split_by_class(df: DataFrame, label: str, key: str, test_fraction: float, seed: int = SEED) -> DataFrame:
    """Add ``split`` (train or test) with exact per-class shares.

    Within a class the rows that come first in seeded order go to the test set.
    Only the border row of each class is looked up; nothing is shuffled, so one
    class may hold most of the rows.
    """
    ordered = df.withColumn("_order", seeded_order(key, seed))
    class_rows = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    train = train_sizes(class_rows, test_fraction)
    test = {c: rows - train[c] for c, rows in class_rows.items() if rows > train[c]}
    if not test:
        return df.withColumn("split", F.lit("train"))
    wanted = {c: (class_rows[c], [rows]) for c, rows in test.items()}
    cuts = order_statistics_by(ordered, label, wanted, "_order", key)
    in_test = reduce(Column.__or__, [
        (F.col(label) == F.lit(c.group)) & ~after_cut("_order", key, c) for c in cuts
    ])
    return ordered.withColumn("split", F.when(in_test, "test").otherwise("train")).drop("_order")


def seeded_shuffle(df: DataFrame, key: str, seed: int = 7) -> DataFrame:
    """All rows in seeded order (a range-partitioned sort)."""
    return df.orderBy(seeded_order(key, seed), key)


def resample(pool: DataFrame, key: str, groups: list[int], per_group: int, seed: int = 100) -> DataFrame:
    """Draw ``per_group`` rows with replacement for every group.

    Rows are numbered by ``key``; draw d of group g takes a row number from the
    seed ``seed + g`` and d. A row may be drawn again and then appears again.
    Output: ``group``, ``draw`` and the columns of the pool.
    """
    spark = pool.sparkSession
    draws = reduce(DataFrame.unionByName, [
        spark.range(per_group).select(
            F.lit(g).alias("group"), F.col("id").alias("draw"), seeded_order("id", seed + g).alias("_position")
        )
        for g in groups
    ])
    return rows_at_positions(pool, key, draws, "_position").select("group", "draw", *pool.columns)


def shuffled_positions(df: DataFrame, key: str, seed: int = 7) -> DataFrame:
    """Every row with its position (from 1) in seeded order."""
    return global_rank(df.withColumn("_seeded", seeded_order(key, seed)), "_seeded", key, "position").drop("_seeded")
