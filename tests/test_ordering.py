"""The cell-wise order against plain windows, with many small cells and hot values."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerpulse.functions import ordering as O
from ledgerpulse.sources import testdata as data
from ledgerpulse.sources.testdata import table


@pytest.fixture(scope="module")
def events(spark, tables):
    hot = F.when(F.col("event_id") < 400, F.lit(7)).otherwise(F.round("value").cast("int"))
    return table(spark, tables, "events").select(
        "event_id", "ts", hot.alias("hot"), F.col("value").cast("decimal(12,2)").alias("money"), "value"
    ).cache()


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("value", ["hot", "ts", "money"])
@pytest.mark.parametrize("cells", [3, 64, None])
def test_rank_ntile_and_quantile_buckets(events, value, cells):
    order = Window.orderBy(value, "event_id")
    n = events.count()
    want = events.select(
        "event_id", F.row_number().over(order).cast("bigint").alias("rank"), F.ntile(7).over(order).alias("tile"),
    ).withColumn("bucket", F.expr(f"greatest(1, ceil(10 * (rank - 1) / {n - 1}))").cast("int"))
    got = O.ntile_global(events, value, "event_id", 7, "tile", cells)
    got = O.equal_freq(got, value, "event_id", 10, "bucket", cells)
    got = O.global_rank(got, value, "event_id", "rank", cells)
    assert same(got.select("event_id", "rank", "tile", "bucket"), want)


@pytest.mark.parametrize("cells", [4, None])
@pytest.mark.parametrize("value", ["hot", "value"])
def test_edges_are_interpolated_like_numpy(events, value, cells):
    values = [float(r[0]) for r in events.select(value).collect()]
    want = np.percentile(values, [10 * b for b in range(1, 10)])
    assert O.quantile_edges(events, value, 10, cells) == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("cells", [5, None])
def test_running_totals(events, cells):
    per_value = events.groupBy("hot").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("hot").rowsBetween(Window.unboundedPreceding, -1))
    want = per_value.withColumn("before", F.coalesce(before, F.lit(0)))
    assert same(O.running_totals(per_value, "hot", {"before": F.col("n")}, cells), want)


def test_cut_rows_within_groups(events):
    grouped = events.withColumn("g", F.col("event_id") % 3)
    sizes = {r["g"]: r["n"] for r in grouped.groupBy("g").agg(F.count("*").alias("n")).collect()}
    wanted = {g: (n, [1, n // 2, n]) for g, n in sizes.items()}
    order = Window.partitionBy("g").orderBy("hot", "event_id")
    ranked = {(r["g"], r["rn"]): r["event_id"] for r in grouped.withColumn("rn", F.row_number().over(order)).collect()}
    rows = O.order_statistics_by(grouped, "g", wanted, "hot", "event_id", 8)
    assert len(rows) == 9
    assert all(ranked[r.group, r.rank] == r.key for r in rows)


def test_result_does_not_depend_on_partitions(events):
    one = O.ntile_global(events.coalesce(1), "hot", "event_id", 5, "t", 16).select("event_id", "t")
    many = O.ntile_global(events.repartition(13), "hot", "event_id", 5, "t", 16).select("event_id", "t")
    assert same(one, many)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_fewer_rows_than_buckets(spark, n):
    rows = spark.range(n).select("id", F.col("id").alias("v"))
    assert sorted(r["t"] for r in O.ntile_global(rows, "v", "id", 4, "t").collect()) == list(range(1, n + 1))
    buckets = sorted(r["b"] for r in O.equal_freq(rows, "v", "id", 10, "b").collect())
    assert buckets == [max(1, -(-10 * i // (n - 1))) if n > 1 else 1 for i in range(n)]


def test_rows_without_a_value_are_set_aside(spark):
    rows = spark.range(40).select("id", F.when(F.col("id") % 4 > 0, F.col("id") * 1.0).alias("v"))
    out = O.global_rank(O.ntile_global(rows, "v", "id", 3, "t", 4), "v", "id", "rank", 4).collect()
    assert all(r["rank"] is None and r["t"] is None for r in out if r["v"] is None)
    assert sorted(r["rank"] for r in out if r["v"] is not None) == list(range(1, 31))
    assert len(O.quantile_edges(rows, "v", 5)) == 4


@pytest.mark.parametrize("cells", [40, None])
def test_a_value_of_half_the_rows_is_cut_along_the_key(spark, cells):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("v"))
    order = Window.orderBy("v", "id")
    want = {r["rn"]: r["id"] for r in rows.withColumn("rn", F.row_number().over(order)).collect()}
    ranks = [1, 3, 4, 5, 4999, 10_002, 10_003, 10_004, 20_000]
    found = O.order_statistics(rows, "v", lambda n: ranks, "id", cells)
    assert [(r.rank, r.key) for r in found] == [(r, want[r]) for r in ranks]
    assert [r.value for r in O.order_statistics(rows, "v", lambda n: ranks, None, cells)] == [r.value for r in found]


def test_brackets_follow_the_ranks_and_not_the_rows(spark):
    for n in (2_000, 40_000):
        rows = spark.range(n).select("id", F.pmod(F.xxhash64("id"), F.lit(n)).alias("v"))
        cuts = [O._Cuts()]
        order = [O.tile_order("v", "id", 4)]
        for _ in range(2):
            for cell in O._counted(rows, order, cuts):
                O._refine(cuts[0], order[0], cell, [max(1, cell["n"] // 2)])
        assert len(cuts[0].points) <= 40


def test_a_hot_value_is_several_ranges(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("v"))
    sizes = O._ranged(rows, ["v", "id"], 16).groupBy("_range").count().toPandas()["count"]
    assert len(sizes) >= 12 and sizes.max() <= 4 * 4000 / 16


@settings(max_examples=200, deadline=None)
@given(st.integers(8, 100_000), st.integers(2, 12))
def test_bucket_sizes_are_even(n, k):
    uppers = [0, *O.quantile_ranks(n, k), n]
    sizes = [b - a for a, b in zip(uppers, uppers[1:])]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 2
    tiles = [0, *O.ntile_ranks(n, k), n]
    sizes = [b - a for a, b in zip(tiles, tiles[1:])]
    assert sizes == sorted(sizes, reverse=True) and sizes[0] - sizes[-1] <= 1


def test_published_bucket_sizes():
    uppers = [0, *O.quantile_ranks(538, 10), 538]
    assert [b - a for a, b in zip(uppers, uppers[1:])] == [54, 54, 54, 53, 54, 54, 53, 54, 54, 54]
    uppers = [0, *O.quantile_ranks(5881, 4), 5881]
    assert [b - a for a, b in zip(uppers, uppers[1:])] == [1471, 1470, 1470, 1470]

def test_brackets_are_searched_not_scanned(spark):
    points = [float(p) for p in range(-100, 100)]
    values = [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.5, -100.0, 99.0, 99.5, 7.0]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, id bigint")
    cut = O._Cuts(points, {7.0: [1.0, 9.0]})
    out = O._bracketed(df, [O.Order("v", lambda n: [1], "id")], [cut])
    found = {r["id"]: (r["_cell"], r["_sub"], r["_code"]) for r in out.collect()}
    # Spark puts NaN above all numbers.
    place = lambda v, ps: 2 * len(ps) if v != v else 2 * sum(p < v for p in ps) + (v in ps)
    for i, v in enumerate(values):
        if v is None:
            assert i not in found
            continue
        cell = place(v, points)
        assert found[i][:2] == (cell, place(i, [1.0, 9.0]) if v == 7.0 else 0)
        assert cell % 2 == 0 or found[i][2] == i
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan  # a loop over all points at every row


def test_one_row_group_is_read_by_all_cores(spark, tmp_path):
    kinds = F.array(*[F.lit(t) for t in data.EVENT_TYPES])
    rows = spark.range(20_000).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("ts"),
        F.element_at(kinds, (F.col("id") % 5 + 1).cast("int")).alias("event_type"),
        F.concat(F.lit('{"k": '), F.col("id") % 100, F.lit("}")).alias("props"),
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(key, "1k")
    try:
        pool = data.classified(spark, str(tmp_path))
        files = [r["count"] for r in pool.groupBy(F.input_file_name()).count().collect()]
    finally:
        spark.conf.unset(key)
    assert sum(files) == 20_000 and len(files) > 2 and max(files) < 10_000
    assert {r["batch"]: r["count"] for r in pool.groupBy("batch").count().collect()} == dict.fromkeys(range(10), 2000)
