"""Lookups without an index, draws by position, the checked load and the keyed store."""

from __future__ import annotations

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerpulse.functions import ordering
from ledgerpulse.operators import quality, sampling
from ledgerpulse.sources import keyed_store, schemas, tables


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("keys") / "table")
    rows = spark.range(40_000).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("string").alias("stock_code"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9000)).cast("string").alias("invoice"), "id",
    ).withColumn("stock_code", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("stock_code")))
    tables.write_by_keys(rows, path, ["stock_code", "invoice"], files=32)
    return path, rows


def rows_read(spark, df):
    """Rows that the scan handed on, pruned row groups left out."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")
        found = again.collect()
        leaf = again._jdf.queryExecution().executedPlan().collectLeaves().head()
        return found, leaf.metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("column, values, share", [("invoice", ["17", "4711"], 0.6), ("stock_code", ["500", "77"], 0.45), ("invoice", ["none"], 0.05)])
def test_a_lookup_reads_few_row_groups(spark, laid_out, column, values, share):
    path, rows = laid_out
    found, read = rows_read(spark, tables.look_up(spark, path, column, values))
    assert sorted(found) == sorted(rows.filter(F.col(column).isin(values)).collect())
    assert read <= share * 40_000


def test_a_hot_value_lies_in_several_files(spark, laid_out):
    hot = spark.read.parquet(laid_out[0]).filter("stock_code = 'hot'").groupBy(F.input_file_name()).count().toPandas()["count"]
    assert len(hot) >= 6 and hot.max() < 0.5 * hot.sum()


def test_z_order_interleaves_rank_bits(spark):
    rows = spark.range(1024).select((F.col("id") % 32).alias("a"), F.floor(F.col("id") / 32).alias("b"))
    out = tables.z_order(rows.repartition(5), ["a", "b"], bits=2).toPandas()
    quarter = out.groupby("_z")[["a", "b"]].agg(lambda x: x.max() - x.min())
    assert len(quarter) == 16 and quarter.to_numpy().max() <= 12


def test_draws_by_position(spark):
    pool = spark.range(0, 3000, 3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    asked = spark.createDataFrame([(0,), (999,), (1000,), (5,), (5,), (10**12 + 7,)], "position bigint")
    out = ordering.rows_at_positions(pool.repartition(7), "k", asked).select("position", "k", "v").collect()
    assert sorted(out) == sorted((p, 3 * (p % 1000), 6 * (p % 1000)) for p in (0, 999, 1000, 5, 5, 10**12 + 7))
    assert sampling.resample(pool.limit(0), "k", [1], 4).count() == 0
    drawn = sampling.resample(pool, "k", [1, 2], 50)
    assert drawn.collect() and Counter(r["group"] for r in drawn.collect()) == {1: 50, 2: 50}


def test_checked_load(spark, tmp_path):
    rows = [("a", "x", 1.0), ("a", "y", 2.0), (None, "x", 1.0), ("b", "long", 1.0), ("c", None, None), ("d", "long", 99.0)]
    df = spark.createDataFrame(rows, "k string, t string, n double")
    rules = quality.length_rules({"t": 3}) | quality.fit_rule("n", schemas.CONFIDENCE)
    path = str(tmp_path / "load")
    counts = quality.checked_load(df, path, "k", rules)
    assert counts == {"accepted": 1, "key_missing": 1, "key_repeated": 2, "t_too_long": 2, "n_not_fitting": 1}
    assert [tuple(r) for r in quality.accepted(spark, path).collect()] == [("c", None, None)]
    found = {(r["k"], r["t"]): r["reasons"] for r in quality.rejects(spark, path).collect()}
    assert found["d", "long"] == ["t_too_long", "n_not_fitting"] and found[None, "x"] == ["key_missing"] and len(found) == 5


def test_keyed_store_writes_in_chunks_and_replaces(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = "conversation_id string, category string, batch int"
    load = lambda ids, c: spark.createDataFrame([(f"c{i}", c, i) for i in ids], schema).coalesce(1)
    keyed_store.upsert(load(range(1000), "old"), path, "conversation_id")
    keyed_store.upsert(load(range(900, 1300), "new"), path, "conversation_id")
    keyed_store.upsert(load(range(900, 1300), "new"), path, "conversation_id")
    written = keyed_store.manifests(path)
    assert [m["rows"] for m in written] == [1000, 400, 400] and [m["version"] for m in written] == [0, 1, 2]
    assert written[0]["chunks"] >= 3
    out = keyed_store.read_store(spark, path, spark.createDataFrame([], schema).schema, "conversation_id").collect()
    assert Counter(r["category"] for r in out) == {"old": 900, "new": 400} and len({r["conversation_id"] for r in out}) == 1300


def test_chunks_of_400_with_a_short_last_one(tmp_path):
    writer = keyed_store._Writer(str(tmp_path / "s"), ["k"], 400)
    done = writer.write((str(i),) for i in range(1000))
    assert (done.rows, done.chunks) == (1000, 3)
    assert keyed_store.manifests(str(tmp_path / "s")) == []  # nothing is committed yet
    writer.abort([done, None])
    assert not [f for f in os.listdir(tmp_path / "s") if f.endswith(".json")]
    done = writer.write((str(i),) for i in range(3))
    writer.commit([done, None])
    with open(tmp_path / "s" / done.file) as file:
        assert [json.loads(line)["k"] for line in file] == ["0", "1", "2"]


def test_a_failed_write_is_never_read(spark, tmp_path):
    path, schema = str(tmp_path / "store"), "k string, v int"
    keyed_store.upsert(spark.createDataFrame([("a", 1)], schema), path, "k")
    fails = F.when(F.col("k") == "b", F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("int")
    broken = spark.createDataFrame([("a", 2), ("b", 2)], schema).select("k", fails.alias("v"))
    with pytest.raises(Exception, match="broken"):
        keyed_store.upsert(broken, path, "k")
    out = keyed_store.read_store(spark, path, spark.createDataFrame([], schema).schema, "k")
    assert [tuple(r) for r in out.collect()] == [("a", 1)]
