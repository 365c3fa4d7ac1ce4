"""The running baseline as keyed state: no closed window is read again.

Closed windows leave the windowed aggregate once. A stateful operator behind it keeps two numbers, the sum of the
accuracies of all closed windows (in tenths of a percent, so it is exact) and their count, and gives every window what came before it.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.numeric import exact_ratio

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_COLUMNS = "window_start timestamp_ntz, n bigint, accuracy_pct double, avg_confidence double"
_NAMES = tuple(c.split()[0] for c in _COLUMNS.split(", "))
SCHEMA = f"{_COLUMNS}, earlier_tenths bigint, earlier_windows bigint"


class RunningSums(StatefulProcessor):
    """Gives each closed window the sums of those before it; windows of one micro-batch go in order of time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._sums = handle.getValueState("sums", "tenths bigint, windows bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        tenths, windows = self._sums.get() if self._sums.exists() else (0, 0)
        for row in sorted(rows, key=lambda r: r["window_start"]):
            yield Row(**{c: row[c] for c in _NAMES}, earlier_tenths=tenths, earlier_windows=windows)
            tenths, windows = tenths + round(row["accuracy_pct"] * 10), windows + 1
        self._sums.update((tenths, windows))

    def close(self) -> None:
        pass


def with_sums(stats: DataFrame, by: Column | None = None) -> DataFrame:
    """Closed windows of a stream (`monitor.window_stats`) with the sums of the earlier ones, per ``by`` if given."""
    keyed = stats.withColumn("_series", F.lit(0) if by is None else by)
    return keyed.select("_series", *_NAMES).groupBy("_series").transformWithState(RunningSums(), SCHEMA, "Append", "None")


def judged(sums: DataFrame, max_drop_pp: float = 5) -> DataFrame:
    """Running baseline and alert from the sums of earlier windows; works on streams and tables."""
    windows = 10 * F.col("earlier_windows")
    fallen = F.col("earlier_tenths") - windows * F.col("accuracy_pct").cast("decimal(5,1)")
    return sums.select(
        "window_start", "n", "accuracy_pct", "avg_confidence", exact_ratio("earlier_tenths", windows, 1).alias("running_baseline"),
        F.when(windows > 0, fallen > F.lit(str(max_drop_pp)).cast("decimal(9,3)") * windows).alias("drift_alert"),
    )


def start(stats: DataFrame, path: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Append closed windows with their sums to the table at ``path``."""
    spark = stats.sparkSession
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)  # the provider that keeps state variables; a query takes it over when it starts
    try:
        return (
            with_sums(stats).writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 minute"})).start()
        )
    finally:
        spark.conf.set(_PROVIDER, before)


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def with_open(sums: DataFrame, still_open: DataFrame) -> DataFrame:
    """Closed windows, and the open ones with the sums of all that are before them."""
    newest = sums.agg(F.max_by(
        F.struct(
            (F.col("earlier_tenths") + F.round(10 * F.col("accuracy_pct")).cast("bigint")).alias("tenths"),
            (F.col("earlier_windows") + 1).alias("windows"),
        ), "window_start",
    ).alias("last")).first()["last"]
    tenths, windows = newest or (0, 0)
    rows = []
    for r in still_open.orderBy("window_start").collect():  # no more than the watermark spans
        rows.append((r["window_start"], r["n"], r["accuracy_pct"], r["avg_confidence"], tenths, windows))
        tenths, windows = tenths + round(r["accuracy_pct"] * 10), windows + 1
    opened = still_open.sparkSession.createDataFrame(rows, SCHEMA).withColumn("closed", F.lit(False))
    return sums.withColumn("closed", F.lit(True)).unionByName(opened)
