"""Drift monitor over a stream of classified rows.

Statistics per tumbling event-time window, closed by a watermark; closed windows
go to a table and are judged against the mean of all earlier windows there. A
running mean over windows is no stream operation, hence the table. Windows that are still open can be judged
with them, from the rows after the newest closed one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.numeric import exact_percent, exact_ratio, flag
from ..operators.intents import running_baseline

STATS_SCHEMA = "window_start timestamp_ntz, n bigint, accuracy_pct double, avg_confidence double"


def read_documents(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """Classified documents (JSON lines) as they arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def window_stats(
    stream: DataFrame,
    event_time: str,
    correct: str = "correct",
    window: str = "1 day",
    watermark: str = "1 hour",
) -> DataFrame:
    """Rows, accuracy in percent and mean confidence per window; works on batches too.

    Zone-less times are taken as UTC for the windows, whatever the session zone.
    Rows later than the watermark allows are dropped, as for any closed window.
    The partial aggregate keeps one row per window and task, so a window that
    holds most of the rows is no bottleneck.
    """
    rows = F.count(F.lit(1))
    zone = F.current_timezone()
    start = F.to_utc_timestamp("_window.start", zone).cast("timestamp_ntz")
    return (
        stream.withColumn(event_time, F.from_utc_timestamp(F.col(event_time).cast("timestamp"), zone))
        .withWatermark(event_time, watermark)
        .groupBy(F.window(event_time, window).alias("_window"))
        .agg(
            rows.alias("n"),
            exact_percent(F.sum(flag(F.col(correct).cast("boolean"))), rows, 1).alias("accuracy_pct"),
            exact_ratio(F.sum("confidence"), F.count("confidence"), 3).alias("avg_confidence"),
        )
        .select(start.alias("window_start"), "n", "accuracy_pct", "avg_confidence")
    )


def start_monitor(
    stats: DataFrame, table_path: str, checkpoint: str, max_drop_pp: float = 5, **trigger: object
) -> StreamingQuery:
    """Append closed windows to ``table_path`` and their alerts to ``table_path + '_alerts'``.

    Each micro-batch owns a folder and overwrites it, so a batch that is run
    again after a failure leaves the same tables.
    """
    empty = stats.sparkSession.createDataFrame([], STATS_SCHEMA)
    empty.write.mode("ignore").parquet(f"{table_path}/batch_id=-1")  # a table to read before any window closes

    def merge(closed: DataFrame, batch_id: int) -> None:
        spark = closed.sparkSession
        closed.persist()
        if not closed.isEmpty():
            closed.coalesce(1).write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")
            fresh = judged(spark, table_path, max_drop_pp).join(closed.select("window_start"), "window_start", "left_semi")
            fresh.coalesce(1).write.mode("overwrite").parquet(f"{table_path}_alerts/batch_id={batch_id}")
        closed.unpersist()

    return (
        stats.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(merge)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def _closed(spark: SparkSession, table_path: str) -> DataFrame:
    stats = spark.read.schema(STATS_SCHEMA).parquet(table_path)
    return stats.select("window_start", "n", "accuracy_pct", "avg_confidence")


def open_windows(
    rows: DataFrame, table_path: str, event_time: str, correct: str = "correct", window: str = "1 day"
) -> DataFrame:
    """Statistics so far of the windows after the newest closed one, from the stream's rows read as a batch.

    The start is a literal, so only the newest rows are read.
    """
    newest = _closed(rows.sparkSession, table_path).agg(F.max("window_start").cast("string")).first()[0]
    if newest is not None:
        end = F.lit(newest).cast("timestamp_ntz") + F.expr(f"INTERVAL {window}")
        rows = rows.filter(F.col(event_time) >= end)
    return window_stats(rows, event_time, correct, window)


def judged(
    spark: SparkSession, table_path: str, max_drop_pp: float = 5, still_open: DataFrame | None = None
) -> DataFrame:
    """All closed windows, and the open ones if given, with running baseline and alert."""
    stats = _closed(spark, table_path).withColumn("closed", F.lit(True))
    if still_open is not None:
        stats = stats.unionByName(still_open.withColumn("closed", F.lit(False)))
    return running_baseline(stats, max_drop_pp, order="window_start")
