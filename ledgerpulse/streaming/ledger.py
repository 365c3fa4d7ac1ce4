"""Windows and the rows that came too late for them, from one stream.

A windowed aggregate drops rows behind the watermark without a trace. Here each micro-batch is split first: rows whose window
was closed by the watermark of the batches before go to a table of their own, the others are added to their windows, one
partial sum per window and task. What passes from one micro-batch to the next is a small file: the newest event time and the
sums of the open windows, which the watermark bounds. Everything a micro-batch writes carries its number and is overwritten if
it runs again, and it starts from the state its predecessor left, so a restart changes nothing.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from decimal import Decimal

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import exact_percent, exact_ratio, flag

WINDOWS = "window_start timestamp_ntz, n bigint, correct bigint, confidence decimal(38,6), confident bigint"
_COLUMNS = [c.split()[0] for c in WINDOWS.split(", ")]


class Ledger:
    """Tables under ``path``: ``closed`` windows, ``late`` rows, and the state of the last two micro-batches."""

    def __init__(self, path: str, event_time: str, hours: int = 24, watermark_minutes: int = 60, correct: str = "correct"):
        self.path, self.event_time, self.correct = path, event_time, correct
        self.window, self.delay = timedelta(hours=hours), timedelta(minutes=watermark_minutes)
        self._seconds = hours * 3600

    def _files(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if ":/" in self.path else (fs.LocalFileSystem(), self.path)

    def _states(self) -> dict[int, str]:
        files, root = self._files()
        found = files.get_file_info(fs.FileSelector(f"{root}/state", allow_not_found=True))
        return {int(i.base_name.removesuffix(".json")): i.path for i in found if i.base_name.endswith(".json")}

    def state(self, before: int | None = None) -> tuple[datetime | None, list[tuple]]:
        """Newest event time and open windows after the last micro-batch, or the last one with a smaller number."""
        states = {i: p for i, p in self._states().items() if before is None or i < before}
        if not states:
            return None, []
        with self._files()[0].open_input_stream(states[max(states)]) as stream:
            kept = json.loads(stream.read())
        opened = [(datetime.fromisoformat(w), n, c, Decimal(s), m) for w, n, c, s, m in kept["open"]]
        return kept["newest"] and datetime.fromisoformat(kept["newest"]), opened

    def _keep(self, batch_id: int, newest: datetime | None, opened: list[tuple]) -> None:
        files, root = self._files()
        files.create_dir(f"{root}/state", recursive=True)
        rows = [(w.isoformat(), n, c, str(s), m) for w, n, c, s, m in opened]
        with files.open_output_stream(f"{root}/state/{batch_id}.json") as out:
            out.write(json.dumps({"newest": newest and newest.isoformat(), "open": rows}).encode())
        for number, old in self._states().items():
            if number < batch_id - 1:
                files.delete_file(old)

    def _window_start(self) -> Column:
        since = F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{self.event_time}`)")
        return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=since - F.pmod(since, F.lit(self._seconds)))

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Split one micro-batch and add it to the tables."""
        spark = batch.sparkSession
        newest, opened = self.state(batch_id)
        rows = batch.withColumn("window_start", self._window_start())
        # Windows that end at the watermark or before it are closed.
        bound = newest - self.delay - self.window if newest else None
        late = F.col("window_start") <= F.lit(str(bound)).cast("timestamp_ntz") if bound else F.lit(False)
        rows = rows.withColumn("_late", F.coalesce(late, F.lit(False)))
        rows.persist()
        rows.filter("_late").drop("_late").write.mode("overwrite").parquet(f"{self.path}/late/batch_id={batch_id}")
        sums = rows.filter("NOT _late AND window_start IS NOT NULL").groupBy("window_start").agg(
            F.count(F.lit(1)).alias("n"), F.sum(flag(F.col(self.correct).cast("boolean"))).cast("bigint").alias("correct"),
            F.sum(F.col("confidence").cast("decimal(28,6)")).alias("confidence"), F.count("confidence").alias("confident"),
            F.max(self.event_time).alias("newest"),
        ).collect()  # one row per window of the micro-batch
        rows.unpersist()
        added = {w: (n, c, s, m) for w, n, c, s, m in opened}
        for r in sums:
            n, c, s, m = added.get(r["window_start"], (0, 0, Decimal(0), 0))
            added[r["window_start"]] = (n + r["n"], c + r["correct"], s + (r["confidence"] or Decimal(0)), m + r["confident"])
        newest = max([r["newest"] for r in sums] + ([newest] if newest else []), default=None)
        still = [(w, *x) for w, x in sorted(added.items()) if newest is None or w + self.window > newest - self.delay]
        done = [(w, *x) for w, x in sorted(added.items()) if (w, *x) not in still]
        if done:
            spark.createDataFrame(done, WINDOWS).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/closed/batch_id={batch_id}")
        self._keep(batch_id, newest, still)

    def start(self, rows: DataFrame, checkpoint: str, **trigger: object) -> StreamingQuery:
        spark = rows.sparkSession
        spark.createDataFrame([], WINDOWS).write.mode("ignore").parquet(f"{self.path}/closed/batch_id=-1")
        return (
            rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.merge)
            .trigger(**(trigger or {"processingTime": "1 minute"})).start()
        )

    def windows(self, spark: SparkSession) -> DataFrame:
        """Statistics of closed and open windows."""
        closed = spark.read.parquet(f"{self.path}/closed").select(*_COLUMNS, F.lit(True).alias("closed"))
        opened = spark.createDataFrame([Row(*w, False) for w in self.state()[1]], f"{WINDOWS}, closed boolean")
        return closed.unionByName(opened).select(
            "window_start", "n", exact_percent("correct", "n", 1).alias("accuracy_pct"),
            exact_ratio("confidence", "confident", 3).alias("avg_confidence"), "closed",
        )

    def late(self, spark: SparkSession) -> DataFrame:
        """The rows that came too late, with their window and micro-batch."""
        return spark.read.parquet(f"{self.path}/late")
