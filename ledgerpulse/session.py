"""Session for local runs (tests, bench). On a cluster the caller brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "ledgerpulse", memory: str = "16g") -> SparkSession:
    """Session on this machine, with as many shuffle partitions as cores.

    Nothing here is needed for correctness: operators read no settings but
    ``spark.checkpoint.dir`` and leave join strategy, partition sizes and skew
    splitting to adaptive execution.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
