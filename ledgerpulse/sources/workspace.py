"""Stored intermediates in the folder the cluster shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_root: str | None = None
_owner: ContextVar[str | None] = ContextVar("owner", default=None)
_owned: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only on one machine."""
    global _local_root
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="ledgerpulse-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/ledgerpulse/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    if _owner.get():
        _owned.setdefault(_owner.get(), []).append(path)
    return path


@contextmanager
def owner(name: str) -> Iterator[None]:
    """Paths made inside belong to ``name``, until `release` removes them."""
    token = _owner.set(name)
    try:
        yield
    finally:
        _owner.reset(token)


def release(spark: SparkSession, name: str, *still_read: DataFrame) -> int:
    """Remove what belongs to ``name``, unless one of ``still_read`` reads it; how many paths went.

    For callers whose results have been written: intermediates of a finished step only take disk.
    """
    if any(df.storageLevel.useMemory or df.storageLevel.useDisk for df in still_read):
        return 0  # a cached table may not have been read yet
    needed = {f.split(":", 1)[-1] for df in still_read for f in df.inputFiles()}
    kept, gone = [], 0
    for path in _owned.pop(name, []):
        plain = path.split(":", 1)[-1].lstrip("/")
        if any(plain in f for f in needed):
            kept.append(path)
        else:
            _remove(spark, path)
            gone += 1
    if kept:
        _owned[name] = kept
    return gone


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_stored(df: DataFrame) -> None:
    """Remove a table that `materialize` stored and that nothing will read again."""
    path = df.__dict__.pop("stored_at", None)
    if path:
        _remove(df.sparkSession, path)


def sweep(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that no one holds any more.

    It does so when the driver's collector finds them gone, which between two large steps may not have run yet.
    """
    spark._jvm.System.gc()


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage like a checkpoint, survives lost executors, and later
    readers still get column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["stored_at"] = path
    return out


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores if the files gave fewer tasks than there are cores.

    For work that is heavy per row. Tables with many files or row groups, as any
    large table has, are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, *keys: str, name: str = "dealt") -> DataFrame:
    """``df`` stored in even files, dealt out by a hash of ``keys``.

    For narrow columns that are read several times. A row group is one task however large it is, and the number of splits of a file
    does not tell how many row groups it has; so all rows are read once as the files lie, and from then on by all cores.
    """
    return materialize(df.repartition(F.xxhash64(*keys)), name)
