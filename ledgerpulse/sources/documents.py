"""Classified rows as flat documents: shape, stage, load back, upsert, look up."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import batched
from typing import Any, Protocol

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..functions.numeric import round_half_even
from ..functions.ordering import global_rank
from . import schemas


class DocumentClient(Protocol):
    """What a keyed store has to offer; ``commit`` must set documents by key."""

    def commit(self, documents: list[tuple[Any, dict]]) -> None: ...

    def close(self) -> None: ...


def to_documents(classified: DataFrame, order_by: str, key: str) -> DataFrame:
    """One document per classified row, numbered from zero by (``order_by``, ``key``)."""
    numbered = global_rank(classified, order_by, key, "_rank")
    return numbered.select(
        F.format_string("conv_%06d", F.col("_rank") - 1).alias("conversation_id"),
        F.col("text").alias("utterance"),
        F.col("intent_name").alias("true_intent"),
        "category",
        F.col("pred").alias("predicted_intent"),
        round_half_even("confidence", 4).alias("confidence"),
        F.col("correct").cast("boolean").alias("is_correct"),
        F.col("batch").cast("int").alias("batch"),
    )


def flatten_documents(documents: DataFrame) -> DataFrame:
    """Documents as the typed relational table."""
    return documents.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.CONVERSATIONS.fields]
    )


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON object per line; NULL fields are written, not dropped."""
    documents.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def newest_per_key(df: DataFrame, key: str, order_by: str | None = None) -> DataFrame:
    """One row per key: the last by ``order_by``, then by content.

    An aggregate rather than a window, so copies of a hot key are folded before
    the shuffle.
    """
    rest = [c for c in df.columns if c != key]
    ranked = ([order_by] if order_by else []) + [c for c in rest if c != order_by]
    best = df.groupBy(key).agg(F.max(F.struct(*ranked)).alias("_row"))
    return best.select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def upsert_documents(
    df: DataFrame,
    key: str,
    client_factory: Callable[[], DocumentClient],
    chunk: int = 400,
    order_by: str | None = None,
) -> None:
    """Set every row under its key, ``chunk`` rows per commit, each task on its own.

    A task that is run again sets the same documents again, which changes nothing.
    """

    def send(rows: Iterator[Row]) -> None:
        client = client_factory()
        try:
            for part in batched(rows, chunk):
                client.commit([(row[key], row.asDict()) for row in part])
        finally:
            client.close()

    newest_per_key(df, key, order_by).foreachPartition(send)


def low_confidence(documents: DataFrame, below: float = 0.5, n: int = 5) -> DataFrame:
    """The ``n`` least certain documents under the limit."""
    return documents.filter(F.col("confidence") < below).orderBy("confidence", "conversation_id").limit(n)


def misclassified_count(documents: DataFrame) -> DataFrame:
    return documents.filter(~F.col("is_correct")).agg(F.count(F.lit(1)).alias("misclassified"))
