"""What the operators of this folder share: joins that a hot key cannot block, Arrow batches, row keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows of one Arrow batch that are worked on at once; bounds the memory of a Python worker.
STEP = 256
#: The same in bytes; a longer text is a step of its own.
STEP_BYTES = 4 << 20
#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = b" \t\n\x0b\x0c\r"


def keyed_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``on`` with a shuffle of its own for either side.

    A side that comes out of ``groupBy(on)`` is already dealt out by the key, and adaptive execution
    does not split a hot key in a partitioning it did not make for the join. One more key column, made
    from ``on``, asks for a fresh exchange on both sides, so that it does.
    """
    on = list(on)
    extra = "__again"
    salted = [df.withColumn(extra, F.xxhash64(*on)) for df in (left, right)]
    return salted[0].join(salted[1], [*on, extra], how).drop(extra)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow's form of a schema in words; needs a session, so it is made on the driver."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def _steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of few rows, and of few bytes unless a single row is larger."""
    per_row = max(1, batch.nbytes // max(1, batch.num_rows))
    step = max(1, min(STEP, STEP_BYTES // per_row))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def arrow_map(df: DataFrame, work: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """``mapInArrow`` of a function from a small batch to columns (lists or arrays) in the order of ``schema``."""

    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _steps(batch):
                made = work(part)
                if made is None:
                    continue
                columns = [
                    v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, type=f.type)
                    for v, f in ((made[f.name], f) for f in target)
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=target)
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of a column as bytes, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def text_key(text: Column | str) -> Column:
    """64 bits of the text; with the document's id it tells rows apart where ids repeat."""
    return F.xxhash64(F.col(text) if isinstance(text, str) else text)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads all bits (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    room = x >> np.uint64(30)
    x ^= room
    x *= np.uint64(0xBF58476D1CE4E5B9)
    np.right_shift(x, np.uint64(27), out=room)
    x ^= room
    x *= np.uint64(0x94D049BB133111EB)
    np.right_shift(x, np.uint64(31), out=room)
    x ^= room
    return x


def crc_residue(key: str, modulus: int) -> Column:
    """CRC-32 of the decimal text of ``key`` modulo ``modulus``; a missing key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(modulus).cast("bigint"))
