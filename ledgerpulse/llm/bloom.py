"""Bloom filters over 128-bit hashes: sized, filled by Spark, tested in tasks."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import arrow_map, mix64

HASHES = "h1 bigint, h2 bigint"
#: Most bits of a sieve, whatever the number of keys (8 MB); beyond it only lets more through.
SIEVE_BITS = 1 << 26


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``n_bits`` bits, ``k`` hash functions told apart from other levels' by ``seed``."""

    n_bits: int
    k: int
    seed: int
    bits: np.ndarray | None = None

    @staticmethod
    def sized(n_keys: int, rate: float, seed: int) -> Level:
        bits = max(64, math.ceil(-n_keys * math.log(rate) / math.log(2) ** 2))
        return Level(-(-bits // 64) * 64, max(1, round(-math.log2(rate))), seed)

    def positions(self, h: np.ndarray) -> np.ndarray:
        a = mix64(h[:, 0] ^ np.uint64(self.seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        b = mix64(h[:, 1] + np.uint64(self.seed)) | np.uint64(1)
        steps = np.arange(self.k, dtype=np.uint64)
        return ((a[:, None] + steps * b[:, None]) % np.uint64(self.n_bits)).astype(np.int64)

    def passes(self, h: np.ndarray) -> np.ndarray:
        at = self.positions(h)
        return (self.bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).all(axis=1)


def hashed(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1)])


def filled(keys: DataFrame, level: Level) -> Level:
    """The level with the bits of ``keys``: words are OR-ed by Spark, only the finished words are collected."""

    def words(batch: pa.RecordBatch) -> dict:
        at = np.unique(level.positions(hashed(batch)).ravel())
        word, first = np.unique(at >> 6, return_index=True)
        masks = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first) if len(at) else at
        return {"word": word, "mask": masks.view(np.int64)}

    rows = arrow_map(keys, words, "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    bits = np.zeros(level.n_bits // 64, dtype=np.uint64)
    table = rows.toArrow()
    if table.num_rows:
        bits[table["word"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return Level(level.n_bits, level.k, level.seed, bits)


def passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def kept(batch: pa.RecordBatch) -> dict:
        ok = shared.value.passes(hashed(batch))
        return {f: batch.column(i).to_numpy(zero_copy_only=False)[ok] for i, f in enumerate(("h1", "h2"))}

    return arrow_map(keys, kept, HASHES)


def row_hashes(*columns: Column | str) -> list[Column]:
    """``h1`` and ``h2`` of a row's key."""
    return [F.xxhash64(*columns).alias("h1"), F.xxhash64(F.lit("again"), *columns).alias("h2")]


def sieve(keys: DataFrame) -> Level:
    """A filter of bounded size for ``keys`` (h1, h2), to thin out a table before it is joined with them.

    It lets every key through and others by chance, so the join that follows decides; with very many
    keys it lets more through, never less.
    """
    n = max(1, keys.count())
    bits = min(SIEVE_BITS, -(-12 * n // 64) * 64)
    return filled(keys, Level(bits, max(1, min(6, round(bits / n * math.log(2)))), 7))


def _passes(shared: Broadcast) -> Callable[..., Column]:
    @F.arrow_udf("boolean")
    def hit(h1: pa.Array, h2: pa.Array) -> pa.Array:
        h = np.column_stack([x.to_numpy(zero_copy_only=False).view(np.uint64) for x in (h1, h2)])
        return pa.array(shared.value.passes(h))

    return hit


def sifted(df: DataFrame, columns: list[Column], keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows whose ``columns`` cannot be among ``keys``, and the few that may be.

    ``keys`` has one column per entry of ``columns``, of the same type. The first part needs no join with them.
    """
    shared = df.sparkSession.sparkContext.broadcast(sieve(keys.select(*row_hashes(*keys.columns))))
    hashes = [h.alias(f"__h{i}") for i, h in enumerate(row_hashes(*columns), 1)]
    marked = df.select("*", *hashes).withColumn("__hit", _passes(shared)("__h1", "__h2")).drop("__h1", "__h2")
    return marked.filter("NOT __hit").drop("__hit"), marked.filter("__hit").drop("__hit")
