"""Near duplicates by many universal hash minima, banded, with links confirmed on the full sets.

A document is its set of distinct shingles of five words, as 64-bit hashes. ``n_hashes`` functions
``a * x + b`` modulo 2^32 give as many minima; runs of ``rows`` of them are the bands. Two documents whose
sets overlap by the threshold share at least one band but for a chance of ``MISS``; as many bands as that
takes, and as many rows per band as ``MOST_HASHES`` allows, are used, which keeps the buckets
small even where many documents share half of their text.

Documents with the same set are one class from the start. Classes that share a band are compared, first by
128 minima (a pair whose minima agree far less than the threshold asks for is not one), then exactly:
the sets of the documents left are made once more and intersected. Components come from alternating
large-star and small-star.

A bucket is tried as a star first. Where it leaves several components, as among many edited copies of one
text that are all a little too far apart, its documents are paired by the prefix rule instead of with each other: with
the shingles of each in one order, rarest first, two sets that overlap by the threshold share one among
the first of either, and the rare ones are just those that edits made. That rule is exact.

Defined results: a null or empty text, or one without words, has no shingles, links with nothing and is
kept. Texts of one to four words have one shingle, the whole sequence. Rows that share an id each come
back. Rows without an id belong to the component of their class through other rows that have one; a class without
any id links with nothing. Ties cannot arise: the smallest id stays. Other columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.llm.bloom import row_hashes, sieve, sifted
from ledgerpulse.llm.common import arrow_map, keyed_join, mix64, text_key, utf8
from ledgerpulse.llm.components import labelled
from ledgerpulse.llm.linking import link_buckets, shared_members
from ledgerpulse.sources.workspace import materialize

SHINGLE = 5
#: Chance that a pair just at the threshold shares no band.
MISS = 1e-7
MOST_HASHES = 768
#: Minima kept for the first look at a pair.
LOOK = 128
_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_RNG = np.random.Generator(np.random.PCG64(424242))
_FACTORS = _RNG.integers(1, 1 << 64, SHINGLE, dtype=np.uint64) | np.uint64(1)
_A = (_RNG.integers(0, 1 << 32, MOST_HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _RNG.integers(0, 1 << 32, MOST_HASHES, dtype=np.uint64).astype(np.uint32)
_BAND = _RNG.integers(1, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)
#: Shingles whose hashes are made at once: with MOST_HASHES functions they stay in a core's cache.
_SPAN = 256


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < SHINGLE:
        whole = np.uint64(len(words)) + (h * _FACTORS[: len(h)]).sum(dtype=np.uint64)
        return mix64(np.array([whole], np.uint64))
    n = len(words) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        total += h[i : i + n] * _FACTORS[i]
    return np.unique(mix64(total))


def banding(threshold: float) -> tuple[int, int]:
    """Number of bands and rows per band."""
    best = (1, 1)
    for rows in range(1, 33):
        bands = int(np.ceil(np.log(MISS) / np.log1p(-(threshold**rows))))
        if bands * rows > MOST_HASHES:
            break
        best = (bands, rows)
    return best


def minima(hashes: np.ndarray, n: int) -> np.ndarray:
    """The smallest value of each of ``n`` universal hash functions over a set that is not empty."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    room = np.empty((min(_SPAN, len(x)), n), np.uint32)
    for at in range(0, len(x), _SPAN):
        part = x[at : at + _SPAN, None]
        values = room[: len(part)]
        np.multiply(part, _A[None, :n], out=values)
        values += _B[None, :n]
        np.minimum(out, np.minimum.reduce(values, axis=0), out=out)
    return out


def band_keys(low: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band."""
    table = low[: bands * rows].reshape(bands, rows).astype(np.uint64)
    return mix64((table * _BAND[:rows]).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def least_agreement(threshold: float) -> int:
    """Minima out of ``LOOK`` that a pair at the threshold agrees on, less seven standard deviations."""
    return int(LOOK * threshold - 7 * (LOOK * threshold * (1 - threshold)) ** 0.5)


def _described(docs: DataFrame, key: str, bands: int, rows: int) -> DataFrame:
    """Per row: set size, digest of the set, first minima, band keys."""

    def describe(batch: pa.RecordBatch) -> dict:
        sets = [shingles(t) for t in utf8(batch.column("text"))]
        low = [minima(s, max(LOOK, bands * rows)) if len(s) else None for s in sets]
        return {
            "id": batch.column("id"),
            "own": batch.column("own"),
            "n": [len(s) for s in sets],
            "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
            "look": [None if x is None else x[:LOOK].astype(np.uint16).tobytes() for x in low],
            "bands": [None if x is None else band_keys(x, bands, rows).view(np.int64) for x in low],
        }

    return arrow_map(
        docs.select(F.col(key).cast("bigint").alias("id"), text_key("text").alias("own"), "text"), describe,
        "id bigint, own bigint, n bigint, digest binary, look binary, bands array<bigint>",
    )


def _agreeing(pairs: DataFrame, looks: DataFrame, least: int) -> DataFrame:
    """Pairs whose first minima agree often enough."""
    for end in ("a", "b"):
        pairs = keyed_join(pairs, looks.select(F.col("id").alias(end), F.col("look").alias(f"look_{end}")), [end])

    def kept(batch: pa.RecordBatch) -> dict:
        a, b = (np.frombuffer(b"".join(batch.column(f"look_{e}").to_pylist()), np.uint16).reshape(-1, LOOK) for e in "ab")
        ok = pa.array((a == b).sum(axis=1) >= least)
        return {e: batch.column(e).filter(ok) for e in "ab"}

    return arrow_map(pairs.select("a", "b", "look_a", "look_b"), kept, "a bigint, b bigint")


def _overlapping(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union."""
    for end in ("a", "b"):
        pairs = keyed_join(pairs, sets.select(F.col("id").alias(end), F.col("set").alias(f"set_{end}")), [end])

    def kept(batch: pa.RecordBatch) -> dict:
        ok = []
        for a, b in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            small, large = sorted((len(x), len(y)))
            both = 0
            if 100 * small >= percent * large:
                both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= percent * (small + large - both))
        return {e: batch.column(e).filter(pa.array(ok)) for e in "ab"}

    return arrow_map(pairs.select("a", "b", "set_a", "set_b"), kept, "a bigint, b bigint")


def _sets_of(docs: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``id`` and ``set`` (sorted hashes as bytes) of the documents in ``ids``, made from their texts."""
    wanted = docs.sparkSession.sparkContext.broadcast(sieve(ids.select(*row_hashes("id"))))
    rows = docs.select(F.col(key).cast("bigint").alias("id"), "text", *row_hashes(F.col(key).cast("bigint")))

    def made(batch: pa.RecordBatch) -> dict | None:
        h = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("h1", "h2")])
        at = np.flatnonzero(wanted.value.passes(h))
        if not len(at):
            return None
        texts = utf8(batch.column("text").take(pa.array(at)))
        return {"id": batch.column("id").take(pa.array(at)), "set": [shingles(t).tobytes() for t in texts]}

    return keyed_join(arrow_map(rows, made, "id bigint, set binary"), ids, ["id"], "left_semi")


def near_duplicates(docs: DataFrame, key: str = "doc_id", percent: int = 80) -> DataFrame:
    """One row per document: ``key``, ``n_shingles``, ``component_id``, ``kept`` and ``own`` (hash of the text).

    Links are pairs whose sets overlap by ``percent`` of their union; a bigint (or int) ``key``.
    """
    bands, rows = banding(percent / 100)
    described = materialize(_described(docs, key, bands, rows), "described")
    known = described.filter("n > 0")
    classes = materialize(known.groupBy("digest").agg(F.min("id").alias("class")), "classes")
    own = classes.select("digest", F.col("class").alias("id"))
    # One row per class: its smallest id, met again by digest and id, which spreads copies evenly.
    heads = known.join(own, ["digest", "id"], "left_semi")
    members = heads.select(F.explode("bands").alias("bucket"), "id")
    shared = materialize(shared_members(members), "shared")
    ids = materialize(shared.select("id").distinct(), "ids")
    looks = materialize(keyed_join(heads.select("id", "look"), ids, ["id"], "left_semi").dropDuplicates(["id"]), "looks")
    sets = materialize(_sets_of(docs, key, ids).dropDuplicates(["id"]), "sets")
    confirm = _confirm(looks, sets, percent)
    components = link_buckets(shared, confirm, lambda open_: _prefix_pairs(open_, sets, percent))
    placed = labelled(classes.filter("class IS NOT NULL"), components, "class")
    joined = keyed_join(described.select("id", "own", "n", "digest"), placed.select("digest", "component"), ["digest"], "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"), "own",
    )


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", percent: int = 80) -> DataFrame:
    """The documents of which one per component stays; rows that repeat id and text stay or go together."""
    judged = near_duplicates(docs, key, percent).filter("NOT kept").select(F.col(key).alias("id"), "own")
    dropped = materialize(judged.distinct(), "dropped")
    spots = [F.col(key).cast("bigint"), text_key("text")]
    clear, perhaps = sifted(docs, spots, dropped)
    same = (spots[0] == dropped["id"]) & (spots[1] == dropped["own"])
    return clear.unionByName(perhaps.join(dropped, same, "left_anti"))


def _prefix_pairs(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``open_`` in different components that could overlap by ``percent``.

    Of ``n`` shingles the first ``n - ceil(percent * n / 100) + 1`` are looked at, rarest first. A shingle that two
    sets share at places ``pa`` and ``pb`` counts only if what follows in both is enough for the
    overlap, which holds for the first one shared by any pair that qualifies.
    """
    ids = materialize(open_.select("id", "component").distinct(), "openids")

    def listed(batch: pa.RecordBatch) -> dict:
        own = [np.frombuffer(x, np.int64) for x in batch.column("set").to_pylist()]
        at = np.repeat(np.arange(len(own)), [len(x) for x in own])
        columns = {c: batch.column(c).take(pa.array(at)) for c in ("id", "component")}
        sizes = np.array([len(x) for x in own], np.int64)
        return columns | {"size": sizes[at] if len(own) else [], "shingle": np.concatenate([np.zeros(0, np.int64), *own])}

    rows = materialize(
        arrow_map(keyed_join(ids, sets, ["id"]), listed, "id bigint, component bigint, size bigint, shingle bigint"), "listed"
    )
    common = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    # Shingles of one text only come first in the order but pair with nothing: they are counted, not kept.
    known = keyed_join(rows, common, ["shingle"])
    held = known.groupBy("id").agg(F.count(F.lit(1)).alias("shared"))
    placed = keyed_join(known, held, ["id"]).withColumn(
        "place", F.col("size") - F.col("shared") + F.row_number().over(Window.partitionBy("id").orderBy("texts", "shingle"))
    )
    first = materialize(placed.filter(f"place <= size - ceil({percent} * size / 100.0) + 1"), "prefixes")
    left, right = (
        first.select("shingle", F.col("id").alias(x), F.col("component").alias(f"c{x}"), F.col("size").alias(f"n{x}"), F.col("place").alias(f"p{x}"))
        for x in "ab"
    )
    fits = f"a > b AND ca <> cb AND {100 + percent} * (least(na - pa, nb - pb) + 1) >= {percent} * (na + nb)"
    return keyed_join(left, right, ["shingle"]).filter(fits).select("a", "b").distinct()


def _confirm(looks: DataFrame, sets: DataFrame, percent: int) -> Callable[[DataFrame], DataFrame]:
    def confirm(pairs: DataFrame) -> DataFrame:
        likely = materialize(_agreeing(pairs, looks, least_agreement(percent / 100)), "likely")
        return _overlapping(likely, sets, percent)

    return confirm
