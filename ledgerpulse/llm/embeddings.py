"""Near-equal vectors through a pivot-permutation index, verified by cosine in double precision.

Reference points are taken from a bounded sample of the vectors and thinned until no two are alike, so a large
group of near-equal vectors has one of them, not many. Every vector is described by its ``nearest``
reference points in order of cosine; each of those has an inverted list of the vectors that name it. A pair is
retrieved if it shares at least ``shared`` reference points, and is handled in the list of the smallest one they
share, once. Lists are cut into blocks of bounded size, and a task compares two blocks of a list with one matrix
product, so a list that holds a large part of all vectors is spread over many tasks. Of
a pair of blocks come the number of links of every vector and a spanning forest of them, never the
pairs. Reference points limit what is found, not what is true: every link is verified on the full vectors.

Defined results: a vector that is null, empty, zero, or has null or non-finite components links with nothing,
and neither does one of another length. Rows that repeat an id are one vector, the smallest of theirs in
array order, and share its result; rows without an id link with nothing. Exact copies link like any others.
Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import arrow_map, arrow_schema, keyed_join
from ledgerpulse.llm.components import connected_components
from ledgerpulse.sources.workspace import materialize

#: Vectors of a list that are compared with each other, or with another block's, in one task.
BLOCK = 1024
#: Fewest and most reference points, and candidates drawn for each of them.
FEWEST, MOST, DRAWN = 64, 8192, 4
#: Reference points are at most this alike (cosine).
APART = 0.6


def _units(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors of length one in double precision; None for those that link with nothing."""
    out = []
    for vector in column.to_pylist():
        v = np.array(vector if vector and None not in vector else [], dtype=np.float64)
        top = np.abs(v).max(initial=0.0)
        if not top or not math.isfinite(top):  # NaN is neither
            out.append(None)
            continue
        v /= top
        out.append(v / np.linalg.norm(v))
    return out


def reference_points(vectors: DataFrame, n: int, seed: int = 11) -> dict[int, np.ndarray]:
    """At most ``n`` unit vectors by length, from ``DRAWN * n`` vectors drawn by a hash of the id.

    A length without any in the sample has one list for all its vectors.
    """
    drawn = vectors.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(DRAWN * n).toArrow()
    found: dict[int, list[np.ndarray]] = {}
    for v in _units(drawn["embedding"].combine_chunks()):
        if v is None:
            continue
        own = found.setdefault(len(v), [])
        if len(own) < n and (not own or float(np.max(np.array(own) @ v)) < APART):
            own.append(v)
    return {size: np.array(own) for size, own in found.items()}


def describe(vectors: DataFrame, points: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """``vec_id``, ``embedding`` and ``near``: the numbers of the nearest reference points, nearest first.

    Vectors that can link with nothing are left out.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(points)

    def described(batch: pa.RecordBatch) -> dict:
        units = _units(batch.column("embedding"))
        at = [i for i, v in enumerate(units) if v is not None]
        near = {}
        for size in {len(units[i]) for i in at}:
            own = [i for i in at if len(units[i]) == size]
            reference = shared.value.get(size)
            if reference is None:
                near |= {i: [0] for i in own}
                continue
            cosines = np.array([units[i] for i in own]) @ reference.T
            order = np.argsort(-cosines, axis=1, kind="stable")[:, :nearest]
            near |= dict(zip(own, order.tolist()))
        rows = pa.array(at, pa.int64())
        return {c: batch.column(c).take(rows) for c in ("vec_id", "embedding")} | {"near": [near[i] for i in at]}

    return arrow_map(vectors, described, "vec_id bigint, embedding array<double>, near array<int>")


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Numbers of the links that join two trees when taken in order."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            out.append(i)
    return out


def compare_blocks(ids: np.ndarray, units: np.ndarray, near: np.ndarray, first: np.ndarray, point: int, shared: int, cosine: float, same: bool):
    """Links of this list between the rows in ``first`` and the others, or among all if ``same``: two arrays of ids."""
    left = np.flatnonzero(first)
    right = left if same else np.flatnonzero(~first)
    table = units[left] @ units[right].T
    if same:
        table[np.tril_indices(len(left))] = -1.0
    x, y = np.nonzero(table >= cosine)
    kept = []
    for at in range(0, len(x), 1 << 14):
        p, q = near[left[x[at : at + (1 << 14)]]], near[right[y[at : at + (1 << 14)]]]
        meets = (p[:, :, None] == q[:, None, :]).any(axis=2) & (p >= 0)
        least = np.where(meets, p, 1 << 30).min(axis=1)
        kept.append((least == point) & (meets.sum(axis=1) >= np.minimum(shared, (p >= 0).sum(axis=1))))
    ok = np.concatenate(kept) if kept else np.zeros(0, bool)
    return ids[left[x[ok]]], ids[right[y[ok]]]


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9, nearest: int = 8, shared: int = 2
) -> DataFrame:
    """One row per row: ``key``, ``n_links``, ``component_id`` and ``kept``; ``key`` is a bigint (or int).

    The number of reference points grows with the square root of the number of vectors.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"))
    own = rows.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    own = materialize(own, "vectors")
    n = own.count()
    points = reference_points(own, min(MOST, max(FEWEST, 4 * math.isqrt(n))))
    described = materialize(describe(own, points, nearest), "described")
    listed = described.select("vec_id", "embedding", "near", F.size("embedding").alias("length"), F.explode("near").alias("point"))
    # One row per reference point and length: bounded by MOST and the lengths in use.
    counts = listed.groupBy("length", "point").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    counts = materialize(counts, "lists")
    block = F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.col("blocks")).cast("int")
    placed = listed.join(counts, ["length", "point"]).withColumn("block", block)
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "vec_id", "embedding", "near", "length", "point", "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )
    schema = "vec_id bigint, links bigint, other bigint"
    target = arrow_schema(schema)

    def compare(table: pa.Table) -> pa.Table:
        ids = table["vec_id"].to_numpy()
        units = np.array(_units(table["embedding"].combine_chunks()))
        lists = table["near"].to_pylist()
        width = max(map(len, lists))
        near = np.array([x + [-1] * (width - len(x)) for x in lists])
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        a, b = compare_blocks(
            ids, units, near, table["block"].to_numpy() == low, table["point"][0].as_py(), shared, cosine, low == high
        )
        linked, counts = np.unique(np.concatenate([a, b]), return_counts=True)
        tree = _forest(a, b)
        out = {
            "vec_id": np.concatenate([linked, a[tree]]),
            "links": np.concatenate([counts, np.zeros(len(tree), np.int64)]),
            "other": pa.array([None] * len(linked) + b[tree].tolist(), pa.int64()),
        }
        return pa.table(out, schema=target)

    found = materialize(dealt.groupBy("length", "point", "low", "high").applyInArrow(compare, schema), "found")
    links = found.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    components = connected_components(found.filter("other IS NOT NULL").select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    result = links.join(components.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    out = keyed_join(rows.select("vec_id"), result, ["vec_id"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        F.col("vec_id").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
