"""Connected components by alternating large-star and small-star.

Large-star moves every larger neighbour of a node to the node's smallest neighbour (itself included);
small-star moves the node and its smaller neighbours to the smallest of them. Repeated in turn they end in one star
per component, round its smallest node, after a number of rounds that grows with the logarithm of
the size. The smallest neighbour of a node is an aggregate, with map-side combination, that is joined
back, so no node's neighbourhood is ever gathered in one place. Each round is written to the shared
folder; only a count and a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import keyed_join
from ledgerpulse.sources.workspace import drop_stored, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("lo").alias("node"), F.col("hi").alias("next")).unionByName(
        edges.select(F.col("hi").alias("node"), F.col("lo").alias("next"))
    )
    least = both.groupBy("node").agg(F.min("next").alias("least"))
    moved = keyed_join(edges.withColumnRenamed("lo", "node"), least, ["node"])
    return moved.select("hi", F.least("node", "least").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    moved = keyed_join(edges, least, ["hi"])
    ends = F.explode(F.array(F.col("hi"), F.col("lo"))).alias("hi")
    return moved.select(ends, F.col("least").alias("lo")).filter("hi <> lo").distinct()


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of ``links`` (``a``, ``b``) but the smallest.

    Links may repeat, point either way or to themselves; null ends are left out. Without links the
    result is empty.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges = materialize(edges, "edges")
    before = _checksum(edges)
    while before[0]:
        last, edges = edges, materialize(_small_star(_large_star(edges)), "edges")
        drop_stored(last)
        after = _checksum(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))


def labelled(rows: DataFrame, components: DataFrame, key: str, out: str = "component") -> DataFrame:
    """``rows`` with the component of ``key``; a row without links is its own."""
    joined = keyed_join(rows, components.select(F.col("node").alias(key), F.col("component").alias(out)), [key], "left")
    return joined.withColumn(out, F.coalesce(out, key))
