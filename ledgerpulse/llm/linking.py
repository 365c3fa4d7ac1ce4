"""Links among the members of buckets, enough of them to give the components of all links.

Two rows are a candidate pair if they share a bucket. Only components are wanted, so a bucket is first
tried as a star, every member against its smallest: that is linear in the members. Most buckets are
one component after that. What is left are pairs whose ends share a bucket but are still in different
components; all of them are candidates, unless the caller has a sharper exact rule, so no link between
components is lost. Pairs within a component cannot change the result. Bucket sizes and centres are aggregates joined back, so a bucket that
holds a large part of all rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import arrow_schema, keyed_join
from ledgerpulse.llm.components import connected_components, labelled
from ledgerpulse.sources.workspace import drop_stored, materialize

#: Rows of one bucket that a task holds while it sorts buckets out.
_HELD = 1 << 16
#: Rows of a bucket up to which all are tried against all while it passes by.
_TRIED = 32


def shared_members(members: DataFrame) -> DataFrame:
    """``bucket``, ``id`` and ``centre`` (smallest id) for the buckets with more than one id."""
    centres = (
        members.groupBy("bucket").agg(F.min("id").alias("centre"), F.max("id").alias("last")).filter("centre < last")
        .select("bucket", "centre")
    )
    return keyed_join(members, centres, ["bucket"])


def sorted_members(members: DataFrame, more: str, close: Callable[[pa.Table, pa.Table], np.ndarray]) -> DataFrame:
    """The same from one shuffle, for members with further columns ``more`` (a schema in words).

    Members are sorted over all partitions by bucket and id, so a large bucket lies in several; the centre of a member is
    the first of its bucket in its own partition. ``close`` says for rows side by side whether they could be a
    pair; a member that is close to no other of its bucket is left out where the bucket is small enough to
    tell. The first and last bucket of a partition are kept whole, as others of theirs may lie next door.
    """
    names = ["bucket", "id", *(c.split()[0] for c in more.split(", "))]
    target = arrow_schema(f"bucket bigint, id bigint, {more}, centre bigint")

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: pa.Table | None = None  # rows whose bucket may go on
        first = True
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if pending is not None:
                table = pa.concat_tables([pending, table])
            bucket = table["bucket"].to_numpy()
            # The centre of the open bucket stands for its earlier rows.
            cut = int(np.searchsorted(bucket, bucket[-1], "left")) if len(bucket) else 0
            made = _centred(table.slice(0, cut), first, False, close)
            if cut:
                yield from made.cast(target).to_batches()
                first = False
            pending = table.slice(cut)
            if len(pending) > _HELD:  # a bucket larger than that gives its rows away with the centre known so far
                yield from _centred(pending, True, True, close).cast(target).to_batches()
                pending, first = pending.slice(0, 1), True  # what is left of it is kept whole
        if pending is not None and len(pending):
            yield from _centred(pending, first, True, close).cast(target).to_batches()

    ordered = members.select(*names).repartitionByRange("bucket", "id").sortWithinPartitions("bucket", "id")
    return ordered.mapInArrow(gathered, f"bucket bigint, id bigint, {more}, centre bigint")


def _centred(table: pa.Table, first: bool, last: bool, close: Callable[[pa.Table, pa.Table], np.ndarray]) -> pa.Table:
    """Rows of sorted buckets with their first id, without those that are close to none of their bucket.

    Buckets of more than ``_TRIED`` rows, and the first and last if asked for, are kept whole.
    """
    bucket, ids = table["bucket"].to_numpy(), table["id"].to_numpy()
    n = len(bucket)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, n])
    keep = np.repeat(sizes > _TRIED, sizes)
    for step in range(1, min(_TRIED, max(sizes, default=1))):
        here = np.flatnonzero((bucket[step:] == bucket[:-step]) & (ids[step:] != ids[:-step]))
        if not len(here):
            break
        near = here[close(table.take(pa.array(here)), table.take(pa.array(here + step)))]
        keep[near] = keep[near + step] = True
    if n:
        keep[: sizes[0]] |= first
        keep[n - sizes[-1] :] |= last
    table = table.filter(pa.array(keep))
    bucket, ids = table["bucket"].to_numpy(), table["id"].to_numpy()
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    centre = np.repeat(ids[starts], np.diff(np.r_[starts, len(bucket)]))
    return table.append_column("centre", pa.array(centre, pa.int64()))


def cross_pairs(open_: DataFrame) -> DataFrame:
    """Pairs (``a`` > ``b``) that share a bucket but no component; those with the centre were tried before."""
    left = open_.select("bucket", F.col("id").alias("a"), F.col("component").alias("ca"))
    right = open_.filter("id > centre").select("bucket", F.col("id").alias("b"), F.col("component").alias("cb"))
    return keyed_join(left, right, ["bucket"]).filter("a > b AND ca <> cb").select("a", "b").distinct()


def link_buckets(
    shared: DataFrame, confirm: Callable[[DataFrame], DataFrame], rest: Callable[[DataFrame], DataFrame] = cross_pairs
) -> DataFrame:
    """Components (``node``, ``component``) of the pairs that ``confirm`` keeps of candidates ``a``, ``b`` (a > b).

    ``shared`` is a stored result of ``shared_members``, which is removed once it has been read, as is all that is stored on the way:
    these are rows of all buckets, several times the result. ``rest`` makes the candidates of the second
    round from the members (``bucket``, ``id``, ``centre``, ``component``) of buckets with several components.
    """
    # A centre may occur twice in a bucket that was given away in parts; pairs are distinct all the same.
    stars = shared.filter("id > centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct()
    stars = materialize(stars, "stars")
    links = materialize(confirm(stars), "links")
    drop_stored(stars)
    first = connected_components(links)
    marked = materialize(labelled(shared.distinct(), first, "id"), "marked")
    drop_stored(shared)
    mixed = (
        marked.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high").select("bucket")
    )
    open_ = materialize(keyed_join(marked, mixed, ["bucket"]), "open")
    drop_stored(marked)
    pairs = materialize(rest(open_), "pairs")
    drop_stored(open_)
    more = materialize(confirm(pairs), "links")
    drop_stored(pairs)
    components = connected_components(links.unionByName(more))
    drop_stored(links)
    drop_stored(more)
    return components
