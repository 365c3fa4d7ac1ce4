"""Filter interaction audit: what each of five filters removes, in every order they can be applied in.

Every filter of every part keeps a posting list: the sorted places of the documents that fail it. A part is
cut into ranges of ids, at most `RANGE` documents each, so a part with a third of all documents is many
ranges on many tasks. Inside a range the union of the filters applied so far is a k-way merge that gallops
(doubling steps, then halving) over runs which one list holds alone, and a filter removes the difference of its own
list and that union. Ranges are disjoint, so sizes add up: per part, filter and set of earlier filters one row
per range is summed, and the 120 orders are read off those 80 sums.

Defined results: a null text counts as the empty text, which fails A only (and E, as a repeat). A null
source is the part ``''``, together with sources that are the empty string. A null id is neither smaller nor
larger than another: its row never fails E and makes no other row fail it. Rows that repeat an id count one
by one; equal texts under equal ids do not fail E. A label counts if any row of ``labels`` with the id has it.
Columns other than the id, part, text, quality and toxic are not read. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.llm.common import arrow_schema, keyed_join
from ledgerpulse.sources.workspace import materialize

#: Letters of the filters; bit i of a mask is the i-th letter.
FILTERS = "ABCDE"
#: Documents of a part whose posting lists are merged together.
RANGE = 65_536
_SUMS = "part string, filter int, before int, removed bigint, good_lost bigint, toxic_lost bigint"


def failures(text: Column) -> list[Column]:
    """Whether a text fails A (short), B (repetitive), C (capitals) and D (symbols)."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return [
        n_words < 200,
        100 * n_distinct < 50 * n_words,
        100 * capitals.cast("bigint") > 2 * F.char_length(text).cast("bigint"),
        text.rlike("[#$%&*|]"),
    ]


def flagged(docs: DataFrame, labels: DataFrame, key: str, part: str) -> DataFrame:
    """``part``, ``id``, ``failed`` (mask), ``good`` and ``toxic`` of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(failures(F.col("text")))), F.lit(0))
    rows = docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        mask.alias("failed"), F.sha2(text, 256).alias("content"),
    )
    rows = materialize(rows, "audit")
    first = rows.groupBy("content").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeat = F.when(F.col("id") > F.col("first"), 1 << FILTERS.index("E")).otherwise(0)
    rows = keyed_join(rows, first, ["content"], "left").select("id", "part", (F.col("failed") + repeat).alias("failed"))
    marks = labels.groupBy(F.col(key).alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    marked = keyed_join(rows, marks, ["id"], "left")
    return marked.select(
        "part", "id", "failed", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )


def gallop(ids: Sequence[int], start: int, bound: int) -> int:
    """First place from ``start`` on whose id is at least ``bound``."""
    step, end = 1, len(ids)
    while start + step < end and ids[start + step] < bound:
        start += step
        step *= 2
    return bisect_left(ids, bound, start, min(end, start + step + 1))


def union(lists: Sequence[Sequence[int]]) -> list[int]:
    """Sorted ids that any list holds."""
    heads = [(ids[0], i, 0) for i, ids in enumerate(lists) if ids]
    heapq.heapify(heads)
    out: list[int] = []
    while heads:
        head, i, at = heads[0]
        ids = lists[i]
        if len(heads) == 1:
            out += ids[at + 1 if out and out[-1] == head else at :]
            break
        if out and out[-1] == head:
            upto = at + 1
        else:
            bound = min(h[0] for h in heads[1:3])
            upto = gallop(ids, at, bound) if head < bound else at + 1
            out += ids[at:upto]
        if upto < len(ids):
            heapq.heapreplace(heads, (ids[upto], i, upto))
        else:
            heapq.heappop(heads)
    return out


def outside(ids: Sequence[int], others: Sequence[int]) -> int:
    """How many of ``ids`` are not among ``others``."""
    i = j = n = 0
    while i < len(ids) and j < len(others):
        if ids[i] < others[j]:
            upto = gallop(ids, i, others[j])
            n += upto - i
            i = upto
        elif ids[i] > others[j]:
            j = gallop(others, j, ids[i])
        else:
            i += 1
            j += 1
    return n + len(ids) - i


def range_sums(failed: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """Sizes of every difference (filter, earlier filters) of one range; filter -1 counts its documents."""
    bits = range(len(FILTERS))
    fails = [failed >> i & 1 == 1 for i in bits]
    posted = [[np.flatnonzero(f & also).tolist() for also in (True, good, toxic)] for f in fails]
    yield -1, 0, len(failed), int(good.sum()), int(toxic.sum())
    for size in bits:
        for earlier in combinations(bits, size):
            gone = union([posted[i][0] for i in earlier])
            for i in bits:
                if i not in earlier:
                    yield i, sum(1 << e for e in earlier), *(outside(ids, gone) for ids in posted[i])


def part_sums(rows: DataFrame) -> DataFrame:
    """Sizes per part, filter and set of earlier filters, summed over the ranges of the part.

    Rows are dealt out by ranges of (part, id); the number of the row in the stored table breaks ties, so
    rows without an id are dealt out as well.
    """
    target = arrow_schema(_SUMS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: str | None = None
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            sums = list(range_sums(*(np.concatenate(c) for c in zip(*held))))
            held.clear()
            columns = [pa.array([part] * len(sums), pa.string())]
            columns += [pa.array(c, f.type) for c, f in zip(zip(*sums), list(target)[1:])]
            return pa.RecordBatch.from_arrays(columns, schema=target)

        for batch in batches:
            parts = batch.column("part").to_pylist()
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("failed", "good", "toxic")]
            at = 0
            while at < len(parts):
                if held and (parts[at] != part or sum(len(h[0]) for h in held) >= RANGE):
                    yield flush()
                part = parts[at]
                upto = at + 1
                while upto < len(parts) and parts[upto] == part:
                    upto += 1
                held.append(tuple(c[at:upto] for c in columns))
                at = upto
        if held:
            yield flush()

    numbered = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "audit")
    order = ["part", "id", "row"]
    ranged = numbered.repartitionByRange(*order).sortWithinPartitions(*order).select("part", "failed", "good", "toxic")
    sums = ranged.mapInArrow(merge, _SUMS)
    return sums.groupBy("part", "filter", "before").agg(*[F.sum(c).alias(c) for c in ("removed", "good_lost", "toxic_lost")])


def audit_filters(docs: DataFrame, labels: DataFrame, key: str = "doc_id", part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step."""
    sums = materialize(part_sums(flagged(docs, labels, key, part)), "audit")
    steps = [
        ("".join(order), step, FILTERS.index(letter), sum(1 << FILTERS.index(e) for e in order[: step - 1]))
        for order in permutations(FILTERS)
        for step, letter in enumerate(order, 1)
    ]
    orders = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, filter int, before int")
    documents = sums.filter("filter = -1").select("part", F.col("removed").alias("documents"))
    placed = sums.filter("filter >= 0").join(F.broadcast(orders), ["filter", "before"]).join(documents, "part")
    upto = Window.partitionBy("part", "filter_order").orderBy("step")
    same = Window.partitionBy("part", "filter")
    removed, every = F.col("removed"), (1 << len(FILTERS)) - 1
    others = F.element_at(F.array(*[F.lit(every - (1 << i)) for i in range(len(FILTERS))]), F.col("filter") + 1)
    return placed.select(
        "part", "filter_order", "step",
        (F.col("documents") - F.sum(removed).over(upto)).alias("kept"), "removed",
        (F.max(F.when(F.col("before") == 0, removed)).over(same) - removed).alias("redundant"),
        F.max(F.when(F.col("before") == others, removed)).over(same).alias("unique_fails"),
        "good_lost", "toxic_lost", F.sum(removed).over(same).alias("shapley"),
    )
