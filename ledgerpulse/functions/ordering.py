"""Exact global order without a single-task window.

A window with an ORDER BY and no PARTITION BY moves every row to one task. Two other ways:

* *Rows at a few ranks* (`rows_at_ranks`): tiles, quantile buckets, interpolated quantiles, splits. A mergeable
  quantile sketch (KLL) of every order, all in one aggregate, brackets each wanted rank; the next aggregate counts the rows of all
  brackets exactly and sketches them again, until the bracket of each rank is small; one read fetches those rows. A value that very
  many rows share becomes a bracket of its own, which goes on along the key. The table is never shuffled, and the buckets are then
  a comparison with literals. The list of brackets follows the number of wanted ranks, not the table.
* *A rank or running total for every row* (`global_rank`, `running_totals`): rows are dealt out by ranges of (value, key)
  and stored in order, which numbers them inside their range; the rows of each range are counted, and a rank is that number plus the
  rows of earlier ranges.

As with ``approxQuantile`` or an estimator's ``fit``, the search runs at once and brings a bounded number of rows to
the driver. The input is read a few times: hand over a stored table, or an expensive intermediate through
`sources.workspace.materialize`. Rows without a value are set aside: they are not counted, have no rank and no bucket. Values and
keys are numbers, dates or timestamps; the key is unique and not NULL.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import materialize

#: Rows of a bracket that are fetched instead of being cut again.
HELD = 4096
#: Size of a sketch, and the quantiles that are read off it.
SKETCH, GRID = 1024, 128


@dataclass(frozen=True)
class RankedRow:
    """The row found at ``rank`` (from 1) among the rows of ``group``."""

    group: object
    target: int
    rank: int
    n: int
    value: object
    key: object
    value_type: str


@dataclass(frozen=True)
class Order:
    """Rows ordered by (``value``, ``key``); ``ranks`` maps their number to the wanted ranks from 1.

    With ``key=None`` only values are wanted, in any order of equal ones. ``where`` names a column and the value it must have.
    """

    value: str
    ranks: Callable[[int], Sequence[int]]
    key: str | None = None
    where: tuple[str, object] | None = None


@dataclass
class _Cuts:
    """Points between the brackets of one order, in the code of the value, and of the key where the value is one point."""

    points: list[float] = field(default_factory=list)
    of_key: dict[float, list[float]] = field(default_factory=dict)


def _code(df: DataFrame, c: str) -> Column:
    """A double that never contradicts the order of ``c``."""
    type_ = df.schema[c].dataType.simpleString()
    if type_ == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{c}`)").cast("double")
    if type_ == "timestamp":
        return F.unix_micros(F.col(c)).cast("double")
    if type_ == "date":
        return F.unix_date(F.col(c)).cast("double")
    if type_ in ("string", "binary"):
        raise TypeError(f"{c}: only numbers, dates and timestamps can be ordered this way")
    return F.col(c).cast("double")


def _place(code: Column, points: Sequence[float]) -> Column:
    """Twice the number of points below ``code``, plus one if it is one of them; ``points`` ascend.

    A search tree, so a row is compared with few of the points.
    """

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(2 * low)
        mid = (low + high) // 2
        point = F.lit(float(points[mid]))
        return F.when(code < point, among(low, mid)).when(code == point, 2 * mid + 1).otherwise(among(mid + 1, high))

    return among(0, len(points))


def _bracketed(df: DataFrame, orders: Sequence[Order], cuts: Sequence[_Cuts]) -> DataFrame:
    """Every row once per order it takes part in, with its bracket (``_cell``, ``_sub``)."""
    columns = sorted({c for o in orders for c in (o.value, o.key) if c})
    # Codes are columns of their own, made once per row and not at every comparison.
    codes = {c: f"_code{i}" for i, c in enumerate(columns)}
    asked = sorted({o.where[0] for o in orders if o.where} - set(columns))
    coded = df.select(*columns, *asked, *[_code(df, c).alias(name) for c, name in codes.items()])
    entries = []
    for i, (order, cut) in enumerate(zip(orders, cuts)):
        code = F.col(codes[order.value])
        cell = _place(code, cut.points)
        sub, more = F.lit(0), code
        if order.key:
            key = F.col(codes[order.key])
            for point, points in cut.of_key.items():
                sub = F.when(code == F.lit(point), _place(key, points)).otherwise(sub)
            more = F.when(cell % 2 == 1, key).otherwise(code)
        known = F.col(order.value).isNotNull()
        if order.where:
            known = known & (F.col(order.where[0]) == F.lit(order.where[1]))
        entry = F.struct(F.lit(i).alias("_which"), cell.alias("_cell"), sub.alias("_sub"), more.alias("_code"))
        entries.append(F.when(known, entry))
    listed = coded.select(*columns, F.explode(F.array_compact(F.array(*entries))).alias("_at"))
    return listed.select(*columns, "_at.*")


def _counted(df: DataFrame, orders: Sequence[Order], cuts: Sequence[_Cuts]) -> list:
    """Rows of every bracket, whether they share one value, and quantiles of the code that cuts it further."""
    steps = F.array(*[F.lit(g / GRID) for g in range(GRID + 1)])
    # Values are compared as what they are: their text would cost more than all the rest.
    single = {c: F.min(c) == F.max(c) for c in sorted({o.value for o in orders})}
    of_order = F.lit(None).cast("boolean")
    for i, order in enumerate(orders):
        of_order = F.when(F.col("_which") == i, single[order.value]).otherwise(of_order)
    cells = _bracketed(df, orders, cuts).groupBy("_which", "_cell", "_sub").agg(
        F.count(F.lit(1)).alias("n"), of_order.alias("single"),
        F.kll_sketch_agg_double("_code", SKETCH).alias("sketch"),
        F.first(F.struct(*single)).alias("some"),
    )
    grid = F.when(F.kll_sketch_get_n_double("sketch") > 0, F.kll_sketch_get_quantile_double("sketch", steps))
    found = cells.select("_which", "_cell", "_sub", "n", "single", "some", grid.alias("grid")).collect()
    return sorted(found, key=lambda c: (c["_which"], c["_cell"], c["_sub"]))


def rows_at_ranks(df: DataFrame, orders: Sequence[Order], held: Callable[[int], int] | None = None) -> list[list[RankedRow]]:
    """The rows at the wanted ranks of each order, by position in its ``ranks``.

    All orders share the aggregates and the fetch. ``held`` maps the rows of an order to those of a bracket that are fetched.
    """
    held = held or _held(None)
    cuts = [_Cuts() for _ in orders]
    wanted: list[list[int]] = []
    sizes: list[int] = []
    while True:
        cells = _counted(df, orders, cuts)
        if not wanted:
            sizes = [sum(c["n"] for c in cells if c["_which"] == i) for i in range(len(orders))]
            wanted = [list(o.ranks(n)) if n else [] for o, n in zip(orders, sizes)]
        hits: dict[tuple, list[tuple[int, int]]] = {}
        known: dict[tuple, object] = {}
        refined = False
        for i, ranks in enumerate(wanted):
            before = 0
            for c in (c for c in cells if c["_which"] == i):
                inside = [(t, r) for t, r in enumerate(ranks) if before < r <= before + c["n"]]
                if inside:
                    place = (i, c["_cell"], c["_sub"])
                    hits[place] = [(t, r - before) for t, r in inside]
                    if c["single"] and orders[i].key is None:
                        known[place] = c["some"][orders[i].value]
                    elif c["n"] > held(sizes[i]) and _refine(cuts[i], orders[i], c, [r - before for _, r in inside]):
                        refined = True
                before += c["n"]
        if not refined:
            return _fetched(df, orders, cuts, hits, known, wanted, sizes)


def _refine(cut: _Cuts, order: Order, cell, ranks: Sequence[int]) -> bool:
    """Add the points that the sketch has next to each rank; False if the bracket cannot be cut further."""
    of_key = cell["_cell"] % 2 == 1
    if cell["grid"] is None or of_key and not (order.key and cell["single"]) or cell["_sub"] % 2 == 1:
        return False
    points = set()
    for rank in ranks:
        at = math.floor((rank - 0.5) / cell["n"] * GRID)
        points.update(cell["grid"][max(0, at - 1) : at + 3])
    have = cut.points if not of_key else cut.of_key.setdefault(cut.points[cell["_cell"] // 2], [])
    new = points - set(have)
    have[:] = sorted(set(have) | new)
    return bool(new)


def _fetched(df, orders, cuts, hits, known, wanted, sizes) -> list[list[RankedRow]]:
    """The rows of the brackets that hold a wanted rank; ``known`` has those of which only the value matters, and which share it."""
    found: list[list[RankedRow]] = [[] for _ in orders]
    rows: dict[tuple, list] = {}
    asked = [place for place in hits if place not in known]
    if asked:
        here = F.struct("_which", "_cell", "_sub").isin([F.struct(*[F.lit(x) for x in place]) for place in asked])
        for row in _bracketed(df, orders, cuts).filter(here).drop("_code").collect():
            rows.setdefault((row["_which"], row["_cell"], row["_sub"]), []).append(row)
    for place, ranks in hits.items():
        order = orders[place[0]]
        type_ = df.schema[order.value].dataType.simpleString()
        own = sorted(
            rows.get(place, []), key=lambda r: (r[order.value] != r[order.value], r[order.value], r[order.key] if order.key else 0)
        )
        for target, rank in ranks:
            value = known[place] if place in known else own[rank - 1][order.value]
            found[place[0]].append(RankedRow(
                order.where[1] if order.where else None, target, wanted[place[0]][target], sizes[place[0]], value,
                own[rank - 1][order.key] if order.key else None, type_,
            ))
    return [sorted(f, key=lambda r: r.target) for f in found]


def _held(cells: int | None) -> Callable[[int], int]:
    """Rows of a bracket if the order is to be cut into at least ``cells``."""
    return (lambda n: max(1, n // cells)) if cells else (lambda n: HELD)


def order_statistics(
    df: DataFrame, value: str, ranks: Callable[[int], Sequence[int]], key: str | None = None, cells: int | None = None
) -> list[RankedRow]:
    """`rows_at_ranks` of one order."""
    return rows_at_ranks(df, [Order(value, ranks, key)], _held(cells))[0]


def order_statistics_by(
    df: DataFrame, group: str, wanted: Mapping[object, tuple[int, Sequence[int]]], value: str, key: str, cells: int | None = None
) -> list[RankedRow]:
    """The same inside each group; ``wanted`` gives its size and ranks. Groups must be few."""
    orders = [Order(value, lambda n, ranks=ranks: ranks, key, (group, g)) for g, (_, ranks) in wanted.items()]
    found = rows_at_ranks(df, orders, _held(cells))
    return sorted((r for rows in found for r in rows), key=lambda r: r.target)


def _literal(x: object, type_: str) -> Column:
    """A collected value as a literal of its own type.

    A zone-less timestamp goes through text: as a Python object it would be
    taken for a time in the zone of the session.
    """
    return F.lit(str(x) if type_ == "timestamp_ntz" else x).cast(type_)


def after_cut(value: str, key: str, cut: RankedRow) -> Column:
    """Whether a row comes after the cut row in (value, key) order."""
    v, at = F.col(value), _literal(cut.value, cut.value_type)
    return (v > at) | ((v == at) & (F.col(key) > F.lit(cut.key)))


def bucket_by_cuts(value: str, key: str, cuts: Sequence[RankedRow]) -> Column:
    """Buckets 1..k: one more than the number of cut rows before the row."""
    above = [F.when(after_cut(value, key, c), 1).otherwise(0) for c in cuts]
    return F.when(F.col(value).isNotNull(), reduce(Column.__add__, above, F.lit(1)))


def ntile_ranks(n: int, tiles: int) -> list[int]:
    """Last rank of each tile but the last; the larger tiles come first."""
    # With fewer rows than tiles every rank past n falls on the last row.
    return [min(n // tiles * b + min(b, n % tiles), n) for b in range(1, tiles)]


def quantile_ranks(n: int, buckets: int) -> list[int]:
    """Rank of the last row at or below each inner quantile ``b / buckets``."""
    return [b * (n - 1) // buckets + 1 for b in range(1, buckets)]


def edge_ranks(n: int, buckets: int) -> list[int]:
    """The ranks on both sides of each inner quantile."""
    low = quantile_ranks(n, buckets)
    return low + [min(r + 1, n) for r in low]


def tile_order(value: str, key: str, tiles: int) -> Order:
    return Order(value, lambda n: ntile_ranks(n, tiles), key)


def quantile_order(value: str, key: str, buckets: int) -> Order:
    return Order(value, lambda n: quantile_ranks(n, buckets), key)


def edge_order(value: str, buckets: int) -> Order:
    return Order(value, lambda n: edge_ranks(n, buckets))


def ntile_global(df: DataFrame, value: str, key: str, tiles: int, out: str, cells: int | None = None) -> DataFrame:
    """``NTILE(tiles) OVER (ORDER BY value, key)``."""
    cuts = rows_at_ranks(df, [tile_order(value, key, tiles)], _held(cells))[0]
    return df.withColumn(out, bucket_by_cuts(value, key, cuts))


def ntiles_global(df: DataFrame, tiles: Mapping[str, tuple[str, str, int]]) -> DataFrame:
    """Several NTILEs in one search: ``{out: (value, key, tiles)}``."""
    found = rows_at_ranks(df, [tile_order(*t) for t in tiles.values()])
    return df.withColumns({out: bucket_by_cuts(v, k, cuts) for (out, (v, k, _)), cuts in zip(tiles.items(), found)})


def equal_freq(df: DataFrame, value: str, key: str, buckets: int, out: str, cells: int | None = None) -> DataFrame:
    """Quantile buckets 1..k of the rank: ``max(1, ceil(k * (rank - 1) / (n - 1)))``."""
    cuts = rows_at_ranks(df, [quantile_order(value, key, buckets)], _held(cells))[0]
    return df.withColumn(out, bucket_by_cuts(value, key, cuts))


def edges_between(rows: Sequence[RankedRow], buckets: int) -> list[float]:
    """The k - 1 inner quantiles, linearly interpolated between the rows at `edge_ranks`."""
    at = {r.target: r for r in rows}
    edges = []
    for i in range(buckets - 1 if at else 0):
        low, high = float(at[i].value), float(at[i + buckets - 1].value)
        share = (i + 1) * (at[i].n - 1) % buckets / buckets
        edges.append(low + (high - low) * share)
    return edges


def quantile_edges(df: DataFrame, value: str, buckets: int, cells: int | None = None) -> list[float]:
    """The k - 1 inner quantiles, linearly interpolated between neighbouring rows."""
    return edges_between(rows_at_ranks(df, [edge_order(value, buckets)], _held(cells))[0], buckets)


def bucket_by_edges(value: str, edges: Sequence[float]) -> Column:
    """Right-closed buckets 1..k: one more than the number of edges below the value."""
    above = [F.when(F.col(value).cast("double") > F.lit(e), 1).otherwise(0) for e in edges]
    return F.when(F.col(value).isNotNull(), reduce(Column.__add__, above, F.lit(1)))


def _ranged(df: DataFrame, order: Sequence[str], ranges: int | None) -> DataFrame:
    """``df`` stored in ranges of ``order``; ``_range`` and ``_at`` (from 0) number the rows.

    The key is part of the order, so a value that very many rows share is several ranges.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    stored = materialize(placed.withColumn("_id", F.monotonically_increasing_id()), "ranges")
    # The upper bits of the id are the task that wrote the row, the lower 33 its place there.
    return stored.select(*df.columns, F.shiftright("_id", 33).alias("_range"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_at"))


def _earlier(totals: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Sums over the earlier ranges; ``totals`` has one row per range."""
    upto = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_range", *[F.coalesce(F.sum(s).over(upto), F.lit(0)).alias(s) for s in sums])


def global_rank(df: DataFrame, value: str, key: str, out: str = "rank", cells: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY value, key)`` for every row; NULL for rows without a value, which are not moved."""
    ranged = _ranged(df.filter(F.col(value).isNotNull()), [value, key], cells)
    before = _earlier(ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_before")), ["_before"])
    # As many rows as there are ranges.
    ranked = ranged.join(F.broadcast(before), "_range").select(*df.columns, (F.col("_before") + F.col("_at") + 1).alias(out))
    unknown = df.filter(F.col(value).isNull()).withColumn(out, F.lit(None).cast("bigint"))
    return ranked.unionByName(unknown)


def rows_at_positions(df: DataFrame, key: str, positions: DataFrame, at: str = "position") -> DataFrame:
    """``positions`` with the row of ``df`` at each position (from 0, modulo the rows) in the order of ``key``.

    ``df`` is stored once in ranges of the key. The rows of each range are counted, which turns a position into a
    range and a place in it, and the stored rows are read once for those. A position may come up again.
    """
    ranged = _ranged(df, [key], None)
    counts = sorted(ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect())
    total = sum(c["n"] for c in counts)
    if not total:
        return positions.join(df.limit(0), F.lit(False))
    # One entry per range.
    starts = [0]
    for c in counts:
        starts.append(starts[-1] + c["n"])
    listed = F.array(*[F.lit(s).cast("bigint") for s in starts[:-1]])
    numbers = F.array(*[F.lit(c["_range"]) for c in counts])
    asked = positions.withColumn("_pos", F.pmod(F.col(at), F.lit(total)))
    asked = asked.withColumn("_nth", F.size(F.filter(listed, lambda s: s <= F.col("_pos"))))
    located = asked.select(
        *positions.columns, F.element_at(numbers, F.col("_nth")).alias("_range"),
        (F.col("_pos") - F.element_at(listed, F.col("_nth"))).alias("_at"),
    )
    return located.join(ranged, ["_range", "_at"]).drop("_range", "_at")


def running_totals(df: DataFrame, value: str, sums: dict[str, Column], cells: int | None = None) -> DataFrame:
    """Add ``name``: the sum of its expression over all rows with a smaller value.

    ``value`` must be unique (aggregate by it first, which also takes the weight
    out of a hot value).
    """
    ranged = _ranged(df, [value], cells)
    totals = ranged.groupBy("_range").agg(*[F.sum(e).alias(f"_b_{name}") for name, e in sums.items()])
    before = _earlier(totals, [f"_b_{name}" for name in sums])
    in_range = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumns({f"_i_{name}": F.coalesce(F.sum(e).over(in_range), F.lit(0)) for name, e in sums.items()})
    return inside.join(F.broadcast(before), "_range").select(
        *df.columns, *[(F.col(f"_b_{name}") + F.col(f"_i_{name}")).alias(name) for name in sums]
    )
