"""Mixing sources to target weights: token budgets down a tree, then a seeded prefix of every leaf.

The tree's levels are columns (domain, language, source). A subtree can give at most its tokens times
``max_epochs``. From the root down, a node's budget is dealt to its children by weight; a child that
cannot take its share takes what it has, and the rest goes to its siblings by weight, round by round. As a node
never gets more than its subtree can give, a shortage is made up by siblings first and only what the
whole family cannot give has gone to the ancestors' other branches. All of this happens on the table of
leaves, in whole tokens.

A leaf's budget is so many whole epochs and a rest. The rest is the prefix of the leaf in the seeded order
of the next epoch: rows are taken while their running sum of tokens stays within it. The cut
is found by narrowing the seeded hash in two steps of 1024 cells, counted by Spark, and ordering the
rows of one cell only; no leaf is ever sorted as a whole, and texts are not shuffled for it.

Defined results: null in a level is a value of its own; weights that are not given are 1, and a weight of
0 takes nothing. Documents without words have no tokens: they weigh nothing and come with every whole
epoch, and with the prefix up to its cut; a leaf of only such documents gives nothing. Rows that share id and leaf have the same place in the order and come
together or not at all. Fractions of a token are lost, at most one per child of a node. Input columns
named like the ones added are replaced. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.sources.workspace import materialize

#: Cells per step of the search for a cut, and how many of the 60 bits of the hash a step leaves.
CELLS, BITS = 1024, (50, 40)
#: ASCII white space between words, as a pattern.
GAPS = "[\\x20\\x09-\\x0D]+"


def word_count(text: Column | str) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def seeded_place(key: str, epoch: Column, seed: int) -> Column:
    """Place of a row in the order of an epoch, in [0, 2^60); MD5, which other engines have too."""
    digest = F.md5(F.concat(F.lit(f"{seed}-"), epoch.cast("string"), F.lit("-"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    given = weights.get(level, {})
    w = F.lit(1)
    for value, weight in sorted(given.items()):
        w = F.when(F.col(level) == F.lit(value), F.lit(int(weight))).otherwise(w)
    return w.cast("bigint")


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], total: int, weights: Mapping[str, Mapping[str, int]], max_epochs: int
) -> DataFrame:
    """``budget`` in tokens of every leaf (``levels`` and ``tokens``).

    Children of a node are put in the order in which they run out: by what they can give per unit of
    weight. Those before the point where the rest covers the remaining weights take all they have.
    """
    able = leaves.withColumn("able", F.col("tokens") * F.lit(max_epochs))
    out = None
    for depth, level in enumerate(levels, 1):
        above, here = list(levels[: depth - 1]), list(levels[:depth])
        nodes = able.groupBy(*here).agg(F.sum("able").alias("able")).withColumn("weight", _weight(level, weights))
        nodes = nodes.withColumn("able", F.when(F.col("weight") > 0, F.col("able")).otherwise(0))
        if out is None:
            nodes = nodes.withColumn("have", F.lit(total).cast("bigint"))
        else:
            nodes = _null_safe(nodes, out.withColumnRenamed("budget", "have"), above)
        family = Window.partitionBy(*above) if above else Window.partitionBy(F.lit(0))
        order = family.orderBy(
            (F.col("weight") == 0), F.col("able").cast("double") / F.greatest("weight", F.lit(1)).cast("double"),
            *[F.col(c).asc_nulls_first() for c in here],
        )
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        rest = F.col("have") - F.coalesce(F.sum("able").over(before), F.lit(0))
        open_weight = F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), F.lit(0))
        nodes = nodes.withColumns({"rest": rest, "open_weight": open_weight})
        nodes = nodes.withColumn("short", F.col("able").cast("decimal(38,0)") * F.col("open_weight") <= F.col("rest").cast("decimal(38,0)") * F.col("weight"))
        # Once a child is not short, no later one is; what is left there (the most, as it only falls) is
        # shared among them by weight.
        nodes = nodes.withColumn("first_open", F.max(F.when(~F.col("short"), F.struct("rest", "open_weight"))).over(family))
        share = F.expr("CAST(floor(first_open.rest * CAST(weight AS DECIMAL(20,0)) / first_open.open_weight) AS BIGINT)")
        nodes = nodes.withColumn("budget", F.when(F.col("short"), F.col("able")).otherwise(F.least("able", share)))
        out = nodes.select(*here, "budget")
    return out


def _null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns where null equals null."""
    named = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(named, condition, how).drop(*[f"__r_{c}" for c in on])


def _narrowed(rows: DataFrame, levels: Sequence[str], cuts: DataFrame, shift: int) -> DataFrame:
    """One step of the search: the cell of each leaf in which its rest runs out, and the rest at its start.

    ``rows`` has leaf, ``place`` and ``tokens``; ``cuts`` has leaf and ``rest``.
    """
    cells = rows.groupBy(*levels, F.shiftright("place", shift).alias("cell")).agg(F.sum("tokens").alias("tokens"))
    order = Window.partitionBy(*levels).orderBy("cell")
    upto = cells.withColumn("upto", F.sum("tokens").over(order))
    return (
        _null_safe(upto, cuts, levels)
        .filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("tokens") <= F.col("rest")))
        .groupBy(*levels)
        .agg(F.min(F.struct("cell", (F.col("rest") - (F.col("upto") - F.col("tokens"))).alias("rest"))).alias("at"))
        .select(*levels, "at.cell", "at.rest")
    )


def mixture_plan(
    docs: DataFrame, levels: Sequence[str], key: str, total: int | None, share: float,
    weights: Mapping[str, Mapping[str, int]], max_epochs: int, seed: int,
) -> DataFrame:
    """Per leaf: ``tokens``, ``budget``, whole ``epochs`` and, for the next one, ``cut_place`` and ``cut_key``.

    Rows strictly before (``cut_place``, ``cut_key``) belong to the prefix; null means that all rows do.
    """
    slim = materialize(docs.select(*levels, F.col(key).alias("key"), word_count("text").alias("tokens")), "tokens")
    leaves = materialize(slim.groupBy(*levels).agg(F.sum("tokens").alias("tokens")), "leaves")
    if total is None:
        total = int((leaves.agg(F.sum("tokens")).first()[0] or 0) * share)
    budgets = leaf_budgets(leaves, levels, total, weights, max_epochs)
    plan = _null_safe(leaves, budgets, levels)
    plan = plan.withColumns({
        "epochs": F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0),
        "rest": F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0),
    })
    plan = materialize(plan, "plan")
    placed = _null_safe(slim, plan.select(*levels, F.col("epochs").alias("whole")), levels)
    placed = placed.withColumn("place", seeded_place("key", F.col("whole"), seed)).select(*levels, "key", "tokens", "place")
    placed = materialize(placed, "places")
    cuts = plan.select(*levels, "rest")
    for shift in BITS:
        cuts = materialize(_narrowed(placed, levels, cuts.select(*levels, "rest"), shift), "cuts")
        at = cuts.select(*levels, F.col("cell").alias("cut_cell"))
        placed = _null_safe(placed, at, levels).filter(F.shiftright("place", shift) == F.col("cut_cell")).drop("cut_cell")
    order = Window.partitionBy(*levels).orderBy("place", F.col("key").asc_nulls_first())
    placed = placed.groupBy(*levels, "place", "key").agg(F.sum("tokens").alias("tokens"))
    last = _null_safe(placed, cuts, levels).withColumn("upto", F.sum("tokens").over(order))
    first_out = (
        last.filter(F.col("upto") > F.col("rest"))
        .groupBy(*levels)
        .agg(F.min(F.struct("place", F.coalesce("key", F.lit(-(1 << 63))).alias("key"))).alias("out"))
        .select(*levels, F.col("out.place").alias("cut_place"), F.col("out.key").alias("cut_key"))
    )
    return materialize(_null_safe(plan, first_out, levels, "left"), "mixture")


def mix(
    docs: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], key: str = "doc_id",
    total: int | None = None, share: float = 1.0, max_epochs: int = 2, seed: int = 17,
) -> DataFrame:
    """The documents of the mixture, once per epoch that takes them, with ``epoch`` from 0 and ``tokens``.

    ``total`` is the budget in tokens (white-space words); without it, ``share`` of all tokens. ``key`` is a
    bigint column.
    """
    plan = mixture_plan(docs, levels, key, total, share, weights, max_epochs, seed)
    small = plan.select(*levels, F.col("epochs").alias("__epochs"), F.col("cut_place").alias("__place"), F.col("cut_key").alias("__key"))
    rows = _null_safe(docs.drop("epoch", "tokens"), small, levels)
    place = seeded_place(key, F.col("__epochs"), seed)
    own = F.coalesce(F.col(key), F.lit(-(1 << 63)))
    early = (place < F.col("__place")) | ((place == F.col("__place")) & (own < F.col("__key")))
    # Without a cut the whole leaf has no tokens: nothing of a next epoch is asked for.
    copies = F.col("__epochs") + F.when(F.coalesce(early, F.lit(False)), 1).otherwise(0)
    return (
        rows.withColumn("__n", copies.cast("int"))
        .filter("__n > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
        .withColumn("tokens", word_count("text"))
        .drop("__epochs", "__place", "__key", "__n")
    )
