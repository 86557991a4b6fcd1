"""Exact nearest-neighbour imputation by descent through nested grid cells.

The distance is Euclidean over the measures both rows have, scaled up for the missing
ones: ``sqrt(all / shared * sum of squares)``. A missing cell gets the mean of that measure
over the ``neighbours`` nearest rows that have it.

Comparing every incomplete row with every row of its block would be quadratic. Instead the
rows of a block are counted in nested cells, cut at even ranks, with the bounds of what each cell holds.
For an incomplete row, the bounds tell the least and greatest distance to a cell; cells
that cannot hold one of the nearest rows are left out, the rest are refined level by
level, and only rows of the last surviving cells are measured. Nothing is approximated.
Equal rows are folded to one with a count first, so a heap of copies is one candidate.

In a block of few rows hardly a cell can be left out, and naming those that stay moves more than the rows do. Such
blocks have no cells: their rows move once, to their block, and are measured there.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

NEIGHBOURS = 5
CELLS_PER_AXIS = 4
ROWS_PER_CELL = 100
# Blocks of so many rows are compared whole.
ROWS_COMPARED = 2000
MAX_LEVELS = 6
CUT_ACCURACY = 10_000
# Guards the pruning against rounding of the bounds; it only ever keeps more.
SLACK = 1 + 1e-9


def _levels(base: DataFrame, dimensions: int) -> int:
    """Depth at which an evenly filled cell of the largest block holds some hundred rows."""
    largest = base.groupBy("_block").count().agg(F.max("count")).first()[0] or 1
    depth = math.log(max(largest / ROWS_PER_CELL, 1.0)) / math.log(CELLS_PER_AXIS ** dimensions)
    return min(max(math.ceil(depth), 1), MAX_LEVELS)


def _placed(base: DataFrame, xs: Sequence[str], finest: int) -> DataFrame:
    """Add the cell of each measure, cut at even ranks of the block's values, so that a far value stretches no cell; a missing measure is cell -1.

    The cuts are approximate: they shape cells, whose true bounds settle what is near.
    """
    cuts = base.groupBy(F.col("_block").alias("_of")).agg(*[F.percentile_approx(x, [i / finest for i in range(1, finest)], CUT_ACCURACY).alias(f"c{x}") for x in xs])
    steps = F.array(*[F.lit(finest >> k) for k in range(1, finest.bit_length())])

    def place(x: str) -> Column:
        # Half of the cuts, then half of the rest, and so on.
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(f"c{x}", at + step - 1) <= F.col(x), at + step).otherwise(at))

    cells = [F.when(F.col(x).isNull(), -1).otherwise(place(x)).cast("long").alias(f"i{x}") for x in xs]
    return base.join(cuts, F.col("_block").eqNullSafe(F.col("_of"))).select("_id", "_block", *xs, *cells)


def _total(parts: list[Column]) -> Column:
    return sum(parts[1:], parts[0])


def _scaled(squares: list[Column], present: list[Column], dimensions: int) -> Column:
    """Sum of the squares of shared measures, scaled up for the missing ones; NULL if none."""
    shared = _total([p.cast("int") for p in present])
    total = _total([F.when(p, s).otherwise(0.0) for s, p in zip(squares, present, strict=True)])
    return F.when(shared > 0, total * float(dimensions) / shared)


def _filled(base: DataFrame, xs: Sequence[str], neighbours: int, levels: int, blocked: bool) -> DataFrame:
    """The fill of each missing measure by incomplete row, from cells of so many levels; with none, blocks are compared whole."""
    d = len(xs)
    finest = CELLS_PER_AXIS ** levels

    placed = _placed(base, xs, finest) if levels else base.repartition("_block")

    # Places from -1 to finest - 1 in one whole number, if it has room for all measures.
    bits = finest.bit_length()

    def cell(level: int) -> Column:
        step = CELLS_PER_AXIS ** (levels - level)
        places = [F.when(F.col(f"i{x}") < 0, F.lit(-1)).otherwise(F.floor(F.col(f"i{x}") / step)).cast("long") for x in xs]
        if bits * d > 62:
            return F.concat_ws(".", *[p.cast("string") for p in places])
        return reduce(lambda a, p: F.shiftleft(a, bits).bitwiseOR(p + 1), places, F.lit(0).cast("long"))

    # Copies of one row fold into one candidate with a count.
    places = [f"i{x}" for x in xs] if levels else []
    donors = placed.groupBy("_block", *xs, *places).agg(F.count(F.lit(1)).alias("_copies"), F.min("_id").alias("_first"))
    donors = donors.withColumn("_cell", cell(levels)) if levels else donors

    wanted = base.filter(~(_total([F.col(x).isNull().cast("int") for x in xs]) == 0)).select(
        F.col("_id").alias("_qid"), F.col("_block").alias("_qblock"), *[F.col(x).alias(f"q{x}") for x in xs],
        F.explode(F.filter(F.array(*[F.when(F.col(x).isNull(), F.lit(j)) for j, x in enumerate(xs)]),
                           lambda v: v.isNotNull())).alias("_target"))
    candidates = wanted
    for level in range(1, levels + 1):
        directory = donors.groupBy("_block", cell(level).alias("_cell"), cell(level - 1).alias("_parent")).agg(
            F.sum("_copies").alias("_copies"),
            *[F.min(x).alias(f"lo{x}") for x in xs], *[F.max(x).alias(f"hi{x}") for x in xs])
        if level == 1 and not blocked:
            # One block, and no more than (CELLS_PER_AXIS + 1) ** d cells of it, whatever the rows.
            directory = F.broadcast(directory)
        parent = F.col("_parent") == F.col("_qcell") if level > 1 else F.lit(True)
        pairs = candidates.join(directory, (F.col("_qblock") == F.col("_block")) & parent)
        shared = [F.col(f"q{x}").isNotNull() & F.col(f"lo{x}").isNotNull() for x in xs]
        near = [F.greatest(F.col(f"lo{x}") - F.col(f"q{x}"), F.col(f"q{x}") - F.col(f"hi{x}"), F.lit(0.0)) for x in xs]
        far = [F.greatest(F.abs(F.col(f"lo{x}") - F.col(f"q{x}")), F.abs(F.col(f"q{x}") - F.col(f"hi{x}"))) for x in xs]
        has_target = F.coalesce(*[F.when(F.col("_target") == j, F.col(f"lo{x}").isNotNull()) for j, x in enumerate(xs)])
        pairs = pairs.filter(has_target).withColumns({
            "_near": _scaled([a * a for a in near], shared, d), "_far": _scaled([a * a for a in far], shared, d),
        }).filter(F.col("_near").isNotNull())
        mine = Window.partitionBy("_qblock", "_qid", "_target")
        held = F.sum("_copies").over(mine.orderBy("_far", "_cell").rowsBetween(Window.unboundedPreceding, 0))
        reach = F.min(F.when(F.col("_held") >= neighbours, F.col("_far"))).over(mine)
        kept = pairs.withColumn("_held", held).withColumn("_reach", reach)
        kept = kept.filter(F.col("_reach").isNull() | (F.col("_near") <= F.col("_reach") * SLACK))
        candidates = kept.select("_qid", "_qblock", *[f"q{x}" for x in xs], "_target", F.col("_cell").alias("_qcell"))

    met = F.col("_qblock") == F.col("_block")
    measured = candidates.join(donors, met & (F.col("_qcell") == F.col("_cell")) if levels else met)
    shared = [F.col(f"q{x}").isNotNull() & F.col(x).isNotNull() for x in xs]
    squares = [(F.col(x) - F.col(f"q{x}")) * (F.col(x) - F.col(f"q{x}")) for x in xs]
    value = F.coalesce(*[F.when(F.col("_target") == j, F.col(x)) for j, x in enumerate(xs)])
    measured = measured.select("_qblock", "_qid", "_target", value.alias("_value"), "_copies", "_first", _scaled(squares, shared, d).alias("_distance"))
    if not levels:
        measured = measured.filter(F.col("_value").isNotNull() & F.col("_distance").isNotNull())
    nearest = Window.partitionBy("_qblock", "_qid", "_target").orderBy("_distance", "_first")
    before = F.coalesce(F.sum("_copies").over(nearest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    used = F.least(F.col("_copies"), neighbours - F.col("_before"))
    # No more candidates than neighbours count; Spark leaves the others out before they are moved.
    measured = measured.withColumn("_place", F.row_number().over(nearest)).filter(F.col("_place") <= neighbours).drop("_place")
    return (
        measured.withColumn("_before", before).filter(F.col("_before") < neighbours)
        .groupBy("_qblock", "_qid").agg(*[
            (F.sum(F.when(F.col("_target") == j, F.col("_value") * used))
             / F.sum(F.when(F.col("_target") == j, used))).alias(f"_filled{j}") for j in range(d)])
    )


def impute_knn(df: DataFrame, columns: Sequence[str], row_id: Sequence[str] = (), block: str | None = "equipment_id",
               neighbours: int = NEIGHBOURS, levels: int | None = None) -> DataFrame:
    """Fill missing measures from the nearest rows of the block (of the whole table if None).

    ``row_id`` names columns that tell rows apart; without it the row's own content does,
    so exact duplicates should be removed first. Rows at the same distance are taken by
    the smallest id among their copies. Without any donor the column mean is used.
    """
    columns = list(columns)
    if not columns:
        return df
    d = len(columns)
    # Rows meet inside their block: what names the block need not be moved with each of them once more.
    told = [c for c in row_id if c != block]
    identity = F.struct(*told) if told else F.struct(F.md5(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})))
    marked = df.withColumns({"_id": identity, "_block": F.col(block) if block else F.lit(0)})
    complete = _total([F.col(c).isNull().cast("int") for c in columns]) == 0
    base = marked.select("_id", "_block", *[F.col(c).cast("double").alias(f"x{j}") for j, c in enumerate(columns)])
    xs = [f"x{j}" for j in range(d)]
    if levels or not block:
        filled = _filled(base, xs, neighbours, levels or _levels(base, d), bool(block))
    else:
        # At most one in ROWS_COMPARED rows.
        large = F.broadcast(base.groupBy(F.col("_block").alias("_large")).count().filter(F.col("count") > ROWS_COMPARED).select("_large"))
        its = F.col("_block") == F.col("_large")
        filled = _filled(base.join(large, its, "left_anti"), xs, neighbours, 0, True).unionByName(
            _filled(base.join(large, its, "left_semi"), xs, neighbours, _levels(base, d), True))
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("q")).scalar()
    # Only the incomplete rows meet their fill; the others are not moved.
    gaps = marked.filter(~complete).join(filled, (F.col("_block") == F.col("_qblock")) & (F.col("_id") == F.col("_qid")), "left").withColumn("_means", means)
    gaps = gaps.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.col(f"_filled{j}"), F.col("_means")[c]) for j, c in enumerate(columns)})
    whole = marked.filter(complete).withColumns({c: F.col(c).cast("double") for c in columns})
    return whole.select(*df.columns).unionByName(gaps.select(*df.columns))
