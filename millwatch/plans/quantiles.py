"""Exact quantiles by counted bins, refined three times: no values are sorted and no column is held anywhere.

A double falls into one of about 1000 bins for each power of two; the bin of a wanted rank is cut evenly
into ``CUTS``, and of the cut that holds the rank the single values are counted. All columns and
probabilities go through the same three scans. Counts add up on the map side, so what moves are bins; the
same plan runs at any number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Bins for each power of two: a bin holds at most 2**42 different doubles.
PER_POWER = 1024
#: Even cuts of a bin: each holds about 2**20 different doubles, however the values lie.
CUTS = 1 << 22
#: Above the bin of any finite number's size.
_ZERO = 4 * PER_POWER * PER_POWER


@dataclass
class _Target:
    """The value of one rank (from 0) of one column: the range it lies in, and how many values are below the range."""

    column: int
    rank: int
    low: float | None = None
    high: float | None = None
    below: int = 0


def _bin(v: Column) -> Column:
    """A whole number that never falls as the value rises; not-a-number is above all."""
    size = F.lit(_ZERO) + F.floor(F.log2(F.abs(v)) * PER_POWER)
    endless = F.lit(2 * _ZERO)
    return (F.when(F.isnan(v), 2 * endless).when(v == float("inf"), endless).when(v == float("-inf"), -endless)
            .when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size)).cast("long")


def _settle(counted: DataFrame, targets: Sequence[_Target]) -> None:
    """Move each target to the bin that holds its rank. ``counted``: (target, bin, n, low, high), bounded by the number of bins."""
    upto = F.sum("n").over(W.partitionBy("target").orderBy("bin"))
    ranks = F.array(*[F.lit(t.rank - t.below) for t in targets])
    at = counted.withColumn("upto", upto).withColumn("rank", ranks[F.col("target")])
    found = at.where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank"))).select("target", "low", "high", (F.col("upto") - F.col("n")).alias("below"))
    for row in found.collect():
        t = targets[row["target"]]
        t.low, t.high, t.below = row["low"], row["high"], t.below + row["below"]


def _counts(numbers: DataFrame, targets: Sequence[_Target], names: Sequence[str], cut) -> DataFrame:
    """Counts of the bins that ``cut`` gives the values in each target's range."""
    cells = []
    for i, t in enumerate(targets):
        v = F.col(names[t.column])
        held = v.between(t.low, t.high)
        cells.append(F.when(held, F.struct(F.lit(i).alias("target"), cut(t, v).alias("bin"), v.alias("v"))))
    rows = numbers.select(F.inline(F.filter(F.array(*cells), lambda c: c.isNotNull())))
    return rows.groupBy("target", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))


def rank_values(df: DataFrame, columns: Sequence[str], ranks) -> dict[tuple[str, int], float]:
    """The values of some ranks (from 0) of each column, as numbers: ``ranks`` gives them for a count of values.

    What comes back to the driver are one range a rank and column.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    names = [f"v{i}" for i in range(len(columns))]
    cells = F.array(*[F.when(F.col(n).isNotNull(), F.struct(F.lit(i).alias("column"), _bin(F.col(n)).alias("bin"), F.col(n).alias("v"))) for i, n in enumerate(names)])
    binned = numbers.select(F.inline(F.filter(cells, lambda c: c.isNotNull()))).groupBy("column", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    upto = binned.withColumn("upto", F.sum("n").over(W.partitionBy("column").orderBy("bin")))
    whole = F.sum("n").over(W.partitionBy("column"))
    # A wanted rank as a share of the count is settled where the count is known: in the same job.
    wanted = F.filter(ranks(F.col("whole")), lambda k: (k < F.col("upto")) & (k >= F.col("upto") - F.col("n")))
    found = upto.withColumn("whole", whole).withColumn("ranks", wanted).where(F.size("ranks") > 0).collect()
    targets = [_Target(r["column"], k, r["low"], r["high"], r["upto"] - r["n"]) for r in found for k in sorted(set(r["ranks"]))]

    def even(t: _Target, v: Column) -> Column:
        # Halves are taken first: the width of a range may be beyond the largest double.
        width = t.high / 2 - t.low / 2
        return F.floor((v / 2 - t.low / 2) / width * CUTS).cast("long") if width > 0 else F.lit(0).cast("long")

    for cut in (even, lambda t, v: v):
        wide = [t for t in targets if t.low < t.high]
        if wide:
            _settle(_counts(numbers, wide, names, cut), wide)
    return {(columns[t.column], t.rank): t.low for t in targets}


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[tuple[str, float], float]:
    """Linear-interpolated quantiles by (column, probability); NULL does not count, a column without values is left out."""
    def place(n: Column, p: float) -> Column:
        return F.lit(float(p)) * (n - 1)

    def ranks(n: Column) -> Column:
        return F.array(*[f(place(n, p)).cast("long") for p in probabilities for f in (F.floor, F.ceil)])

    values = rank_values(df, columns, ranks)
    sizes = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    out = {}
    for c, n in zip(columns, sizes, strict=True):
        for p in probabilities if n else ():
            at = float(p) * (n - 1)
            low, high = values[c, int(at)], values[c, int(-(-at // 1))]
            out[c, float(p)] = low + (high - low) * (at - int(at)) if low != high else low
    return out


def quantile_struct(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> Column:
    """The same as one struct of numbers with fields ``<column>_<index of p>``."""
    found = exact_quantiles(df, columns, probabilities)
    return F.struct(*[F.lit(found.get((c, float(p)))).cast("double").alias(f"{c}_{i}") for c in columns for i, p in enumerate(probabilities)])
