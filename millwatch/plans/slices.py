"""Ordered per-key windows that survive a hot key.

A plain ``Window.partitionBy(key)`` sends all rows of one key to one task. Here a key
with more than ``hot_rows`` rows is cut into time slices, each about ``hot_rows / 8``
rows, and the result is put together so that it equals the plain window exactly:

* ``lookback`` (frames of a bounded number of preceding rows): rows past the head of
  their slice are complete inside it. Only the few rows next to a slice border need a
  second, small window over the whole key.
* ``running`` (counts, sums, last and next value over an unbounded frame): each slice is
  totalled first, the totals are carried along the key, and the carry is added.

Which keys are hot is settled first by one small job over the key and order columns; what
comes back is at most ``rows / hot_rows`` keys by construction. With none, which is the
usual case, the plan is the plain window over one shuffle and nothing else. Otherwise the
short list is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

HOT_ROWS = 20_000_000
SLICES_PER_HOT = 8

_LOW, _WIDTH, _SLICE, _RANK, _SIZE = "_low", "_width", "_slice", "_rank", "_size"
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def epoch_us(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def position(df: DataFrame, name: str) -> Column:
    """A number that rises with the column: what slices are cut on."""
    if isinstance(df.schema[name].dataType, _TIMES):
        return epoch_us(F.col(name)).cast("double")
    return F.col(name).cast("double")


def _hot_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, the start of their order and their slice width."""
    pos = position(df, order[0])
    width = (F.max(pos) - F.min(pos)) * hot_rows / (F.count(F.lit(1)) * SLICES_PER_HOT)
    sizes = df.groupBy(*[F.col(k).alias(f"_hot_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias(_SIZE), F.min(pos).alias(_LOW), F.greatest(width, F.lit(1e-9)).alias(_WIDTH))
    hot = sizes.filter(F.col(_SIZE) > hot_rows).drop(_SIZE)
    found = hot.collect()
    return df.sparkSession.createDataFrame(found, hot.schema) if found else None


def _start(low: Column, width: Column, pos: Column) -> Column:
    return low + F.floor((pos - low) / width) * width


def _sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: DataFrame, hot_rows: int) -> DataFrame:
    """Add ``_slice``: NULL for ordinary keys, the start of the slice for rows of a hot key.

    Slices are even in the order column, not in rows. One that a burst has made too large
    is cut again, as often as needed, unless all of it lies at one position.
    """
    pos = position(df, order[0])
    if keys:
        same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
        tagged = df.join(F.broadcast(hot), same, "left")
    else:
        whole = hot.first()
        tagged = df.withColumns({_LOW: F.lit(whole[_LOW]), _WIDTH: F.lit(whole[_WIDTH])})
    # A missing position sorts first, so it makes a slice of its own before all others.
    cut = F.coalesce(_start(F.col(_LOW), F.col(_WIDTH), pos), F.lit(float("-inf")))
    tagged = tagged.select(*df.columns, F.when(F.col(_WIDTH).isNotNull(), cut).alias(_SLICE))
    while True:
        width = (F.max(pos) - F.min(pos)) * hot_rows / (F.count(F.lit(1)) * SLICES_PER_HOT)
        crowded = tagged.filter(F.col(_SLICE).isNotNull()).groupBy(
            *[F.col(k).alias(f"_hot_{k}") for k in keys], F.col(_SLICE).alias("_hot_slice"),
        ).agg(F.count(F.lit(1)).alias(_SIZE), F.min(pos).alias(_LOW), width.alias(_WIDTH))
        crowded = crowded.filter((F.col(_SIZE) > hot_rows) & (F.col(_WIDTH) > 0)).drop(_SIZE)
        found = crowded.collect()
        if not found:
            return tagged
        table = df.sparkSession.createDataFrame(found, crowded.schema)
        same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys] + [F.col(_SLICE) == F.col("_hot_slice")]
        finer = F.coalesce(_start(F.col(_LOW), F.col(_WIDTH), pos), F.col(_SLICE))
        tagged = tagged.join(F.broadcast(table), same, "left").select(*df.columns, finer.alias(_SLICE))


def _ordered(by: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(*order)


def lookback(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows: int,
    columns: Mapping[str, Callable[[WindowSpec], Column]] | Callable[[DataFrame, list[str]], DataFrame],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add window columns that look at no more than ``rows`` preceding rows of the key.

    Each entry of ``columns`` gets the ordered window and returns the finished column. For
    columns that are made some other way, pass one function of (frame, key columns) that adds them.
    ``order`` must be unique inside a key, else the frames are not well defined.
    """
    keys, order = list(keys), list(order)
    sliced = _ordered([*keys, _SLICE], order)

    def add(source: DataFrame, by: list[str]) -> DataFrame:
        if callable(columns):
            return columns(source, by)
        w = _ordered(by, order)
        return source.select("*", *[make(w).alias(name) for name, make in columns.items()])

    hot_keys = _hot_keys(df, keys, order, hot_rows)
    if hot_keys is None:
        return add(df, keys)
    tagged = _sliced(df, keys, order, hot_keys, hot_rows)
    cold = add(tagged.filter(F.col(_SLICE).isNull()), keys).drop(_SLICE)

    hot = tagged.filter(F.col(_SLICE).isNotNull())
    rank = F.row_number().over(sliced)
    inner = add(hot.withColumn(_RANK, rank), [*keys, _SLICE]).filter(F.col(_RANK) > rows)
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys, _SLICE))
    edge = hot.withColumns({_RANK: rank, _SIZE: size})
    edge = edge.filter((F.col(_RANK) <= rows) | (F.col(_RANK) > F.col(_SIZE) - rows))
    head = add(edge, keys).filter(F.col(_RANK) <= rows)
    return cold.unionByName(inner.drop(_SLICE, _RANK)).unionByName(head.drop(_SLICE, _RANK, _SIZE))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, tuple[str, Column | None]],
    hot_rows: int = HOT_ROWS,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add columns over the whole run of a key up to the current row.

    ``columns`` maps a name to ``("count", None)`` (the row's position from 1),
    ``("sum", c)`` (running total of the non-null ``c``), ``("last", c)`` (latest non-null
    ``c`` so far) or ``("next", c)`` (first non-null ``c`` from this row on). ``sized_by``
    may name a cheaper frame with at least the same rows per key to look for hot keys in.
    """
    keys, order = list(keys), list(order)
    inputs = {f"_in_{n}": c for n, (_, c) in columns.items() if c is not None}
    given = df.withColumns(inputs) if inputs else df

    def local(name: str, kind: str, w: WindowSpec) -> Column:
        past = w.rowsBetween(Window.unboundedPreceding, 0)
        ahead = w.rowsBetween(0, Window.unboundedFollowing)
        source = F.col(f"_in_{name}")
        return {
            "count": lambda: F.row_number().over(w).cast("long"),
            "sum": lambda: F.coalesce(F.sum(source).over(past), F.lit(0)),
            "last": lambda: F.last(source, ignorenulls=True).over(past),
            "next": lambda: F.first(source, ignorenulls=True).over(ahead),
        }[kind]()

    def total(name: str, kind: str) -> Column:
        source = F.col(f"_in_{name}")
        at = F.when(source.isNotNull(), F.struct(*order))
        return {
            "count": lambda: F.count(F.lit(1)),
            "sum": lambda: F.sum(source),
            "last": lambda: F.max_by(source, at),
            "next": lambda: F.min_by(source, at),
        }[kind]()

    def carried(name: str, kind: str) -> Column:
        w = _ordered(keys, [_SLICE])
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        after = w.rowsBetween(1, Window.unboundedFollowing)
        source = F.col(f"_total_{name}")
        return {
            "count": lambda: F.sum(source).over(before),
            "sum": lambda: F.sum(source).over(before),
            "last": lambda: F.last(source, ignorenulls=True).over(before),
            "next": lambda: F.first(source, ignorenulls=True).over(after),
        }[kind]()

    def joined(name: str, kind: str) -> Column:
        here, carry = F.col(name), F.col(f"_carry_{name}")
        return here + F.coalesce(carry, F.lit(0)) if kind in ("count", "sum") else F.coalesce(here, carry)

    def add(w: WindowSpec) -> list[Column]:
        return [local(n, kind, w).alias(n) for n, (kind, _) in columns.items()]

    hot_keys = _hot_keys(df if sized_by is None else sized_by, keys, order, hot_rows)
    if hot_keys is None:
        return given.select(*df.columns, *add(_ordered(keys, order)))
    tagged = _sliced(given, keys, order, hot_keys, hot_rows)
    cold = tagged.filter(F.col(_SLICE).isNull())
    cold = cold.select(*df.columns, *add(_ordered(keys, order)))

    hot = tagged.filter(F.col(_SLICE).isNotNull())
    totals = hot.groupBy(*keys, _SLICE).agg(*[total(n, k).alias(f"_total_{n}") for n, (k, _) in columns.items()])
    carry = totals.select(
        *[F.col(k).alias(f"_carry_key_{k}") for k in keys],
        F.col(_SLICE).alias("_carry_slice"),
        *[carried(n, k).alias(f"_carry_{n}") for n, (k, _) in columns.items()],
    )
    same = [F.col(k).eqNullSafe(F.col(f"_carry_key_{k}")) for k in keys]
    same.append(F.col(_SLICE) == F.col("_carry_slice"))
    inner = hot.select(*df.columns, _SLICE, *add(_ordered([*keys, _SLICE], order)))
    # Same partitioning on both sides: the carry joins without moving the rows again.
    inner = inner.join(carry, same).select(*df.columns, *[joined(n, k).alias(n) for n, (k, _) in columns.items()])
    return cold.unionByName(inner)
