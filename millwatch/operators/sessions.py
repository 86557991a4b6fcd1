"""Operating sessions: stretches of readings without a long gap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millwatch.plans.slices import HOT_ROWS, epoch_us, lookback, running


def operating_sessions(
    df: DataFrame,
    gap_seconds: int = 3600,
    keys: Sequence[str] = ("equipment_id",),
    order: Sequence[str] = ("timestamp", "reading_id"),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sessions per key, split where two readings lie more than the gap apart.

    A row that opens a session is told by the row before it; the number of openings so far
    numbers the sessions. All steps share the partitioning by key; a hot key is sliced.
    """
    keys, gap = list(keys), gap_seconds * 1_000_000
    rows = df.select(*keys, *order, "value", epoch_us(F.col(order[0])).alias("_at"))
    rows = lookback(rows, keys, order, 1, {"_before": lambda w: F.lag("_at").over(w)}, hot_rows)
    opens = (F.col("_before").isNull() | (F.col("_at") - F.col("_before") > gap)).cast("long")
    rows = running(rows, keys, order, {"session_number": ("sum", opens)}, hot_rows)
    return rows.groupBy(*keys, "session_number").agg(
        F.min(order[0]).alias("session_start"), F.max(order[0]).alias("session_end"),
        F.count(F.lit(1)).alias("readings"), F.sum("value").alias("total"))
