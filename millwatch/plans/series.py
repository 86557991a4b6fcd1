"""The last values up to each row as rows of a matrix, inside the tasks that hold the series in order.

A list of values stored with each row makes a table ``length`` times as large as the series. Here rows are dealt by key and
sorted once, NumPy looks at overlapping windows of the values, and what is stored is at most the series itself.
A task holds one Arrow batch and the ``length - 1`` values before it. Keys beyond ``hot_rows`` are cut into parts of bounded
size by the position of their rows; a part starts with copies of the rows before it, which get no figure.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millwatch.plans.slices import HOT_ROWS, SLICES_PER_HOT, _hot_keys, running
from millwatch.session import ship

_VALUE, _PART, _LEAD = "_value", "_part", "_lead"
PACKED = "series binary, ends binary, labels binary"


def _in_order(df: DataFrame, order: Sequence[str], column: str, length: int, key: str, hot_rows: int) -> DataFrame:
    """Rows of a key, or of a part of a hot key, one after the other; ``_lead`` marks the copies at the head of a part."""
    rows = df.withColumn(_VALUE, F.col(column).cast("double"))
    if _hot_keys(df, [key], order, hot_rows) is None:
        rows = rows.withColumns({_PART: F.lit(0).cast("long"), _LEAD: F.lit(False)})
        return rows.repartition(key).sortWithinPartitions(key, *order)
    size = max(hot_rows // SLICES_PER_HOT, length)
    numbered = running(rows, [key], order, {"_at": ("count", None)}, hot_rows).withColumn("_at", F.col("_at") - 1)
    own = F.floor(F.col("_at") / size).cast("long")
    parts = F.when(F.col("_at") % size > size - length, F.array(own, own + 1)).otherwise(F.array(own))
    dealt = numbered.withColumn(_PART, F.explode(parts)).withColumn(_LEAD, F.col(_PART) > own).drop("_at")
    return dealt.repartition(key, _PART).sortWithinPartitions(key, _PART, *order)


def _series(batches: Iterator[pa.RecordBatch], key: str, length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each batch: its rows, the values with those before the batch, the rows that have a whole window, and where these end."""
    before, last = np.zeros(0), None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.array(batch.column(key).to_pylist() + [None], dtype=object)[:-1]
        parts = batch.column(_PART).to_numpy()
        values = batch.column(_VALUE).to_numpy(zero_copy_only=False).astype("float64")
        if last != (names[0], parts[0]):
            before = np.zeros(0)
        changed = np.concatenate([[False], (names[1:] != names[:-1]) | (parts[1:] != parts[:-1])])
        at = np.arange(len(values)) + len(before)
        first = np.maximum.accumulate(np.where(changed, at, 0))
        whole = (at - first >= length - 1) & ~batch.column(_LEAD).to_numpy(zero_copy_only=False).astype(bool)
        series = np.concatenate([before, values])
        rows = np.flatnonzero(whole)
        yield batch, series, rows, at[rows]
        before, last = series[max(first[-1], len(series) - length + 1):], (names[-1], parts[-1])


def _filled(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows with gaps filled by the value before, at their start by the first value; and which have any value."""
    known = ~np.isnan(windows)
    if known.all():
        return windows, np.ones(len(windows), dtype=bool)
    width = windows.shape[1]
    place = np.maximum.accumulate(np.where(known, np.arange(width), -1), axis=1)
    place = np.where(place < 0, known.argmax(axis=1)[:, None], place)
    return np.take_along_axis(windows, place, axis=1), known.any(axis=1)


def windows_of(series: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows that end at the given places, filled, and which of them have any value."""
    if not len(ends):
        return np.zeros((0, length)), np.zeros(0, dtype=bool)
    return _filled(np.lib.stride_tricks.sliding_window_view(series, length)[ends - length + 1])


def window_figure(df: DataFrame, order: Sequence[str], column: str, length: int, make: Callable[[np.ndarray], np.ndarray], name: str,
                  key: str = "equipment_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add the number that ``make`` gives for each row's window (rows by ``length``); NULL for a short window or one without any value."""
    kept = df.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, series, rows, ends in _series(batches, key, length):
            windows, present = windows_of(series, ends, length)
            figure, none = np.zeros(batch.num_rows), np.ones(batch.num_rows, dtype=bool)
            if present.any():
                figure[rows[present]] = make(windows[present])
                none[rows[present]] = False
            own = pa.array(~batch.column(_LEAD).to_numpy(zero_copy_only=False).astype(bool))
            out = [*[batch.column(c) for c in kept], pa.array(figure, mask=none)]
            yield pa.RecordBatch.from_arrays(out, names=[*kept, name]).filter(own)

    ship(df.sparkSession)
    schema = df.select("*", F.lit(None).cast("double").alias(name)).schema
    return _in_order(df, order, column, length, key, hot_rows).mapInArrow(add, schema)


def packed_series(df: DataFrame, order: Sequence[str], column: str, length: int, label: str | None = None,
                  key: str = "equipment_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """The series in pieces, each with the ends of its windows and their labels: what a fit that looks at every window many times reads."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, series, rows, ends in _series(batches, key, length):
            present = windows_of(series, ends, length)[1]
            labels = batch.column("_label").to_numpy(zero_copy_only=False)[rows] if label else np.zeros(len(rows))
            chosen = present & ~np.isnan(labels)
            piece = (series, ends[chosen].astype("int64"), labels[chosen].astype("float64"))
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in piece], names=["series", "ends", "labels"])

    ship(df.sparkSession)
    marked = df.select(*dict.fromkeys([key, *order, column]), *([F.col(label).cast("double").alias("_label")] if label else []))
    return _in_order(marked, order, column, length, key, hot_rows).mapInArrow(pack, PACKED)


def unpacked(batches: Iterator[pa.RecordBatch], length: int, rows: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows and labels of packed pieces, some rows at a time."""
    for batch in batches:
        for series, ends, labels in zip(*[batch.column(c).to_pylist() for c in ("series", "ends", "labels")]):
            series, ends, labels = np.frombuffer(series), np.frombuffer(ends, dtype="int64"), np.frombuffer(labels)
            for start in range(0, len(ends), rows):
                yield windows_of(series, ends[start:start + rows], length)[0], labels[start:start + rows]
