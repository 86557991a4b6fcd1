"""Feature engineering over wide readings: time, rolling, equipment, pairs, health, scaling."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millwatch.functions import scores as S
from millwatch.operators.cleaning import numeric_columns
from millwatch.plans.quantiles import quantile_struct
from millwatch.plans.slices import HOT_ROWS, lookback, running
from millwatch.schemas import MEASURES
from millwatch.session import ship

ROLLING_WINDOWS = [5, 10, 30, 60]
SEQUENCE_LENGTH = 60
NOT_FEATURES = ["timestamp", "equipment_id", "is_anomaly", "will_fail", "health_score", "maintenance_urgency"]


def time_features(df: DataFrame) -> DataFrame:
    ts = F.col("timestamp")
    if "timestamp" not in df.columns:
        return df
    return df.withColumns({
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "day_of_month": F.dayofmonth(ts),
        "month": F.month(ts),
        "is_weekend": F.weekday(ts).isin(5, 6).cast("int"),
        "is_night": ((F.hour(ts) >= 22) | (F.hour(ts) < 6)).cast("int"),
    })


def _continued(batch: pa.RecordBatch, by: list[int], columns: list[int], past: tuple | None, back: int) -> tuple:
    """Rank of the rows in their keys, what the next batch needs, and each column with the ``back`` rows before the batch.

    Rows come key by key, in order. The rank also covers the rows carried along and stops at ``back``.
    """
    n = batch.num_rows
    change = np.zeros(n, "bool")
    for i in by:
        codes = batch.column(i).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        change[1:] |= codes[1:] != codes[:-1]
    key = [batch.column(i)[n - 1] for i in by]
    same = past is not None and all(batch.column(i)[0].equals(k) for i, k in zip(by, past[0]))
    start = np.where(change, np.arange(n), 0)
    begun = np.arange(n) - np.maximum.accumulate(start)
    first = int(change.argmax()) if change.any() else n
    if same:
        begun[:first] += past[1]
    rank = np.minimum(begun, back)
    series, kept = [], []
    for j, i in enumerate(columns):
        column = batch.column(i)
        known = column.is_valid().to_numpy(zero_copy_only=False)
        values = column.fill_null(0).to_numpy(zero_copy_only=False)
        before, seen = past[2][j] if same else (np.zeros(back, values.dtype), np.zeros(back, "bool"))
        values, known = np.concatenate([before, values]), np.concatenate([seen, known])
        series.append((values, known))
        kept.append((values[len(values) - back:], known[len(known) - back:]))
    return rank, (key, int(begun[-1]) + 1, kept), series


def _rolled(values: np.ndarray, known: np.ndarray, rank: np.ndarray, windows: list[int]) -> list[pa.Array]:
    """Mean, sample deviation, maximum and minimum of each window up to each ranked value; the values before them are those carried along."""
    whole, back = values.dtype.kind == "i", len(values) - len(rank)
    high, low = (np.iinfo(values.dtype).min, np.iinfo(values.dtype).max) if whole else (-np.inf, np.nan)
    # Figures of a frame: count, mean, squared deviations, highest, lowest.
    none = (0.0, 0.0, 0.0, high, low)
    made = {1: (known.astype("float64"), np.where(known, values, 0).astype("float64"), np.zeros(len(values)), np.where(known, values, high), np.where(known, values, low))}
    rank, out = np.concatenate([rank[0] - np.arange(back, 0, -1), rank]), []

    def earlier(figures: tuple, rows: int) -> tuple:
        """The figures some rows back; none where the key has no such row."""
        reached = rank[rows:] >= rows
        return tuple(np.concatenate([np.full(min(rows, len(f)), e, f.dtype), np.where(reached, f[:-rows], e)]) for f, e in zip(figures, none))

    for w in windows:
        base = max(b for b in made if w % b == 0)
        parts = [made[base], *(earlier(made[base], rows) for rows in range(base, w, base))]
        with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
            n = sum(p[0] for p in parts)
            mean = np.where(n > 0, sum(np.where(p[0] > 0, p[0] * p[1], 0.0) for p in parts) / n, 0.0)
            # Squared deviations inside the parts, and of the parts' means around the joint one.
            m2 = sum(np.where(p[0] > 0, p[2] + p[0] * (p[1] - mean) ** 2, 0.0) for p in parts)
            made[w] = (n, mean, m2, functools.reduce(np.maximum, (p[3] for p in parts)), functools.reduce(np.minimum if whole else np.fmin, (p[4] for p in parts)))
            n, mean, m2, top, bottom = (f[back:] for f in made[w])
            std = np.sqrt(m2 / (n - 1))
        out += [pa.array(mean, mask=n == 0), pa.array(std, mask=n <= 1), pa.array(top, mask=n == 0), pa.array(bottom, mask=n == 0)]
    return out


def rolling_features(
    df: DataFrame,
    order: Sequence[str],
    columns: Sequence[str] = MEASURES,
    windows: Sequence[int] = ROLLING_WINDOWS,
    key: str = "equipment_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Mean, sample deviation, maximum and minimum over the last w rows of the equipment.

    All columns share one partitioning and one sort; the sorted rows go through NumPy by batches that
    carry the last rows along, so a task holds a batch. A frame that is a multiple of the next smaller one is
    put together from that one's results some rows back. Missing values are left out; NaN counts as larger
    than any number, as in Spark. Decimals are computed as doubles.
    """
    columns = [c for c in columns if c in df.columns]
    windows = sorted(set(windows))
    if not columns or not windows:
        return df
    ship(df.sparkSession)
    kinds = {c: df.schema[c].dataType for c in columns}
    made = [T.StructField(f"{c}_{name}_{w}", kinds[c] if name in ("max", "min") else T.DoubleType())
            for c in columns for w in windows for name in ("mean", "std", "max", "min")]

    def build(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        at, given = [rows.columns.index(c) for c in by], rows.columns
        # Python gets the columns as numbers it can compute with; the rows themselves pass through it unchanged.
        numbers = {f"_{c}_n": F.col(f"`{c}`").cast("long" if isinstance(kinds[c], T.IntegralType) else "double") for c in columns}
        dealt = rows.repartition(*[F.col(f"`{c}`") for c in by]).sortWithinPartitions(*[f"`{c}`" for c in by], *[f"`{c}`" for c in order])
        ready, read = dealt.withColumns(numbers), list(numbers)
        shape = T.StructType([*rows.schema.fields, *[
            T.StructField(f.name, ready.schema[f"_{c}_n"].dataType if f.dataType == kinds[c] else f.dataType) for f, c in zip(made, np.repeat(columns, 4 * len(windows)))]])

        def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            past = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                rank, past, series = _continued(batch, at, [batch.schema.get_field_index(n) for n in read], past, max(windows) - 1)
                found = [x for values, known in series for x in _rolled(values, known, rank, windows)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(given)], *found], schema=pa.schema(
                    [*[batch.schema.field(i) for i in range(len(given))], *[pa.field(f.name, x.type) for f, x in zip(made, found)]]))

        out = ready.mapInArrow(roll, shape)
        return out.select(*[f"`{c}`" for c in given], *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in made])

    return lookback(df, [key], order, max(windows) - 1, build, hot_rows)


def equipment_features(df: DataFrame, order: Sequence[str], start: str | None = "start_date",
                       key: str = "equipment_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Age in whole days since ``start`` (if present) and the reading's rank in time."""
    out = running(df, [key], order, {"operating_hours": ("count", None)}, hot_rows)
    if start in df.columns:
        out = out.withColumn("equipment_age_days", S.whole_days(F.col("timestamp"), F.col(start)))
    return out


def as_of(df: DataFrame, log: DataFrame, order: Sequence[str], key: str = "equipment_id",
          log_time: str = "date", name: str = "last_maintenance", direction: str = "last",
          hot_rows: int = HOT_ROWS) -> DataFrame:
    """Time of the latest (``last``) or following (``next``) log entry of each row's key.

    Both inputs are put in one sequence per key and the entry is carried along it, so no
    pair of rows is ever formed. An entry at the row's own instant counts as past.
    """
    entries = log.select(F.col(key), F.col(log_time).alias("timestamp"), F.col(log_time).alias("_entry"),
                         F.lit(0).alias("_kind"))
    rows = df.withColumns({"_entry": F.lit(None).cast(log.schema[log_time].dataType), "_kind": F.lit(1)})
    both = rows.unionByName(entries, allowMissingColumns=True)
    tie = [c for c in order if c != "timestamp"]
    out = running(both, [key], ["timestamp", "_kind", *tie], {name: (direction, F.col("_entry"))}, hot_rows)
    return out.filter(F.col("_kind") == 1).select(*df.columns, name)


def days_since_maintenance(df: DataFrame, log: DataFrame, order: Sequence[str],
                           hot_rows: int = HOT_ROWS) -> DataFrame:
    """Whole days since the equipment's last maintenance; NULL before the first."""
    return as_of(df, log, order, hot_rows=hot_rows).withColumn(
        "days_since_maintenance", S.whole_days(F.col("timestamp"), F.col("last_maintenance")))


def pair_features(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Ratio and difference of every pair of measures."""
    made = {}
    for a, b in combinations([c for c in columns if c in df.columns], 2):
        made[f"{a}_{b}_ratio"] = F.col(a) / (F.col(b) + 1e-8)
        made[f"{a}_{b}_diff"] = F.col(a) - F.col(b)
    return df.withColumns(made) if made else df


def health_indicators(df: DataFrame) -> DataFrame:
    """Vibration and temperature health, and the mean of all ``*_health`` columns."""
    made = {}
    if "value" in df.columns:
        made["vibration_health"] = S.range_health(F.col("value"), 0.0, 1.0)
    if "temperature" in df.columns:
        made["temperature_health"] = S.range_health(F.col("temperature"), 20.0, 80.0)
    out = df.withColumns(made) if made else df
    parts = [F.col(c) for c in out.columns if c.endswith("_health")]
    return out.withColumn("overall_health", S.row_mean(parts)) if parts else out


def health_target(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Training targets: the health score, its urgency, and the constant flags.

    The score is ``overall_health`` if present, else the mean over the measures of one
    minus the min-max normalised value.
    """
    present = [c for c in columns if c in df.columns]
    if "overall_health" in df.columns:
        out = df.withColumn("health_score", F.col("overall_health"))
    elif present:
        out = df.withColumn("_q", _extremes(df, present).scalar())
        q = F.col("_q")
        parts = [1.0 - (F.col(c) - q[f"{c}_low"]) / F.nullif(q[f"{c}_high"] - q[f"{c}_low"], F.lit(0.0)) for c in present]
        out = out.withColumn("health_score", sum(parts[1:], parts[0]) / float(len(parts))).drop("_q")
    else:
        out = df.withColumn("health_score", F.lit(0.5))
    return out.withColumns({
        "is_anomaly": F.lit(0), "will_fail": F.lit(0),
        "maintenance_urgency": S.target_urgency(F.col("health_score")),
    })


def _extremes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(F.struct(*[
        f(c).cast("double").alias(f"{c}_{name}") for c in columns for f, name in ((F.min, "low"), (F.max, "high"))
    ]).alias("q"))


def scale(df: DataFrame, method: str = "standard", columns: Sequence[str] | None = None) -> DataFrame:
    """Scale columns in place: ``standard`` (population deviation), ``minmax`` or ``robust``.

    A column without spread is only centred. The figures come from one aggregate that is
    read as a scalar, for ``robust`` from counted bins, so the rows are not shuffled.
    """
    columns = list(columns or numeric_columns(df, NOT_FEATURES))
    if method == "standard":
        figures_of = df.agg(F.struct(*[f(c).alias(f"{c}_{n}") for c in columns
                                       for f, n in ((F.avg, "mid"), (F.stddev_pop, "spread"))]).alias("q")).scalar()
        figures = {c: (f"{c}_mid", lambda q, c=c: q[f"{c}_spread"]) for c in columns}
    elif method == "minmax":
        figures_of = _extremes(df, columns).scalar()
        figures = {c: (f"{c}_low", lambda q, c=c: q[f"{c}_high"] - q[f"{c}_low"]) for c in columns}
    elif method == "robust":
        figures_of = quantile_struct(df, columns, [0.25, 0.5, 0.75])
        figures = {c: (f"{c}_1", lambda q, c=c: q[f"{c}_2"] - q[f"{c}_0"]) for c in columns}
    else:
        raise ValueError(f"Unknown scaling method: {method}")
    out, q = df.withColumn("_q", figures_of), F.col("_q")
    scaled = {}
    for c, (mid, spread) in figures.items():
        width = spread(q)
        scaled[c] = (F.col(c) - q[mid]) / F.when(width == 0, 1.0).otherwise(width)
    return out.withColumns(scaled).drop("_q")


def feature_importance(df: DataFrame, target: str = "health_score", features: Sequence[str] | None = None) -> DataFrame:
    """Absolute Pearson correlation of each numeric feature with the target, in one pass."""
    features = list(features or numeric_columns(df, [*NOT_FEATURES, target]))
    row = df.agg(*[F.abs(F.corr(F.col(c).cast("double"), F.col(target).cast("double"))).alias(c) for c in features])
    return (
        row.unpivot([], features, "feature", "importance")
        .withColumn("type", F.lit("numeric")).orderBy(F.desc_nulls_last("importance"), "feature")
    )


def sequence_windows(df: DataFrame, order: Sequence[str], column: str = "value", length: int = SEQUENCE_LENGTH,
                     key: str = "equipment_id", hot_rows: int = HOT_ROWS, keep_short: bool = False) -> DataFrame:
    """The last ``length`` values up to each row, as an array; rows with fewer are left out.

    A missing value keeps its place as NULL.
    """
    made = {
        # Collected in structs, as a NULL by itself would be skipped.
        "sequence": lambda w: F.collect_list(F.struct(F.col(column).alias("v"))).over(w.rowsBetween(1 - length, 0)).getField("v"),
    }
    out = lookback(df, [key], order, length - 1, made, hot_rows)
    return out if keep_short else out.filter(F.size("sequence") == length)


def filled_sequence(sequence: str = "sequence") -> Column:
    """A sequence with its gaps filled by the value before, at its start by the first value; NULL where all are missing."""
    known = lambda c: F.filter(c, lambda x: x.isNotNull())
    filled = F.transform(sequence, lambda x, i: F.coalesce(
        x, F.try_element_at(known(F.slice(sequence, F.lit(1), i)), F.lit(-1)), F.try_element_at(known(F.col(sequence)), F.lit(1))))
    present = F.size(F.array_compact(sequence))
    # Only a sequence with a gap is gone through element by element.
    return F.when(present == F.size(sequence), F.col(sequence)).when(present > 0, filled)


def model_data(df: DataFrame, targets: Sequence[str], features: Sequence[str] | None = None) -> DataFrame:
    """Feature and target columns with the last gaps filled: median for features, 0 for targets."""
    from millwatch.operators.cleaning import impute_median

    features = list(features or numeric_columns(df, [*NOT_FEATURES, *targets]))
    return impute_median(df.select(*features, *targets), features, targets)
