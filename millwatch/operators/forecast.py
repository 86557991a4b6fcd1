"""Forecast of each key by a bent trend times seasons, over its history and the steps after it.

Both parts are least squares by normal equations. Rows are dealt by key, those of a key with very many in
lots, and each task folds them to sums of products, one vector a key and lot; the vectors add up per key, and each
key solves one small system. A vector is a hundred times as large as a row, so it must stand for many.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from millwatch.operators.failure import DAY_US, failure_probability
from millwatch.plans.slices import epoch_us
from millwatch.plans.storage import written
from millwatch.session import ship

#: Season -> (length in days, number of sine and cosine pairs).
SEASONS = {"year": (365.25, 10), "week": (7.0, 3), "day": (1.0, 4)}
#: Bends of the trend, spread evenly over this share of the history of all keys.
BENDS, BEND_SHARE = 25, 0.8
#: Penalties on bends and on seasons, against values scaled to their key's largest.
STIFFNESS, DAMPING, LEAST = 1.0, 0.01, 1e-9
#: Keys that a task holds at once before it hands on what it has.
KEYS_AT_ONCE = 4096
#: Rows of one key that a task folds; a key with more is dealt out in lots.
LOT_ROWS = 2_000_000


def _upper(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n)


def _dealt(df: DataFrame, key: str, lot_rows: int) -> DataFrame:
    """The rows of a key side by side in one task; a key with more than ``lot_rows`` in lots of about so many."""
    sizes = df.groupBy(F.col(key).alias("_key")).agg(F.ceil(F.count(F.lit(1)) / lot_rows).alias("_lots")).where(F.col("_lots") > 1)
    found = sizes.collect()  # at most rows / lot_rows
    lot = F.lit(0)
    if found:
        df = df.join(F.broadcast(df.sparkSession.createDataFrame(found, sizes.schema)), F.col(key) == F.col("_key"), "left")
        lot = F.coalesce(F.pmod(F.xxhash64(*[c for c in df.columns if c not in (key, "_key", "_lots")]), F.col("_lots")), F.lit(0))
    return df.withColumn("_lot", lot).drop("_key", "_lots").repartition(key, "_lot").sortWithinPartitions(key).drop("_lot")


def _parts(df: DataFrame, key: str, columns: int, design: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
           lot_rows: int = LOT_ROWS) -> DataFrame:
    """(key, sums), one row a key and lot: the upper triangle of X'X and then X'y, with X and y made of the other columns."""
    rows, cols = _upper(columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}

        def out() -> pd.DataFrame:
            return pd.DataFrame({"key": list(held), "sums": [s.tolist() for s in held.values()]})

        for batch in batches:
            numbers = batch.drop(columns="key").to_numpy(dtype=object)
            for name, at in batch.groupby("key", sort=False).indices.items():
                x, y = design(numbers[at])
                product = x.T @ x
                sums = np.concatenate([product[rows, cols], x.T @ y])
                held[name] = held[name] + sums if name in held else sums
            if len(held) >= KEYS_AT_ONCE:
                yield out()
                held.clear()
        if held:
            yield out()

    ship(df.sparkSession)
    return _dealt(df.withColumnRenamed(key, "key"), "key", lot_rows).mapInPandas(run, "key string, sums array<double>")


def _folded(parts: DataFrame, key: str) -> DataFrame:
    """(key, sums): the sums of all parts of a key."""
    return parts.groupBy("key").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")).withColumnRenamed("key", key)


def _solved(sums: Column, penalties: Sequence[float]) -> Column:
    """Coefficients from the sums: (X'X + penalties) b = X'y."""
    n = len(penalties)
    rows, cols = _upper(n)

    @F.pandas_udf("array<double>")
    def solve(parts: pd.Series) -> pd.Series:
        found = []
        for s in parts:
            a = np.zeros((n, n))
            a[rows, cols] = a[cols, rows] = s[:len(rows)]
            found.append(np.linalg.solve(a + np.diag(penalties), s[len(rows):]).tolist())
        return pd.Series(found)

    return solve(sums)


def _trend_terms(day: np.ndarray, first: float, span: float, bends: Sequence[float]) -> np.ndarray:
    x = (day - first) / span
    return np.column_stack([np.ones_like(x), x, *[np.maximum(x - b, 0.0) for b in bends]])


def _season_terms(day: np.ndarray, seasons: Mapping[str, tuple[float, int]]) -> np.ndarray:
    turns = [(2 * math.pi * k / length) * day for length, n in seasons.values() for k in range(1, n + 1)]
    return np.column_stack([f(t) for t in turns for f in (np.sin, np.cos)]) if turns else np.zeros((len(day), 0))


@dataclass
class Forecast:
    """Fitted trends and seasons: one row a key, with the largest value, the last time and both lists of coefficients."""

    fitted: DataFrame
    history: DataFrame
    key: str
    first: float
    span: float
    bends: list[float]
    seasons: dict[str, tuple[float, int]]

    def predict(self, periods: int = 30, step: str = "1 day", failure_threshold: float = 0.8) -> DataFrame:
        """(key, timestamp, trend, season, yhat, failure_probability) of every time seen and of ``periods`` steps after the last."""
        day = epoch_us(F.col("timestamp")) / DAY_US
        seen = self.history.select(self.key, "timestamp").distinct()
        if periods > 0:
            ahead = f"sequence(last_seen + INTERVAL {step}, last_seen + {int(periods)} * INTERVAL {step}, INTERVAL {step})"
            seen = seen.unionByName(self.fitted.select(self.key, F.explode(F.expr(ahead)).alias("timestamp")))
        rows = seen.join(self.fitted.drop("last_seen"), self.key).withColumn("_day", day).withColumn("_x", (F.col("_day") - self.first) / self.span)
        out = rows.withColumn("trend", F.col("scale") * _line(F.col("_x"), self.bends)).withColumn("season", _wave(F.col("_day"), self.seasons))
        yhat = F.col("trend") * (1 + F.col("season"))
        return out.select(self.key, "timestamp", "trend", "season", yhat.alias("yhat"), failure_probability(yhat, failure_threshold).alias("failure_probability"))


def _line(x: Column, bends: Sequence[float]) -> Column:
    a = F.col("trend_terms")
    return sum((a[j + 2] * F.greatest(x - b, F.lit(0.0)) for j, b in enumerate(bends)), a[0] + a[1] * x)


def _wave(day: Column, seasons: Mapping[str, tuple[float, int]]) -> Column:
    out, at = F.lit(0.0), 0
    for length, n in seasons.values():
        for k in range(1, n + 1):
            turn = F.lit(2 * math.pi * k / length) * day
            out = out + F.col("season_terms")[at] * F.sin(turn) + F.col("season_terms")[at + 1] * F.cos(turn)
            at += 2
    return out


def fit_forecast(df: DataFrame, value: str = "value", key: str = "equipment_id", seasons: Mapping[str, tuple[float, int]] = SEASONS,
                 bends: int = BENDS, stiffness: float = STIFFNESS, damping: float = DAMPING, lot_rows: int = LOT_ROWS) -> Forecast:
    """Fit value = trend(t) * (1 + season(t)) for each key.

    The trend is a line that may bend at ``bends`` instants, even over the first part of the time that
    all keys span; ``stiffness`` penalises bends. Seasons are sums of sines and cosines, fitted to
    what the trend leaves, weighed by the trend; ``damping`` penalises them. Rows without key, time or
    value, or with a value that is no number, take no part; a key whose values are all 0 gets a flat 0. No rows, no output.
    """
    usable = df.where(F.col(key).isNotNull() & F.col("timestamp").isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    rows = usable.select(F.col(key).cast("string").alias(key), "timestamp", (epoch_us(F.col("timestamp")) / DAY_US).alias("day"), F.col(value).cast("double").alias("y"))
    first, last = rows.agg(F.min("day"), F.max("day")).first()
    first, span = first or 0.0, max((last or 0.0) - (first or 0.0), 1.0)
    places = [BEND_SHARE * (j + 1) / (bends + 1) for j in range(bends)]
    seasons = dict(seasons)

    def trend_design(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        day, y = numbers[:, 0].astype(float), numbers[:, 1].astype(float)
        return _trend_terms(day, first, span, places), y

    sizes = rows.groupBy(key).agg(F.max(F.abs("y")).alias("scale"), F.max("timestamp").alias("last_seen"))
    sizes = sizes.withColumn("scale", F.when(F.col("scale") > 0, F.col("scale")).otherwise(1.0))
    n = 2 + bends
    folded = _folded(_parts(rows.select(key, "day", "y"), key, n, trend_design, lot_rows), key).join(sizes, key)
    # The sums are linear in y: scaled to the key's largest value after they are folded, not row by row.
    products = n * (n + 1) // 2
    scaled = F.transform("sums", lambda s, i: F.when(i < products, s).otherwise(s / F.col("scale")))
    trends = folded.withColumn("trend_terms", _solved(scaled, [LEAST, LEAST, *[stiffness] * bends])).select(key, "scale", "last_seen", "trend_terms")
    trends = written(trends, "trends")  # read for the seasons and for the forecast

    terms = 2 * sum(k for _, k in seasons.values())
    if not terms:
        fitted = trends.withColumn("season_terms", F.array().cast("array<double>"))
        return Forecast(fitted, rows, key, first, span, places, seasons)

    def season_design(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        day, y, level = (numbers[:, i].astype(float) for i in range(3))
        return _season_terms(day, seasons) * level[:, None], y - level

    level = _line((F.col("day") - first) / span, places)
    told = rows.join(trends, key).select(key, "day", (F.col("y") / F.col("scale")).alias("y"), level.alias("level"))
    waves = _folded(_parts(told, key, terms, season_design, lot_rows), key).select(key, _solved(F.col("sums"), [damping] * terms).alias("season_terms"))
    return Forecast(written(trends.join(waves, key), "forecast"), rows, key, first, span, places, seasons)
