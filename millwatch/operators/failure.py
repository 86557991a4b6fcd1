"""Failure prediction: labels, forecasts, probabilities, recommendations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millwatch.functions.scores import clip, time_to_failure
from millwatch.operators.features import as_of
from millwatch.plans.slices import HOT_ROWS, epoch_us

DAY_US = 86_400_000_000.0
# Seasons of the forecast: name -> slot of a time.
SEASONS = {"week": F.weekday, "year": F.month, "day": F.hour}


def failure_label(df: DataFrame, failures: DataFrame, order: Sequence[str], hours: int = 72,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """1 if the equipment's next failure comes later than the row but within the horizon."""
    marked = as_of(df, failures, order, log_time="timestamp", name="next_failure", direction="next", hot_rows=hot_rows)
    gap = epoch_us(F.col("next_failure")) - epoch_us(F.col("timestamp"))
    return marked.withColumn("will_fail", F.coalesce((gap <= hours * 3_600_000_000).cast("int"), F.lit(0)))


def _days(ts: Column) -> Column:
    return epoch_us(ts) / DAY_US


def trend(df: DataFrame, value: str = "value", key: str = "equipment_id") -> DataFrame:
    """Straight line through each key's values over time, with the last time seen."""
    x, y = _days(F.col("timestamp")), F.col(value)
    return df.groupBy(key).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.max("timestamp").alias("last_seen"))


def season_indexes(df: DataFrame, trends: DataFrame, value: str = "value", key: str = "equipment_id",
                   seasons: Sequence[str] = ("week", "year")) -> DataFrame:
    """Mean of value over trend per season slot: rows (key, season, slot, index).

    The rows meet the trend of their key and are folded over all seasons at once. A hot
    key shrinks on the map side to its few slots before anything is moved.
    """
    t = trends.select(F.col(key).alias("_key"), "slope", "intercept")
    level = F.col("intercept") + F.col("slope") * _days(F.col("timestamp"))
    ratio = F.when(level != 0, F.col(value) / level)
    slots = F.array(*[F.struct(F.lit(s).alias("season"), SEASONS[s]("timestamp").alias("slot")) for s in seasons])
    rows = df.join(t, F.col(key) == F.col("_key")).select(key, ratio.alias("ratio"), F.inline(slots))
    return rows.groupBy(key, "season", "slot").agg(F.avg("ratio").alias("index"))


def forecast(df: DataFrame, periods: int = 30, value: str = "value", key: str = "equipment_id",
             seasons: Sequence[str] = ("week", "year"), step: str = "1 day", failure_threshold: float = 0.8) -> DataFrame:
    """Trend times season for the next ``periods`` steps of each key, and the failure risk."""
    trends = trend(df, value, key)
    indexes = season_indexes(df, trends, value, key, seasons)
    steps = f"sequence(last_seen + INTERVAL {step}, last_seen + {int(periods)} * INTERVAL {step}, INTERVAL {step})"
    ahead = F.expr(steps) if periods > 0 else F.slice(F.array("last_seen"), 1, 0)
    future = trends.select(key, "slope", "intercept", F.explode(ahead).alias("timestamp"))
    out = future.withColumn("yhat", F.col("intercept") + F.col("slope") * _days(F.col("timestamp")))
    for s in seasons:
        part = indexes.filter(F.col("season") == s).select(F.col(key).alias("_key"), F.col("slot").alias("_slot"), "index")
        out = out.join(part, (F.col(key) == F.col("_key")) & (SEASONS[s]("timestamp") == F.col("_slot")), "left")
        out = out.withColumn("yhat", F.col("yhat") * F.coalesce("index", F.lit(1.0))).drop("_key", "_slot", "index")
    return out.select(key, "timestamp", "yhat", failure_probability(F.col("yhat"), failure_threshold).alias("failure_probability"))


def failure_probability(yhat: Column, threshold: float = 0.8) -> Column:
    """How far a 0-1 forecast lies above the threshold, as a share of the room above it."""
    return clip(F.when(yhat > threshold, (yhat - threshold) / (1 - threshold)).otherwise(F.lit(0.0)))


def maintenance_recommendations(df: DataFrame, probability: str = "failure_probability", cut: float = 0.5,
                                urgent: float = 0.7) -> DataFrame:
    """Advice for each predicted failure."""
    p = F.col(probability)
    return df.filter(p > cut).withColumn("urgency", F.when(p > urgent, "high").otherwise("medium")).withColumns({
        "recommendation": F.format_string("Schedule maintenance - %s priority", F.col("urgency")),
        "estimated_failure_time": time_to_failure(p),
    })
