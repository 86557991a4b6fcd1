"""Health scoring of wide rows: sensors, clusters, reports, schedules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millwatch.functions.scores import banded, clip, fixed, health_status, range_health, score_urgency
from millwatch.schemas import NEUTRAL_HEALTH, SENSOR_RANGES, SENSOR_WEIGHTS

# Order of urgencies and days until maintenance.
URGENCY_ORDER = {"critical": 0, "high": 1, "medium": 2, "low": 3}
URGENCY_DAYS = {"critical": 1, "high": 1, "medium": 7, "low": 30}


def wide_sensor_health(sensor_of: Mapping[str, str], weights: Mapping[str, float] = SENSOR_WEIGHTS,
                       ranges: Mapping[str, tuple[float, float]] = SENSOR_RANGES) -> Column:
    """Weighted health of one row from a mapping of column to sensor type."""
    known = [(c, t) for c, t in sensor_of.items() if t in weights]
    if not known:
        return F.lit(NEUTRAL_HEALTH)
    parts = [
        (range_health(F.col(c), *ranges[t]) if t in ranges else F.lit(NEUTRAL_HEALTH)) * weights[t] for c, t in known
    ]
    return sum(parts[1:], parts[0]) / sum(weights[t] for _, t in known)


def centre_distance(columns: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """Distance of a row to the nearest centre."""
    squares = []
    for centre in centres:
        terms = [(F.col(c) - float(v)) * (F.col(c) - float(v)) for c, v in zip(columns, centre, strict=True)]
        squares.append(sum(terms[1:], terms[0]))
    return F.sqrt(F.least(*squares) if len(squares) > 1 else squares[0])


def distance_health(df: DataFrame, distance: str = "distance") -> DataFrame:
    """1 at a centre, 0 at the farthest row; the farthest distance is read as a scalar."""
    farthest = df.agg(F.max(distance)).scalar()
    return df.withColumn("health_score", clip(1 - F.col(distance) / F.nullif(farthest, F.lit(0.0))))


def health_report(df: DataFrame, score: str = "health_score") -> DataFrame:
    """Status and urgency of each score, and whether it is critical."""
    s = F.col(score)
    return df.withColumns({
        "status": health_status(s), "urgency": score_urgency(s), "is_critical": (s <= 0.2).cast("int")})


def maintenance_schedule(df: DataFrame, as_of: str, days_ahead: int = 30, score: str = "health_score") -> DataFrame:
    """Recommended date by urgency, most urgent first, up to ``days_ahead`` days."""
    report = health_report(df, score)
    days, rank = F.lit(URGENCY_DAYS["low"]), F.lit(URGENCY_ORDER["low"])
    for u in ("medium", "high", "critical"):
        days = F.when(F.col("urgency") == u, URGENCY_DAYS[u]).otherwise(days)
        rank = F.when(F.col("urgency") == u, URGENCY_ORDER[u]).otherwise(rank)
    return (
        report.withColumn("_days", days).filter(F.col("_days") <= days_ahead)
        .withColumns({
            "recommended_date": F.date_add(F.lit(as_of).cast("date"), F.col("_days")),
            "description": F.format_string("Health score: %s - %s condition", fixed(F.col(score)), F.col("status")),
        })
        .orderBy(rank, "recommended_date").drop("_days")
    )
