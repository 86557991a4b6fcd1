"""Column expressions for health scores, bands and lookups. All stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from millwatch.schemas import DEFAULT_LIMIT, NEUTRAL_HEALTH, SENSOR_LIMITS


def clip(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Clamp to [low, high]; NULL stays NULL (greatest and least alone would skip it)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def range_health(value: Column, low: Column | float, high: Column | float) -> Column:
    """1 at the low end of the range, 0 at the high end."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return 1.0 - clip((value - low) / (high - low))


def banded(c: Column, bands: list[tuple[Column, str]], default: str) -> Column:
    out = None
    for condition, label in bands:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return out.otherwise(default)


def health_status(score: Column) -> Column:
    # Status bands.
    return banded(score, [
        (score >= 0.8, "excellent"),
        (score >= 0.6, "good"),
        (score >= 0.4, "fair"),
        (score >= 0.2, "poor"),
    ], "critical")


def score_urgency(score: Column) -> Column:
    """Maintenance urgency of a health score (upper bounds belong to the band)."""
    # Urgency bands of a score.
    return banded(score, [
        (score <= 0.2, "critical"),
        (score <= 0.4, "high"),
        (score <= 0.6, "medium"),
    ], "low")


def target_urgency(score: Column) -> Column:
    """Urgency used as a training target: three bands, upper bounds excluded."""
    # Urgency bands of a training target.
    return banded(score, [(score < 0.3, "high"), (score < 0.6, "medium")], "low")


def time_to_failure(probability: Column) -> Column:
    # Time bands of a failure probability.
    return banded(probability, [
        (probability > 0.9, "Within 24 hours"),
        (probability > 0.7, "Within 1 week"),
        (probability > 0.5, "Within 1 month"),
    ], "More than 1 month")


def lookup(key: Column, table: Mapping[str, float], default: float | None = None) -> Column:
    """Value of a small fixed table by key, as a map literal: no join, no shuffle."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    found = F.element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def sensor_limit(sensor_type: Column) -> Column:
    return lookup(sensor_type, SENSOR_LIMITS, DEFAULT_LIMIT)


def single_reading_health(sensor_type: Column, value: Column) -> Column:
    """Health of one reading by its type; a missing value or unknown type is neutral."""
    score = (
        F.when(sensor_type == "vibration", 1.0 - value)
        .when(sensor_type == "temperature", 1.0 - (value - 20.0) / 60.0)
        .when(sensor_type == "pressure", 1.0 - F.abs(value - 50.0) / 50.0)
        .otherwise(F.lit(NEUTRAL_HEALTH))
    )
    return F.coalesce(clip(score), F.lit(NEUTRAL_HEALTH))


def row_mean(columns: list[Column]) -> Column:
    """Mean of the non-null columns of a row; NULL when all are NULL."""
    total = sum((F.coalesce(c, F.lit(0.0)) for c in columns), F.lit(0.0))
    present = sum((c.isNotNull().cast("int") for c in columns), F.lit(0))
    return F.when(present > 0, total / present)


def row_median(columns: list[Column]) -> Column:
    """Median of the non-null columns of one row; NULL when all are NULL."""
    # Largest first, as this puts NULLs last; the middle is the same from either end.
    ordered = F.sort_array(F.array(*columns), asc=False)
    n = sum((c.isNotNull().cast("int") for c in columns), F.lit(0))
    low, high = F.get(ordered, F.floor((n - 1) / 2).cast("int")), F.get(ordered, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / 2.0)


def whole_days(later: Column, earlier: Column) -> Column:
    """Elapsed whole days, floored (not a count of midnights)."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("long")


def period_start(ts: Column, unit: str) -> Column:
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def fixed(c: Column, places: int = 2) -> Column:
    """A number as text with so many places, rounded by its exact value, ties to even, as C, SQL and Python do.

    ``format_string`` rounds the shortest decimals of a double instead: 0.245, a little less than that, gives it 0.25.
    """
    unit = 10 ** places
    below = F.floor(c * float(unit))
    # Both parts have few enough bits for exact products, so the sign of what is left over the tie is exact.
    high = c.cast("float").cast("double")
    over = (high * float(2 * unit) - (2 * below + 1)) + (c - high) * float(2 * unit)
    whole = below + ((over > 0) | ((over == 0) & (below % 2 != 0))).cast("int")
    text = lambda x: F.format_string(f"%.{places}f", x)
    return F.when(F.abs(c) < 2.0 ** 52 / (2 * unit), text(whole / F.lit(float(unit)))).otherwise(text(c))
