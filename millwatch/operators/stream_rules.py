"""Rules of the sensor stream in batch form: z-scores, health, alerts, thresholds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millwatch.functions import scores as S
from millwatch.plans.slices import HOT_ROWS, lookback, running
from millwatch.schemas import NEUTRAL_HEALTH, SENSOR_RANGES, SENSOR_WEIGHTS

# Fixed values of the z-score rule and the alert rule.
Z_THRESHOLD = 2.0
Z_WINDOW = 100
Z_MIN_COUNT = 10
ALERT_CONFIDENCE = 0.8
ALERT_HEALTH = 0.3

READING_KEY = ["equipment_id", "sensor_type"]
READING_ORDER = ["timestamp", "reading_id"]


def complete(df: DataFrame, text: Sequence[str] = READING_KEY, value: str = "value") -> DataFrame:
    """Drop readings without an equipment, a sensor type or a value ('' counts as none)."""
    keep = F.col(value).isNotNull()
    for c in text:
        keep &= F.col(c).isNotNull() & (F.col(c) != "")
    return df.filter(keep)


def zscore_anomaly(
    df: DataFrame,
    keys: Sequence[str] = READING_KEY,
    order: Sequence[str] = READING_ORDER,
    value: str = "value",
    window: int = Z_WINDOW,
    threshold: float = Z_THRESHOLD,
    min_count: int = Z_MIN_COUNT,
    cold_start: str = "unit",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Flag readings far from the mean of the key's last ``window`` values, itself included.

    With fewer than ``min_count`` values the rule takes mean 0 and deviation 1
    (``cold_start='unit'``) or flags nothing (``'skip'``).
    """
    v = F.col(value)
    stats = {
        "_n": lambda w: F.count(v).over(w.rowsBetween(1 - window, 0)),
        "_mean": lambda w: F.avg(v).over(w.rowsBetween(1 - window, 0)),
        "_spread": lambda w: F.stddev_pop(v).over(w.rowsBetween(1 - window, 0)),
    }
    source = complete(df, keys, value)
    spread = F.col("_spread")
    warm = F.when(spread > 0, F.abs(v - F.col("_mean")) / spread).otherwise(F.lit(0.0))
    early = F.abs(v) if cold_start == "unit" else F.lit(0.0)
    z = F.col("z_score")
    return (
        lookback(source, keys, order, window - 1, stats, hot_rows)
        .select(*df.columns, F.when(F.col("_n") >= min_count, warm).otherwise(early).alias("z_score"))
        .withColumns({
            "is_anomaly": z > threshold,
            "anomaly_confidence": F.when(z > threshold, F.least(z / threshold, F.lit(1.0))).otherwise(F.lit(0.0)),
        })
    )


def sensor_scores(latest: Mapping[str, Column],
                  ranges: Mapping[str, tuple[float, float]] = SENSOR_RANGES) -> dict[str, Column]:
    """Health per sensor type of its latest value."""
    return {t: S.range_health(v, *ranges.get(t, (0.0, 1.0))) for t, v in latest.items()}


def weighted_health(parts: Mapping[str, Column], weights: Mapping[str, float] = SENSOR_WEIGHTS) -> Column:
    """Weighted mean over the types present; neutral when there is none."""
    total = sum((F.coalesce(c * weights[t], F.lit(0.0)) for t, c in parts.items()), F.lit(0.0))
    weight = sum((F.when(c.isNotNull(), weights[t]).otherwise(0.0) for t, c in parts.items()), F.lit(0.0))
    return F.when(weight > 0, total / weight).otherwise(F.lit(NEUTRAL_HEALTH))


def health_by_window(
    df: DataFrame,
    window: str = "1 day",
    order: Sequence[str] = READING_ORDER,
    weights: Mapping[str, float] = SENSOR_WEIGHTS,
    ranges: Mapping[str, tuple[float, float]] = SENSOR_RANGES,
    bucket: Column | None = None,
) -> DataFrame:
    """One row per equipment and time window: the score of each sensor type and overall.

    ``bucket`` replaces the window by any start-of-period expression.
    """
    start = F.window("timestamp", window)["start"] if bucket is None else bucket
    value, at = F.col("value"), F.struct(*order)
    latest = [
        F.max_by(value, F.when((F.col("sensor_type") == t) & value.isNotNull(), at)).alias(f"_last_{t}")
        for t in weights
    ]
    grouped = (
        df.withColumn("window_start", start)
        .groupBy("equipment_id", "window_start").agg(*latest)
    )
    scores = sensor_scores({t: F.col(f"_last_{t}") for t in weights}, ranges)
    grouped = grouped.select("equipment_id", "window_start", *[c.alias(f"{t}_score") for t, c in scores.items()])
    overall = weighted_health({t: F.col(f"{t}_score") for t in weights}, weights)
    return grouped.withColumn("overall_health", overall)


def multisensor_health(
    df: DataFrame,
    window: str = "1 day",
    order: Sequence[str] = READING_ORDER,
    weights: Mapping[str, float] = SENSOR_WEIGHTS,
    ranges: Mapping[str, tuple[float, float]] = SENSOR_RANGES,
) -> DataFrame:
    """Attach sensor and overall health of the reading's window to each reading.

    The scores are folded on the map side first, so what is joined back holds one row per
    equipment and window. A hot window of readings is split by adaptive skew join.
    """
    health = health_by_window(df, window, order, weights, ranges)
    health = health.withColumnsRenamed({"equipment_id": "_eq", "window_start": "_start"})
    rows = df.withColumn("window_start", F.window("timestamp", window)["start"])
    rows = rows.join(health, F.col("equipment_id").eqNullSafe(F.col("_eq")) & (F.col("window_start") == F.col("_start")))
    own = F.coalesce(*[F.when(F.col("sensor_type") == t, F.col(f"{t}_score")) for t in weights], F.lit(NEUTRAL_HEALTH))
    return rows.select(
        *df.columns, "window_start", own.alias("sensor_health"), "overall_health",
        S.health_status(F.col("overall_health")).alias("health_status"),
    )


def stream_alerts(
    df: DataFrame,
    confidence_threshold: float = ALERT_CONFIDENCE,
    health_threshold: float = ALERT_HEALTH,
    data: Sequence[str] | None = None,
) -> DataFrame:
    """Anomaly and health alerts of scored readings; one reading may raise both.

    Needs ``is_anomaly, anomaly_confidence, overall_health``. The alert time is the
    event time. ``data`` is the reading itself, as a struct.
    """
    who, conf, health = F.col("equipment_id"), F.col("anomaly_confidence"), F.col("overall_health")
    record = F.struct(*(data or df.columns))

    def alert(kind: str, severity: Column, message: Column) -> Column:
        return F.struct(
            F.col("timestamp"), who.alias("equipment_id"), F.lit(kind).alias("alert_type"),
            severity.alias("severity"), message.alias("message"), record.alias("data"),
        )

    anomaly = F.when(
        F.col("is_anomaly") & (conf >= confidence_threshold),
        alert("anomaly", F.when(conf > 0.9, "high").otherwise("medium"),
              F.format_string("Anomaly detected in %s with confidence %s", who, S.fixed(conf))),
    )
    poor = F.when(
        health <= health_threshold,
        alert("health", F.when(health <= 0.2, "critical").otherwise("high"),
              F.format_string("Poor health detected in %s (score: %s)", who, S.fixed(health))),
    )
    raised = F.filter(F.array(anomaly, poor), lambda a: a.isNotNull())
    return df.select(F.explode(raised).alias("a")).select("a.*")


def flagged_alerts(readings: DataFrame, window: str = "1 day", hot_rows: int = HOT_ROWS) -> DataFrame:
    """The whole stream path over a table of readings: z-score, health, alerts."""
    scored = multisensor_health(zscore_anomaly(readings, hot_rows=hot_rows), window)
    return stream_alerts(scored, data=["reading_id", "sensor_type", "value", "z_score"])


def threshold_health(df: DataFrame) -> DataFrame:
    """Per-type limit and per-type health of single readings."""
    score = S.single_reading_health(F.col("sensor_type"), F.col("value"))
    return df.withColumns({
        "is_anomaly": F.coalesce(F.col("value") > S.sensor_limit(F.col("sensor_type")), F.lit(False)),
        "health_score": score,
    }).withColumns({
        "health_status": S.health_status(F.col("health_score")),
        "maintenance_urgency": S.score_urgency(F.col("health_score")),
    })


def fixed_threshold_anomaly(df: DataFrame, threshold: float = 0.8, confidence: float = 0.8) -> DataFrame:
    """Readings above one fixed value, each with the same confidence."""
    return df.filter(F.col("value") > threshold).withColumns({
        "is_anomaly": F.lit(True), "anomaly_confidence": F.lit(confidence)})


def alert_message(alert_type: str, time: str = "timestamp") -> Column:
    """JSON message of an alert; absent fields read as 'unknown' or 0."""
    return F.to_json(F.struct(
        F.coalesce("equipment_id", F.lit("unknown")).alias("equipment_id"),
        F.coalesce("sensor_type", F.lit("unknown")).alias("sensor_type"),
        F.coalesce("value", F.lit(0.0)).alias("value"),
        F.coalesce("health_score", F.lit(0.0)).alias("health_score"),
        F.lit(alert_type).alias("alert_type"),
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    ))


def critical_health_alerts(df: DataFrame, limit: float = 0.2) -> DataFrame:
    """Readings whose own health is below the limit, with the message to send."""
    return threshold_health(df).filter(F.col("health_score") < limit).withColumn(
        "message", alert_message("critical_health"))


def fixed_threshold_alerts(df: DataFrame, threshold: float = 0.8, confidence: float = 0.8) -> DataFrame:
    """An alert for each reading above the fixed value, with the message to send."""
    return fixed_threshold_anomaly(df, threshold, confidence).withColumn("health_score", F.lit(None).cast("double")).withColumn(
        "message", alert_message("anomaly_detected"))


def anomaly_runs(
    df: DataFrame,
    min_length: int = 3,
    keys: Sequence[str] = READING_KEY,
    order: Sequence[str] = READING_ORDER,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Runs of at least ``min_length`` consecutive anomalies of a key.

    Inside a run, position minus anomalies so far is constant, so that difference names it.
    """
    marked = running(df, keys, order, {
        "_position": ("count", None),
        "_hits": ("sum", F.col("is_anomaly").cast("long")),
    }, hot_rows)
    return (
        marked.filter("is_anomaly")
        .groupBy(*keys, (F.col("_position") - F.col("_hits")).alias("run_id"))
        .agg(
            F.count(F.lit(1)).alias("run_length"),
            F.min("timestamp").alias("run_start"),
            F.max("timestamp").alias("run_end"),
            F.max("z_score").alias("peak_z"),
        )
        .filter(F.col("run_length") >= min_length)
    )


def window_stats(df: DataFrame, window: str = "1 hour", slide: str | None = None,
                 keys: Sequence[str] = ("sensor_type",)) -> DataFrame:
    """Mean, sample deviation, minimum, maximum and count of each time window.

    ``slide`` shorter than the window gives overlapping windows. Works on a stream too.
    """
    span = F.window("timestamp", window, slide) if slide else F.window("timestamp", window)
    return df.groupBy(span.alias("window"), *keys).agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count(F.lit(1)).alias("count"),
    ).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *keys, "mean", "std", "min", "max", "count",
    )


def throughput(df: DataFrame, payload: Column, period: str = "5 minutes") -> DataFrame:
    """Records and bytes arriving per period, with the mean and largest record."""
    size = F.octet_length(payload)
    return df.groupBy(F.window("timestamp", period)["start"].alias("period_start")).agg(
        F.count(F.lit(1)).alias("incoming_records"),
        F.sum(size).alias("incoming_bytes"),
        F.avg(size).alias("average_bytes"),
        F.max(size).alias("maximum_bytes"),
    )
