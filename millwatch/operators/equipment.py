"""Equipment queries: lists, details, history, requests with arrays of readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millwatch.functions.scores import fixed, health_status, period_start, score_urgency
from millwatch.operators.alerts import PAGE_SIZE, page
from millwatch.operators.stream_rules import Z_THRESHOLD, health_by_window, zscore_anomaly
from millwatch.plans.slices import HOT_ROWS, epoch_us, running
from millwatch.schemas import SENSOR_WEIGHTS

HISTORY_PAGE = 1000
# Fixed value: the longest page of a list.
MAX_PAGE = 1000
STABLE_SLOPE = 1e-3


def latest_health(health: DataFrame) -> DataFrame:
    """Newest overall health of each equipment, from health by window."""
    return health.groupBy("equipment_id").agg(
        F.max_by("overall_health", "window_start").alias("health_score"), F.max("window_start").alias("last_updated"))


def equipment_list(dimension: DataFrame, health: DataFrame, status: str | None = None, location: str | None = None,
                   limit: int = PAGE_SIZE, offset: int = 0) -> DataFrame:
    """A page of equipment with its current health, filtered by status and location."""
    wanted = dimension
    if status is not None:
        wanted = wanted.filter(F.col("status") == status)
    if location is not None:
        wanted = wanted.filter(F.col("location") == location)
    # Page first. Its ids, at most MAX_PAGE, then keep all other readings out of the health.
    if limit > MAX_PAGE:
        raise ValueError(f"A page holds at most {MAX_PAGE} rows")
    listed = page(wanted, ["equipment_id"], limit, offset)
    asked = health.join(F.broadcast(listed.select("equipment_id")), "equipment_id", "left_semi")
    out = listed.join(latest_health(asked), "equipment_id", "left")
    return out.withColumn("health_status", F.when(F.col("health_score").isNotNull(), health_status(F.col("health_score"))))


def equipment_detail(dimension: DataFrame, log: DataFrame, order: Sequence[str], page_size: int = HISTORY_PAGE,
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each equipment with its maintenance history nested, in pages of bounded length.

    A history is never gathered whole: entries are numbered along the equipment and every
    ``page_size`` of them make one array. Equipment without history gets one empty page.
    """
    numbered = running(log, ["equipment_id"], order, {"_n": ("count", None)}, hot_rows)
    entry = F.struct("date", "type", *[c for c in order if c not in ("date", "type")])
    pages = numbered.groupBy("equipment_id", F.floor((F.col("_n") - 1) / page_size).cast("int").alias("history_page")).agg(
        F.sort_array(F.collect_list(entry)).alias("maintenance_history"))
    out = dimension.withColumn("specifications", F.create_map(
        F.lit("type"), F.col("type"), F.lit("site"), F.col("site"))).join(pages, "equipment_id", "left")
    return out.withColumn("history_page", F.coalesce("history_page", F.lit(0)))


def without_readings(dimension: DataFrame, readings: DataFrame) -> DataFrame:
    """Equipment that never reported. Ids are made distinct on the map side first."""
    return dimension.join(readings.select("equipment_id").distinct(), "equipment_id", "left_anti")


def with_alerts(dimension: DataFrame, alerts: DataFrame) -> DataFrame:
    return dimension.join(alerts.select("equipment_id").distinct(), "equipment_id", "left_semi")


def health_history(readings: DataFrame, granularity: str = "day", start: str | None = None, end: str | None = None,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Health, status, anomalies and urgency of each equipment and period in a date range.

    Two aggregates of the readings meet on (equipment, period); the rows never join.
    """
    bucket = period_start(F.col("timestamp"), granularity)
    if end is not None:
        # Scores look back only: what comes later is left out before they are made.
        readings = readings.filter(F.col("timestamp") < F.lit(end).cast("timestamp_ntz"))
    scored = zscore_anomaly(readings, hot_rows=hot_rows)
    if start is not None:
        readings, scored = (x.filter(F.col("timestamp") >= F.lit(start).cast("timestamp_ntz")) for x in (readings, scored))
    health = health_by_window(readings, bucket=bucket).select("equipment_id", "window_start", "overall_health")
    anomalies = scored.groupBy("equipment_id", bucket.alias("window_start")).agg(
        F.sum(F.col("is_anomaly").cast("long")).alias("anomalies"))
    h = F.col("overall_health")
    return health.join(anomalies, ["equipment_id", "window_start"], "left").select(
        "equipment_id", F.col("window_start").alias("timestamp"), h.alias("health_score"),
        health_status(h).alias("status"), F.coalesce("anomalies", F.lit(0)).alias("anomalies"),
        score_urgency(h).alias("maintenance_urgency"))


def health_summary(history: DataFrame) -> DataFrame:
    """Average health, trend, anomalies and critical periods of each equipment.

    The trend is the sign of the slope per day, ``stable`` within ±0.001.
    """
    day = epoch_us(F.col("timestamp")) / 86_400_000_000.0
    slope = F.coalesce(F.regr_slope(F.col("health_score"), day), F.lit(0.0))
    return history.groupBy("equipment_id").agg(
        F.avg("health_score").alias("average_health"), slope.alias("slope"),
        F.sum("anomalies").alias("anomaly_count"),
        F.sum((F.col("maintenance_urgency") == "critical").cast("long")).alias("critical_alerts"),
    ).withColumn("trend", F.when(F.col("slope") > STABLE_SLOPE, "improving")
                 .when(F.col("slope") < -STABLE_SLOPE, "declining").otherwise("stable"))


def array_anomaly(requests: DataFrame, request_id: str = "request_id", readings: str = "sensor_readings",
                  threshold: float = Z_THRESHOLD) -> DataFrame:
    """Judge an array of readings per request: any anomaly, its confidence and highest score."""
    rows = requests.select(F.col(request_id), F.posexplode(readings).alias("position", "value"))
    scored = zscore_anomaly(rows.withColumn(request_id, F.col(request_id).cast("string")),
                            [request_id], ["position"], threshold=threshold)
    return scored.groupBy(request_id).agg(
        F.max("is_anomaly").alias("is_anomaly"), F.max("anomaly_confidence").alias("confidence"),
        F.max("z_score").alias("anomaly_score"), F.count(F.lit(1)).alias("readings"))


def component_scores(health: DataFrame, types: Sequence[str] = tuple(SENSOR_WEIGHTS)) -> DataFrame:
    """Overall score, status and urgency, and a map of the score of each sensor type present."""
    entries = F.array(*[F.struct(F.lit(t).alias("type"), F.col(f"{t}_score").alias("score")) for t in sorted(types)])
    present = F.filter(entries, lambda e: e["score"].isNotNull())
    h = F.col("overall_health")
    return health.select(
        "equipment_id", "window_start", h.alias("overall_score"), health_status(h).alias("status"),
        score_urgency(h).alias("maintenance_urgency"), F.map_from_entries(present).alias("component_scores"))


def flatten_map(scores: Column, places: int = 6) -> Column:
    """A map as text ``name=value;…`` in key order, for output and comparison."""
    entries = F.array_sort(F.map_entries(scores))
    return F.array_join(F.transform(entries, lambda e: F.concat(
        e["key"], F.lit("="), fixed(e["value"], places))), ";")
