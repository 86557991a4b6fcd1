"""Operational metrics: counters, gauges, histograms, summaries and component status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millwatch.functions.scores import period_start

# The metrics each component knows, by kind.
KNOWN_METRICS = {
    "data_ingestion": {"records_processed": "counter", "processing_time": "timing", "errors": "counter"},
    "model_inference": {"predictions_made": "counter", "inference_time": "timing", "errors": "counter"},
    "anomaly_detection": {"anomalies_detected": "counter", "false_positives": "counter", "detection_time": "timing"},
    "health_scoring": {"scores_calculated": "counter", "calculation_time": "timing", "critical_alerts": "counter"},
}
# Upper bounds of the histogram buckets.
BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0, float("inf")]
STATES = ["healthy", "degraded", "unhealthy"]


def component_metrics(log: DataFrame, order: Sequence[str] = ("timestamp", "metric_id")) -> DataFrame:
    """Counters add up, gauges and timings keep the last value; unknown names are ignored.

    ``log`` has (component, metric, value) and the order columns. The table of known
    names has twelve fixed rows.
    """
    known = [(c, m, k) for c, metrics in KNOWN_METRICS.items() for m, k in metrics.items()]
    names = log.sparkSession.createDataFrame(known, "component string, metric string, kind string")
    rows = log.join(F.broadcast(names), ["component", "metric"])
    return rows.groupBy("component", "metric", "kind").agg(
        F.sum("value").alias("_sum"), F.max_by("value", F.struct(*order)).alias("_last"),
    ).select("component", "metric", F.when(F.col("kind") == "counter", F.col("_sum")).otherwise(F.col("_last")).alias("value"))


def metric_histogram(df: DataFrame, value: str, by: Sequence[str] = ("component",),
                     buckets: Sequence[float] = BUCKETS) -> DataFrame:
    """Cumulative bucket counts per group, with the sum and count of all observations."""
    counts = df.groupBy(*by).agg(
        *[F.sum((F.col(value) <= b).cast("long")).alias(f"_b{i}") for i, b in enumerate(buckets)],
        F.sum(value).alias("observed_sum"), F.count(value).alias("observed_count"))
    rows = F.array(*[
        F.struct(F.lit("+Inf" if b == float("inf") else str(b)).alias("le"), F.col(f"_b{i}").alias("cumulative_count"))
        for i, b in enumerate(buckets)])
    return counts.select(*by, "observed_sum", "observed_count", F.inline(rows))


def metric_summary(df: DataFrame, value: str, granularity: str = "day", by: Sequence[str] = ("component",)) -> DataFrame:
    """Average and peak per period, and once over all periods (period NULL), by rollup."""
    spans = df.withColumn("period", period_start(F.col("timestamp"), granularity))
    sets = [[*by, "period"], list(by)]
    return spans.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in [*by, "period"]]).agg(
        F.avg(value).alias("average"), F.max(value).alias("peak"), F.count(F.lit(1)).alias("samples"))


def component_status(df: DataFrame, value: str, degraded: float, unhealthy: float,
                     order: Sequence[str] = ("timestamp", "metric_id")) -> DataFrame:
    """State of each component at its latest metric, and the worst state over all."""
    latest = df.groupBy("component").agg(F.max_by(F.struct("timestamp", value), F.struct(*order)).alias("_m"))
    level = F.when(F.col(f"_m.{value}") > unhealthy, 2).when(F.col(f"_m.{value}") > degraded, 1).otherwise(0)
    states = F.array(*[F.lit(s) for s in STATES])
    rows = latest.select("component", level.alias("_level"), F.col("_m.timestamp").alias("last_seen"),
                         F.col(f"_m.{value}").alias("latest"))
    worst = rows.agg(F.max("_level")).scalar()
    return rows.select("component", states[F.col("_level")].alias("status"), "last_seen", "latest",
                       states[worst].alias("overall_status"))
