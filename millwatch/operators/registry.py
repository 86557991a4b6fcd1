"""Model registry queries over an event log (run_id, model, version, stage, timestamp, metrics)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ORDER = ["timestamp", "run_id"]


def best_run(log: DataFrame, metric: str, ascending: bool = False) -> DataFrame:
    """The best run of each model by one metric; ties go to the smaller run id."""
    rank = F.col(metric) if ascending else -F.col(metric)
    return log.filter(F.col(metric).isNotNull()).groupBy("model").agg(
        F.min_by("run_id", F.struct(rank, F.col("run_id"))).alias("run_id"),
        (F.min(metric) if ascending else F.max(metric)).alias(metric))


def current_stages(log: DataFrame) -> DataFrame:
    """The stage each model version stands in now: that of its newest event."""
    return log.groupBy("model", "version").agg(
        F.max_by("stage", F.struct(*ORDER)).alias("stage"), F.max("timestamp").alias("last_updated"))


def latest_versions(log: DataFrame) -> DataFrame:
    """Newest version of each model in each stage, with the address to load it from."""
    return current_stages(log).groupBy("model", "stage").agg(
        F.max("version").alias("version"), F.count(F.lit(1)).alias("versions"),
    ).withColumn("uri", F.format_string("models:/%s/%d", F.col("model"), F.col("version")))


def promote(log: DataFrame, model: str, version: int, stage: str, at: str, run_id: int) -> DataFrame:
    """The log with one more event: a version moved to a stage."""
    event = log.sparkSession.createDataFrame(
        [(run_id, model, version, stage, at)], "run_id long, model string, version long, stage string, timestamp string")
    event = event.withColumn("timestamp", F.col("timestamp").cast(log.schema["timestamp"].dataType))
    return log.unionByName(event, allowMissingColumns=True)


def production_models(log: DataFrame) -> DataFrame:
    return latest_versions(log).filter(F.col("stage") == "Production")


def model_performance(log: DataFrame, start: str, end: str) -> DataFrame:
    """Mean metrics of each model in a date range, with run count and error rate."""
    ts = F.col("timestamp")
    inside = log.filter((ts >= F.lit(start).cast("timestamp_ntz")) & (ts <= F.lit(end).cast("timestamp_ntz")))
    return inside.groupBy("model").agg(
        F.avg("accuracy").alias("accuracy"), F.avg("f1_score").alias("f1_score"),
        F.count(F.lit(1)).alias("prediction_count"), F.max("timestamp").alias("last_updated"),
    ).withColumn("error_rate", 1 - F.col("accuracy"))
