"""Data drift, model performance and the decision to retrain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millwatch.functions.scores import banded
from millwatch.operators.cleaning import keep_recent, numeric_columns

# Fixed values of the drift and performance rules.
DRIFT_THRESHOLD = 0.1
PERFORMANCE_THRESHOLD = 0.8
PERFORMANCE_DAYS = 7
REFERENCE_DAYS = 30


def recommendation(has_drift: Column, score: Column) -> Column:
    # Wording and bands of the recommendation.
    return banded(score, [
        (~has_drift, "No retraining needed"),
        (score > 0.3, "Immediate retraining required"),
        (score > 0.2, "Retraining recommended within 24 hours"),
    ], "Retraining recommended within 1 week")


def feature_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None,
                  threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Drift of each numeric feature: shift of mean and deviation in reference deviations."""
    columns = [c for c in (columns or numeric_columns(reference)) if c in current.columns]
    both = reference.select(*columns, F.lit(True).alias("_ref")).unionByName(
        current.select(*columns, F.lit(False).alias("_ref")))
    # Both sides in one pass: four partial aggregates per feature, one output row.
    row = both.agg(*[
        f(F.when(F.col("_ref") == side, F.col(c))).alias(f"{c}|{name}")
        for c in columns for side, f, name in (
            (True, F.avg, "rm"), (True, F.stddev_samp, "rs"), (False, F.avg, "cm"), (False, F.stddev_samp, "cs"))
    ])
    parts = F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(f"`{c}|{n}`").alias(n) for n in ("rm", "rs", "cm", "cs")])
        for c in columns
    ])
    moved = (F.abs(F.col("cm") - F.col("rm")) + F.abs(F.col("cs") - F.col("rs"))) / (F.col("rs") + 1e-8) / 2
    return row.select(F.inline(parts)).select("feature", moved.alias("drift")).withColumn(
        "has_drift", F.col("drift") > threshold)


def drift_summary(drifts: DataFrame) -> DataFrame:
    """Overall verdict: any feature drifted; the score is the mean over all features."""
    return drifts.agg(
        F.max("has_drift").alias("has_drift"), F.avg("drift").alias("drift_score"), F.max("drift").alias("max_drift"),
    ).withColumn("recommendation", recommendation(F.col("has_drift"), F.col("drift_score")))


def with_summary(drifts: DataFrame) -> DataFrame:
    """Each feature's drift beside the overall verdict: a window over as many rows as there are features, so nothing is scanned again."""
    whole = Window.partitionBy()
    any_drift, score = F.max("has_drift").over(whole), F.avg("drift").over(whole)
    return drifts.withColumns({"any_drift": any_drift, "drift_score": score, "max_drift": F.max("drift").over(whole)}).withColumn(
        "recommendation", recommendation(F.col("any_drift"), F.col("drift_score")))


def refresh_reference(reference: DataFrame, new: DataFrame, as_of: str, days: int = REFERENCE_DAYS) -> DataFrame:
    """Append new rows to the reference and keep the recent days of it."""
    return keep_recent(reference.unionByName(new, allowMissingColumns=True), as_of, days)


def retrain_decision(df: DataFrame, as_of: str, columns: Sequence[str], days: int = PERFORMANCE_DAYS,
                     reference_days: int = REFERENCE_DAYS) -> DataFrame:
    """Drift of the last ``days`` days against days -30 to -1; retrain only if there is any."""
    end = F.lit(as_of).cast("timestamp_ntz")
    recent = df.filter((F.col("timestamp") >= end - F.expr(f"INTERVAL {days} DAYS")) & (F.col("timestamp") <= end))
    base = df.filter((F.col("timestamp") >= end - F.expr(f"INTERVAL {reference_days} DAYS"))
                     & (F.col("timestamp") <= end - F.expr("INTERVAL 1 DAY")))
    return drift_summary(feature_drift(base, recent, columns)).withColumn("retrain", F.col("has_drift"))


def should_retrain(log: DataFrame, as_of: str, metrics: Sequence[str], threshold: float = PERFORMANCE_THRESHOLD,
                   days: int = PERFORMANCE_DAYS, order: Sequence[str] = ("timestamp", "run_id")) -> DataFrame:
    """Per model: is the mean of its newest metrics below the threshold?

    Records of age ``days`` whole days still count; a model without any is left alone.
    """
    age = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {days + 1} DAYS")
    fresh = F.col("timestamp") > age
    newest = log.groupBy("model").agg(
        F.max_by(F.struct(*order, *metrics), F.when(fresh, F.struct(*order))).alias("r"))
    overall = sum((F.col(f"r.{m}") for m in metrics), F.lit(0.0)) / float(len(metrics))
    return newest.select(
        "model", F.col("r.run_id").alias("run_id"), overall.alias("performance"),
        F.coalesce(overall < threshold, F.lit(False)).alias("should_retrain"))
