"""Fitted models on disk, by name and version, with a table of what is there."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F


def save_model(spark: SparkSession, model: PipelineModel, base: str, name: str, version: int,
               metrics: Mapping[str, float] | None = None, at: str | None = None) -> str:
    path = f"{base}/models/{name}/version={version}"
    model.write().overwrite().save(path)
    time = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    pairs = [F.lit(x) for kv in (metrics or {}).items() for x in (kv[0], float(kv[1]))]
    table = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
    note = spark.range(1).select(
        F.lit(name).alias("model"), F.lit(version).alias("version"), F.lit(path).alias("path"),
        table.alias("metrics"), time.alias("created_at"))
    note.write.mode("append").parquet(f"{base}/models_index")
    return path


def list_models(spark: SparkSession, base: str) -> DataFrame:
    notes = spark.read.parquet(f"{base}/models_index")
    newest = F.max_by(F.struct("path", "metrics", "created_at"), "created_at")
    return notes.groupBy("model", "version").agg(newest.alias("n")).select("model", "version", "n.*")


def load_model(spark: SparkSession, base: str, name: str, version: int | str = "latest") -> PipelineModel:
    if version == "latest":
        known = list_models(spark, base).filter(F.col("model") == name).agg(F.max("version")).first()[0]
        if known is None:
            raise ValueError(f"No version of model {name}")
        version = known
    return PipelineModel.load(f"{base}/models/{name}/version={version}")


def batch_transform(model: PipelineModel, df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    """Score a dataset and write the result."""
    model.transform(df).select(*columns).write.mode(mode).parquet(path)
