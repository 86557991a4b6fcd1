"""Whole model families on disk: every member, the order and features it wants, and the fitted ensemble."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from millwatch.operators import anomaly as N, ensembles as Z, learners as Q
from millwatch.plans.storage import exists
from millwatch.sources.models import save_model

# Kinds of families and of their members, by the names that are stored.
FAMILIES = {"anomaly": (N.AnomalyModels, Z.AnomalyEnsembleModel), "failure": (Q.FailureModels, Z.FailureEnsembleModel),
            "health": (Q.HealthModels, Z.HealthEnsembleModel)}
MEMBERS = {"scorer": Q.Scorer, "sequence": Q.SequenceClassifier, "clusters": Q.ClusterScorer}


def family_path(base: str, kind: str, version: int) -> str:
    return f"{base}/families/{kind}/version={version}"


def save_family(spark: SparkSession, family, base: str, version: int, metrics: Mapping[str, Mapping[str, float]] | None = None) -> str:
    """Store a family under a version, which must be new. The table of its members is written last: without it there is no family."""
    kind = next(k for k, (cls, _) in FAMILIES.items() if isinstance(family, cls))
    path = family_path(base, kind, version)
    if exists(spark, f"{path}/members.parquet"):
        raise FileExistsError(f"version {version} of the {kind} family is there already")
    rows = []
    for place, (name, model) in enumerate(family.models.items()):
        at = f"{path}/member/{name}"
        if kind == "anomaly":
            N.save_detector(spark, model, at)
            member, facts = "detector", {}
        else:
            member = next(k for k, cls in MEMBERS.items() if isinstance(model, cls))
            model.pipeline.write().overwrite().save(at)
            facts = {k: v for k, v in vars(model).items() if k != "pipeline"}
        rows.append((place, name, member, json.dumps(facts), json.dumps(dict((metrics or {}).get(name, {})))))
    family.ensemble.write().overwrite().save(f"{path}/ensemble")
    spark.createDataFrame(rows, "place int, name string, kind string, facts string, metrics string").coalesce(1).write.mode("overwrite").parquet(f"{path}/members.parquet")
    return path


def load_family(spark: SparkSession, base: str, kind: str, version: int):
    """The family as it was saved: it scores as it did."""
    path = family_path(base, kind, version)
    family, ensemble = FAMILIES[kind]
    models = {}
    for row in spark.read.parquet(f"{path}/members.parquet").orderBy("place").collect():
        at = f"{path}/member/{row['name']}"
        if row["kind"] == "detector":
            models[row["name"]] = N.load_detector(spark, at)
        else:
            models[row["name"]] = MEMBERS[row["kind"]](**json.loads(row["facts"]), pipeline=PipelineModel.load(at))
    return family(models, ensemble.load(f"{path}/ensemble"))


def store_trained(spark: SparkSession, family, base: str, version: int, metrics: DataFrame) -> None:
    """The family as a whole, and each of its pipelines in the index of models."""
    found = {row["model"]: {k: v for k, v in row.asDict().items() if k != "model"} for row in metrics.collect()}
    save_family(spark, family, base, version, found)
    for name, model in family.models.items():
        if hasattr(model, "pipeline"):
            save_model(spark, model.pipeline, base, name, version, found[name])


def members(spark: SparkSession, base: str, kind: str, version: int) -> DataFrame:
    """What a stored family holds: name, kind, metrics and weight of each member."""
    path = family_path(base, kind, version)
    weights = spark.read.parquet(f"{path}/ensemble/weights").select(F.col("member").alias("name"), "weight")
    return spark.read.parquet(f"{path}/members.parquet").join(weights, "name", "left").orderBy("place").select("name", "kind", "metrics", "weight")
