"""Failure classifiers and health regressors on Spark ML, their ensembles and retraining."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import QuantileDiscretizer, SQLTransformer, StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millwatch.functions.scores import clip, lookup
from millwatch.operators import evaluation as V
from millwatch.operators.anomaly import member_scores
from millwatch.operators.drift import retrain_decision
from millwatch.operators.ensembles import FailureEnsembleModel, HealthEnsemble, HealthEnsembleModel
from millwatch.operators.health import distance_health
from millwatch.operators.networks import fit_network, matrices, packed_rows, probabilities, read_rows
from millwatch.plans.series import packed_series, unpacked, window_figure
from millwatch.plans.storage import discard, written
from millwatch.session import ship

# Defaults of the model families.
TREES, DEPTH, ROUNDS, RATE, BOOST_DEPTH, SEED = 100, 10, 100, 0.1, 6, 42
CLUSTERS, FOLDS = 5, 5
# Memory for split statistics: more nodes are split in one pass over the rows.
SPLIT_MEMORY_MB = 1024
ROWS_PER_TASK = 5_000_000
# k-means keeps its rows as objects, so a task has fewer of them.
ROWS_PER_CLUSTER_TASK = 1_000_000
# Trees see a feature by its bin only. Of a cell of alike rows, a forest draws so many lots of equal weight, or its rows if they are fewer.
BINS, LOTS = 32, 8
# The health bands a banded network learns, and their middle scores.
BAND_EDGES, BAND_MIDDLES = [0.2, 0.4, 0.6, 0.8], [0.1, 0.3, 0.5, 0.7, 0.9]


def _inputs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """A missing feature counts as 0."""
    return df.withColumns({f"_f{j}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for j, c in enumerate(features)})


def _binned(df: DataFrame, features: Sequence[str], label: str, classes: bool) -> tuple[list, DataFrame]:
    """The stages that bin features, and all labelled rows as cells: bins, label, rows in ``weight``.

    Spark's trees split between bins of a feature, so rows of the same bins take the same way in every tree; only their number and, of a
    numeric label, their mean count. ``classes`` keeps labels apart. Every round reads the cells instead of the rows.
    """
    rows = _inputs(df, features).where(F.col(label).isNotNull()).select(*[f"_f{j}" for j in range(len(features))], F.col(label).cast("double").alias("_label"))
    names = [f"_b{j}" for j in range(len(features))]
    cuts = QuantileDiscretizer(inputCols=[f"_f{j}" for j in range(len(features))], outputCols=names, numBuckets=BINS).fit(rows)
    parts = [*names, "_label"] if classes else names
    figures = [F.count(F.lit(1)).cast("double").alias("weight"), *([] if classes else [F.avg("_label").alias("_label")])]
    cells = written(cuts.transform(rows).groupBy(*parts).agg(*figures), "cells")
    # Discretized columns are marked as categories; bins have an order, which trees shall keep.
    ordered = SQLTransformer(statement=f"SELECT *, {', '.join(f'{n} + 0.0D AS {n}n' for n in names)} FROM __THIS__")
    return [cuts, ordered, VectorAssembler(inputCols=[f"{n}n" for n in names], outputCol="_x")], cells


def _lots(cells: DataFrame) -> DataFrame:
    """Cells in lots: a bootstrap then draws lots of alike rows, as it would draw the rows."""
    each = cells.withColumn("_lots", F.least("weight", F.lit(float(LOTS))).cast("int")).withColumn("_lot", F.explode(F.sequence(F.lit(1), "_lots")))
    return each.withColumn("weight", F.col("weight") / F.col("_lots")).drop("_lots", "_lot")


def _grown(stages: Sequence, learner, cells: DataFrame) -> PipelineModel:
    """The learner fitted on cells, behind the stages that bin a row."""
    cuts, ordered, vectors = stages
    # As many tasks as cores, more where their share would grow too large to cache.
    tasks = max(cells.sparkSession.sparkContext.defaultParallelism, math.ceil(cells.count() / ROWS_PER_TASK))
    spread = cells.repartition(tasks, F.xxhash64(*cells.columns))
    return PipelineModel([cuts, ordered, vectors, learner.fit(vectors.transform(ordered.transform(spread)))])


def _spread(rows: DataFrame, at_once: int) -> DataFrame:
    """Rows dealt evenly to as many tasks as cores, or more, so that a task has at most about ``at_once`` of them however well the input is packed."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.count() / at_once))
    return rows.repartition(tasks)


def _assembler(features: Sequence[str], out: str = "_x") -> VectorAssembler:
    return VectorAssembler(inputCols=[f"_f{j}" for j in range(len(features))], outputCol=out)


def _network(pipeline: PipelineModel) -> list[tuple]:
    """The layers as matrices; models stored by earlier versions scale their inputs in a stage before."""
    *before, model = pipeline.stages
    net = matrices(model.weights.toArray(), model.getLayers())
    for scaler in (s for s in before if isinstance(s, StandardScalerModel)):
        spread = scaler.std.toArray()
        scale = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)
        own = scale[:, None] * net[0][0]
        net[0] = (own, net[0][1] - scaler.mean.toArray() @ own)
    return net


def _expected_middle(pipeline: PipelineModel, features: Sequence[str]) -> Column:
    """The middles of the bands, weighted by what the network gives each; Spark's own model takes one row at a time."""
    net = _network(pipeline)

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype="float64") for c in columns])
        if np.isnan(x).any():
            raise ValueError("a feature is NaN")
        given = probabilities(x, net)
        return pd.Series(sum(given[:, k] * middle for k, middle in enumerate(BAND_MIDDLES)))

    return score(*[F.col(f"_f{j}") for j in range(len(features))])


@dataclass
class Scorer:
    """A fitted pipeline that adds one number per row: a probability or a health score."""

    name: str
    kind: str
    features: list[str]
    pipeline: PipelineModel

    def score(self, df: DataFrame) -> DataFrame:
        rows = _inputs(df, self.features)
        if self.kind == "bands":
            ship(df.sparkSession)
            return rows.withColumn(self.name, _expected_middle(self.pipeline, self.features)).select(*df.columns, self.name)
        out = self.pipeline.transform(rows)
        number = vector_to_array("_p")[1] if self.kind == "probability" else clip(F.col("_y"))
        return out.select(*df.columns, number.alias(self.name))

    def importances(self, spark: SparkSession) -> DataFrame:
        """Importance of each feature; as many rows as features."""
        values = self.pipeline.stages[-1].featureImportances.toArray().tolist()
        rows = sorted(zip(self.features, values, strict=True), key=lambda r: -r[1])
        return spark.createDataFrame(rows, "feature string, importance double")


# --- failure classifiers ----------------------------------------------------------


def fit_failure_forest(df: DataFrame, features: Sequence[str], label: str, trees: int = TREES, depth: int = DEPTH,
                       seed: int = SEED) -> Scorer:
    """Random forest with balanced class weights."""
    stages, cells = _binned(df, features, label, classes=True)
    sizes = {row["_label"]: row["n"] for row in cells.groupBy("_label").agg(F.sum("weight").alias("n")).collect()}
    of_class = {c: sum(sizes.values()) / (len(sizes) * n) for c, n in sizes.items()}
    weighted = _lots(cells).withColumn("weight", F.col("weight") * lookup(F.col("_label"), of_class))
    forest = RandomForestClassifier(labelCol="_label", featuresCol="_x", weightCol="weight", probabilityCol="_p", predictionCol="_y",
                                    rawPredictionCol="_r", numTrees=trees, maxDepth=depth, seed=seed,
                                    maxMemoryInMB=SPLIT_MEMORY_MB)
    return Scorer("failure_rf", "probability", list(features), _grown(stages, forest, weighted))


def fit_failure_boosting(df: DataFrame, features: Sequence[str], label: str, rounds: int = ROUNDS, rate: float = RATE,
                         depth: int = BOOST_DEPTH, seed: int = SEED) -> Scorer:
    stages, cells = _binned(df, features, label, classes=True)
    boosting = GBTClassifier(labelCol="_label", featuresCol="_x", weightCol="weight", predictionCol="_y", maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed)
    boosting = boosting.setProbabilityCol("_p").setRawPredictionCol("_r")
    return Scorer("failure_gbt", "probability", list(features), _grown(stages, boosting, cells))


@dataclass
class SequenceClassifier:
    """A network over each key's latest values; rows with too short a history, or one without any value, get 0."""

    column: str
    order: list[str]
    length: int
    key: str
    pipeline: PipelineModel
    name: str = "failure_sequence"

    def score(self, df: DataFrame) -> DataFrame:
        net = _network(self.pipeline)
        out = window_figure(df, self.order, self.column, self.length, lambda w: probabilities(w, net)[:, 1], self.name, self.key)
        return out.withColumn(self.name, F.coalesce(self.name, F.lit(0.0)))


def fit_failure_sequence(df: DataFrame, column: str, label: str, order: Sequence[str], length: int = 60,
                         key: str = "equipment_id", hidden: Sequence[int] = (32, 16), rounds: int = 50, seed: int = SEED) -> SequenceClassifier:
    """All whole windows of labelled rows; what is stored and passed over is the series, not the windows."""
    pieces = written(packed_series(df, order, column, length, label, key), "series")
    network = fit_network(pieces, lambda batches: unpacked(batches, length), [length, *hidden, 2], rounds, seed, overlapping=True,
                          probabilityCol="_p", predictionCol="_y", rawPredictionCol="_r")
    discard(pieces)
    return SequenceClassifier(column, list(order), length, key, PipelineModel([network]))


# --- health regressors ------------------------------------------------------------


def fit_health_forest(df: DataFrame, features: Sequence[str], label: str, trees: int = TREES, depth: int = DEPTH,
                      seed: int = SEED) -> Scorer:
    stages, cells = _binned(df, features, label, classes=False)
    forest = RandomForestRegressor(labelCol="_label", featuresCol="_x", weightCol="weight", predictionCol="_y", numTrees=trees, maxDepth=depth, seed=seed,
                                    maxMemoryInMB=SPLIT_MEMORY_MB)
    return Scorer("health_rf", "value", list(features), _grown(stages, forest, _lots(cells)))


def fit_health_boosting(df: DataFrame, features: Sequence[str], label: str, rounds: int = ROUNDS, rate: float = RATE,
                        depth: int = BOOST_DEPTH, seed: int = SEED) -> Scorer:
    stages, cells = _binned(df, features, label, classes=False)
    boosting = GBTRegressor(labelCol="_label", featuresCol="_x", weightCol="weight", predictionCol="_y", maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed)
    return Scorer("health_gbt", "value", list(features), _grown(stages, boosting, cells))


def fit_health_network(df: DataFrame, features: Sequence[str], label: str, hidden: Sequence[int] = (64, 32), rounds: int = 100,
                       seed: int = SEED) -> Scorer:
    """A network over five health bands; the score is the expected middle of the band."""
    band = sum((F.when(F.col(label) >= e, 1.0).otherwise(0.0) for e in BAND_EDGES), F.lit(0.0))
    blocks = packed_rows(_inputs(df, features).withColumn("_band", band), [f"_f{j}" for j in range(len(features))], "_band")
    stored = written(blocks, "rows")
    network = fit_network(stored, read_rows(len(features)), [len(features), *hidden, len(BAND_MIDDLES)], rounds, seed,
                          probabilityCol="_p", predictionCol="_y", rawPredictionCol="_r")
    discard(stored)
    return Scorer("health_mlp", "bands", list(features), PipelineModel([_assembler(features), network]))


@dataclass
class ClusterScorer:
    """Health from the distance to the nearest cluster centre, with the cluster of each row."""

    features: list[str]
    pipeline: PipelineModel
    name: str = "health_cluster"

    def score(self, df: DataFrame) -> DataFrame:
        out = self.pipeline.transform(_inputs(df, self.features))
        centres = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in self.pipeline.stages[-1].clusterCenters()])
        gaps = F.zip_with(vector_to_array("_x"), centres[F.col("_c")], lambda a, b: (a - b) * (a - b))
        distance = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda a, x: a + x))
        placed = out.withColumn("_d", distance).select(*df.columns, F.col("_c").alias("cluster"), "_d")
        return distance_health(placed, "_d").withColumnRenamed("health_score", self.name).drop("_d")


def fit_health_clusters(df: DataFrame, features: Sequence[str], clusters: int = CLUSTERS, seed: int = SEED) -> ClusterScorer:
    stages = [_assembler(features, "_raw"), StandardScaler(withMean=True, inputCol="_raw", outputCol="_x"),
              KMeans(k=clusters, seed=seed, featuresCol="_x", predictionCol="_c")]
    rows = _inputs(df, features).select(*[f"_f{j}" for j in range(len(features))])
    held = _spread(rows, ROWS_PER_CLUSTER_TASK).persist()
    try:
        return ClusterScorer(list(features), Pipeline(stages=stages).fit(held))
    finally:
        held.unpersist()


# --- families ---------------------------------------------------------------------


@dataclass
class FailureModels:
    """Fitted failure models with their soft, hard or weighted ensemble."""

    models: dict
    ensemble: FailureEnsembleModel

    def score(self, df: DataFrame) -> DataFrame:
        return self.ensemble.transform(member_scores(df, self.models))

    def columns(self) -> Mapping[str, Column]:
        return {n: F.col(n) for n in self.models}

    def evaluate(self, scored: DataFrame, label: str) -> DataFrame:
        """Accuracy, precision, recall, F1 and AUC of each model and the ensemble."""
        rows = V.long_form(scored, {**self.columns(), "ensemble": F.col("failure_probability")}, [label], "model", "p")
        counts = V.binary_metrics(rows.withColumn("_guess", (F.col("p") > 0.5).cast("int")), label, "_guess", ["model"])
        return counts.join(V.auc(rows, label, "p", ["model"]), "model")

    def predict(self, scored: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
        """Probability and verdict of the ensemble, or of the model with the best AUC."""
        if metrics is None:
            return scored.withColumn("model_used", F.lit("ensemble"))
        chosen = {**self.columns(), "ensemble": F.col("failure_probability")}
        out = V.predictions_of_best(scored, chosen, metrics, "auc", "_best")
        return out.withColumns({"failure_probability": F.col("_best"), "will_fail": (F.col("_best") > 0.5).cast("int")}).drop("_best")


def makers(features: Sequence[str], label: str, config: Mapping) -> dict:
    """How to fit each kind of failure model on some rows."""
    return {
        "failure_rf": lambda rows: fit_failure_forest(rows, features, label, config.get("trees", TREES), config.get("depth", DEPTH)),
        "failure_gbt": lambda rows: fit_failure_boosting(rows, features, label, config.get("rounds", ROUNDS), config.get("rate", RATE)),
        "failure_sequence": lambda rows: fit_failure_sequence(rows, config["sequence_column"], label, config["order"],
                                                              config.get("sequence_length", 60)),
    }


def train_failure_models(df: DataFrame, features: Sequence[str], label: str, row_id: Column, config: Mapping | None = None) -> FailureModels:
    """Fit the classifiers a configuration asks for; ``weighted`` voting weighs them by fold AUC."""
    config = dict(config or {})
    known, made = makers(features, label, config), {}
    for name in config.get("models", ["failure_rf", "failure_gbt"]):
        if name not in known:
            raise ValueError(f"Unknown model type: {name}")
        made[name] = known[name](df)
    method, weights = config.get("voting_method", "soft"), dict.fromkeys(made, 1.0)
    if method == "weighted":
        # Models of the folds, not the final ones, are weighed: each on rows that it has not seen.
        weights = {n: fold_auc(df, known[n], label, row_id, config.get("folds", FOLDS)) for n in made}
    ensemble = FailureEnsembleModel(weights)
    return FailureModels(made, ensemble._set(members=list(made), method=method))


def fold_auc(df: DataFrame, fit, label: str, row_id: Column, folds: int = FOLDS) -> float:
    """Mean AUC over hash folds, each scored by a model fitted on the others."""
    placed, areas = df.withColumn("_fold", V.hash_bucket(row_id, folds)), []
    for i in range(folds):
        model = fit(placed.filter(F.col("_fold") != i).drop("_fold"))
        scored = model.score(placed.filter(F.col("_fold") == i).drop("_fold"))
        areas.append(V.auc(scored, label, model.name).first()["auc"])
    return sum(areas) / folds


@dataclass
class HealthModels:
    """Fitted health scorers with their average, weighted or median ensemble."""

    models: dict
    ensemble: HealthEnsembleModel

    def score(self, df: DataFrame) -> DataFrame:
        return self.ensemble.transform(member_scores(df, self.models))

    def columns(self) -> Mapping[str, Column]:
        return {n: F.col(n) for n in self.models}

    def evaluate(self, scored: DataFrame, label: str) -> DataFrame:
        rows = V.long_form(scored, {**self.columns(), "ensemble": F.col("health_score")}, [label], "model", "s")
        return V.regression_metrics(rows, label, "s", ["model"])

    def predict(self, scored: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
        if metrics is None:
            return scored.withColumn("model_used", F.lit("ensemble"))
        chosen = {**self.columns(), "ensemble": F.col("health_score")}
        return V.predictions_of_best(scored, chosen, metrics, "r2_score", "health_score")


def train_health_models(df: DataFrame, features: Sequence[str], label: str, config: Mapping | None = None) -> HealthModels:
    config = dict(config or {})
    makers = {
        "health_rf": lambda: fit_health_forest(df, features, label, config.get("trees", TREES), config.get("depth", DEPTH)),
        "health_gbt": lambda: fit_health_boosting(df, features, label, config.get("rounds", ROUNDS), config.get("rate", RATE)),
        "health_mlp": lambda: fit_health_network(df, features, label),
        "health_cluster": lambda: fit_health_clusters(df, features, config.get("clusters", CLUSTERS)),
    }
    made = {}
    for name in config.get("models", ["health_rf", "health_gbt"]):
        if name not in makers:
            raise ValueError(f"Unknown model type: {name}")
        made[name] = makers[name]()
    ensemble = HealthEnsemble(members=list(made), method=config.get("voting_method", "average"), label=label)
    return HealthModels(made, ensemble.fit(member_scores(df, made)))


# --- retraining -------------------------------------------------------------------


def retrain_failure(df: DataFrame, features: Sequence[str], label: str, row_id: Sequence[str], base: str, version: int,
                    config: Mapping | None = None) -> DataFrame:
    """Split, train, evaluate on the test share, store the family and every model. Returns the metrics."""
    from millwatch.operators.families import store_trained

    split = V.stratified_split(df, label, row_id)
    train, test = (split.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    family = train_failure_models(train, features, label, F.concat_ws("|", *row_id), config)
    metrics = family.evaluate(family.score(test), label)
    store_trained(df.sparkSession, family, base, version, metrics)
    return metrics


def retrain_health(df: DataFrame, features: Sequence[str], label: str, row_id: Sequence[str], base: str, version: int,
                   test_share: float = 0.2, config: Mapping | None = None) -> DataFrame:
    """The same for health scorers; a number has no classes, so the split is by hash alone."""
    from millwatch.operators.families import store_trained

    tested = V.hash_bucket(F.concat_ws("|", *row_id), 1000) < int(test_share * 1000)
    train, test = df.filter(~tested), df.filter(tested)
    family = train_health_models(train, features, label, config)
    metrics = family.evaluate(family.score(test), label)
    store_trained(df.sparkSession, family, base, version, metrics)
    return metrics


def retrain_if_drifted(df: DataFrame, as_of: str, features: Sequence[str], retrain) -> DataFrame | None:
    """Run ``retrain()`` only when the recent days drifted; one row decides."""
    return retrain() if retrain_decision(df, as_of, features).first()["retrain"] else None
