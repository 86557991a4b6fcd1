"""Ensembles as fitted models: weights are worked out on training rows, kept, and stored.

A fitted ensemble scores each row from its members' columns and its own weights alone: a row
gets the same score by itself or among others, with or without a label.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsReadable, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, functions as F

from millwatch.operators import voting as E

FOLDS = 5


class _Members(Params):
    """What estimators and models share; a label is only read by ``fit``."""

    members = Param(Params._dummy(), "members", "columns of the members' outputs", TypeConverters.toListString)
    method = Param(Params._dummy(), "method", "how outputs are joined", TypeConverters.toString)
    label = Param(Params._dummy(), "label", "column of the truth in the training rows", TypeConverters.toString)
    rowId = Param(Params._dummy(), "rowId", "columns that identify a training row", TypeConverters.toListString)
    folds = Param(Params._dummy(), "folds", "folds of the training rows", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(method="average", folds=FOLDS)

    def columns(self) -> dict[str, Column]:
        return {n: F.col(n) for n in self.getOrDefault(self.members)}


class _WeightsWriter(MLWriter):
    """Parameters as metadata, weights as a table (place, member, weight)."""

    def __init__(self, model: EnsembleModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        rows = [(i, n, float(w)) for i, (n, w) in enumerate(self.model.weights.items())]
        self.sparkSession.createDataFrame(rows, "place int, member string, weight double").coalesce(1).write.parquet(os.path.join(path, "weights"))


class _WeightsReader(MLReader):
    def __init__(self, cls: type[EnsembleModel]) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> EnsembleModel:
        known = DefaultParamsReader.loadMetadata(path, self.sparkSession, f"{self.cls.__module__}.{self.cls.__name__}")
        rows = self.sparkSession.read.parquet(os.path.join(path, "weights")).orderBy("place").collect()
        model = self.cls({r["member"]: r["weight"] for r in rows})
        model._resetUid(known["uid"])
        DefaultParamsReader.getAndSetParams(model, known)
        return model


class EnsembleModel(Model, _Members, MLWritable, MLReadable):
    """Weights that add up to 1, one for each member."""

    def __init__(self, weights: Mapping[str, float] | None = None) -> None:
        super().__init__()
        whole = sum((weights or {}).values())
        self.weights = {n: float(w) / whole for n, w in (weights or {}).items()}

    def write(self) -> MLWriter:
        return _WeightsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _WeightsReader(cls)

    def struct(self) -> Column:
        return F.struct(*[F.lit(w).alias(n) for n, w in self.weights.items()])


class _Ensemble(Estimator, _Members, DefaultParamsReadable, DefaultParamsWritable):
    """Works weights out on training rows; methods without weights count all members alike."""

    made: type[EnsembleModel]
    methods: tuple[str, ...]

    @keyword_only
    def __init__(self, *, members=None, method=None, label=None, rowId=None, folds=None) -> None:
        super().__init__()
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**given)

    def _fit(self, df: DataFrame) -> EnsembleModel:
        method, members = self.getOrDefault(self.method), self.getOrDefault(self.members)
        if method not in self.methods:
            raise ValueError(f"Unknown voting method: {method}")
        weights = self._weights(df) if method == "weighted" else dict.fromkeys(members, 1.0)
        return self._copyValues(self.made(weights))

    def _weights(self, df: DataFrame) -> dict[str, float]:
        raise NotImplementedError

    def _of(self, row: DataFrame) -> dict[str, float]:
        """One number per member from a single row with a struct ``w``."""
        found = row.first()["w"].asDict()
        if any(v is None for v in found.values()):
            raise ValueError("the training rows give a member no weight")
        return found


class AnomalyEnsembleModel(EnsembleModel):
    """Adds ``ensemble_prediction`` (1 normal, -1 anomaly) and ``ensemble_score``."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return E.anomaly_vote(df, self.columns(), {n: F.col(f"{n}_score") for n in self.weights}, self.getOrDefault(self.method), self.weights)


class AnomalyEnsemble(_Ensemble):
    """Votes of detectors ``<member>`` with scores ``<member>_score``; weighted: one over the mean absolute training score."""

    made, methods = AnomalyEnsembleModel, ("average", "majority", "weighted")

    def _weights(self, df: DataFrame) -> dict[str, float]:
        return self._of(E.inverse_score_weights(df, {n: F.col(f"{n}_score") for n in self.columns()}))


class FailureEnsembleModel(EnsembleModel):
    """Adds ``failure_probability`` and ``will_fail``."""

    def _transform(self, df: DataFrame) -> DataFrame:
        method = self.getOrDefault(self.method)
        return E.failure_vote(df, self.columns(), method, self.struct() if method == "weighted" else None)


class FailureEnsemble(_Ensemble):
    """Probabilities of failure models; weighted: the mean area under the curve over folds of the training rows."""

    made, methods = FailureEnsembleModel, ("soft", "hard", "weighted")

    def _weights(self, df: DataFrame) -> dict[str, float]:
        row_id = F.concat_ws("|", *self.getOrDefault(self.rowId))
        return self._of(E.auc_weights(df, self.columns(), self.getOrDefault(self.label), row_id, self.getOrDefault(self.folds)))


class HealthEnsembleModel(EnsembleModel):
    """Adds ``health_score``."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("health_score", E.health_vote(self.columns(), self.getOrDefault(self.method), self.weights))


class HealthEnsemble(_Ensemble):
    """Health scores; weighted: the share of the training rows' spread that a member explains, not below 0."""

    made, methods = HealthEnsembleModel, ("average", "median", "weighted")

    def _weights(self, df: DataFrame) -> dict[str, float]:
        return self._of(E.r2_weights(df, self.columns(), F.col(self.getOrDefault(self.label))))
