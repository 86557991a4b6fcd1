"""Ensembles: votes and weighted means over the columns of several models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millwatch.functions.scores import clip, row_median
from millwatch.operators.evaluation import EPS, auc, hash_bucket, long_form


def total(columns: Sequence[Column]) -> Column:
    return sum(columns[1:], columns[0])


def mean(columns: Sequence[Column]) -> Column:
    return total(columns) / float(len(columns))


def weighted_mean(columns: Mapping[str, Column], weights: Column | Mapping[str, float]) -> Column:
    """Weighted mean with weights given as numbers or as a struct column; they need not sum to 1."""
    if isinstance(weights, Mapping):
        return total([c * float(weights[n]) for n, c in columns.items()]) / float(sum(weights[n] for n in columns))
    return total([c * weights[n] for n, c in columns.items()]) / total([weights[n] for n in columns])


def inverse_score_weights(df: DataFrame, scores: Mapping[str, Column]) -> DataFrame:
    """Weight of a detector: one over its mean absolute score, as one struct row."""
    return df.agg(F.struct(*[(1.0 / (F.avg(F.abs(c)) + EPS)).alias(n) for n, c in scores.items()]).alias("w"))


def anomaly_vote(df: DataFrame, predictions: Mapping[str, Column], scores: Mapping[str, Column],
                 method: str = "majority", weights: Mapping[str, float] | None = None) -> DataFrame:
    """Join detectors that say 1 (normal) or -1: normal needs more than half of the vote.

    ``majority`` and ``average`` weigh all alike; ``weighted`` takes the given weights, which are worked
    out beforehand on training rows (``ensembles.AnomalyEnsemble``).
    A tie is an anomaly. Adds ``ensemble_prediction`` and ``ensemble_score``.
    """
    normal = {n: (c == 1).cast("double") for n, c in predictions.items()}
    if method in ("majority", "average"):
        share, score = mean(list(normal.values())), mean(list(scores.values()))
    elif method == "weighted" and weights:
        share, score = weighted_mean(normal, weights), weighted_mean(scores, weights)
    elif method == "weighted":
        raise ValueError("weights come from a fit on training rows")
    else:
        raise ValueError(f"Unknown voting method: {method}")
    return df.withColumns({"ensemble_prediction": F.when(share > 0.5, 1).otherwise(-1), "ensemble_score": score})


def auc_weights(df: DataFrame, probabilities: Mapping[str, Column], label: str, row_id: Column, folds: int = 5) -> DataFrame:
    """Mean AUC of each model over hash folds, as one struct row of weights."""
    rows = df.select(F.col(label).alias("_y"), hash_bucket(row_id, folds).alias("fold"),
                     *[c.alias(f"_p_{n}") for n, c in probabilities.items()])
    cells = long_form(rows, {n: F.col(f"_p_{n}") for n in probabilities}, ["_y", "fold"], "model", "score")
    areas = auc(cells, "_y", "score", ["model", "fold"])
    return areas.agg(F.struct(*[F.avg(F.when(F.col("model") == n, F.col("auc"))).alias(n) for n in probabilities]).alias("w"))


def failure_vote(df: DataFrame, probabilities: Mapping[str, Column], method: str = "soft",
                 weights: Column | None = None) -> DataFrame:
    """Join failure models: mean probability (``soft``) or mean vote (``hard``) above one half.

    ``weights`` is a struct column or scalar, one field per model. Adds
    ``failure_probability`` and ``will_fail``.
    """
    if method not in ("soft", "hard", "weighted"):
        raise ValueError(f"Unknown voting method: {method}")
    out = df if weights is None else df.withColumn("_w", weights)

    def joined(columns: Mapping[str, Column]) -> Column:
        return mean(list(columns.values())) if weights is None else weighted_mean(columns, F.col("_w"))

    votes = {n: (p > 0.5).cast("double") for n, p in probabilities.items()}
    probability = joined(probabilities)
    decided = joined(votes) if method == "hard" else probability
    return out.withColumns({"failure_probability": probability, "will_fail": (decided > 0.5).cast("int")}).drop("_w")


def r2_weights(df: DataFrame, scores: Mapping[str, Column], label: Column) -> DataFrame:
    """Weight of a scorer: its R², not below 0; all alike when every one is 0."""
    fit = {n: F.greatest(1 - F.avg((label - c) * (label - c)) / F.var_pop(label), F.lit(0.0)) for n, c in scores.items()}
    row = df.agg(*[c.alias(n) for n, c in fit.items()])
    none = total([F.col(n) for n in scores]) <= 0
    return row.select(F.struct(*[F.when(none, 1.0).otherwise(F.col(n)).alias(n) for n in scores]).alias("w"))


def health_vote(scores: Mapping[str, Column], method: str = "average", weights: Mapping[str, float] | None = None) -> Column:
    """Join health scores by ``average``, ``median`` or ``weighted`` mean with weights from a fit, kept in 0-1."""
    if method == "average":
        return clip(mean(list(scores.values())))
    if method == "median":
        return clip(row_median(list(scores.values())))
    if method == "weighted" and weights:
        return clip(weighted_mean(scores, weights))
    raise ValueError("weights come from a fit on training rows" if method == "weighted" else f"Unknown voting method: {method}")
