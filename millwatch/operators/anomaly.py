"""Anomaly models as distributed jobs: isolation forest, kernel one-class, sequence errors.

Each ``fit_*`` returns a small model with ``score(df)``, which adds ``<name>_score`` (lower
is more anomalous) and ``<name>`` (1 normal, -1 anomaly).
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millwatch.operators.ensembles import AnomalyEnsemble, AnomalyEnsembleModel
from millwatch.operators.evaluation import best_model, binary_metrics, long_form, predictions_of_best, stratified_split
from millwatch.plans.quantiles import exact_quantiles
from millwatch.plans.series import packed_series, unpacked, window_figure
from millwatch.plans.storage import discard, written
from millwatch.session import ship

# Defaults of the model families.
TREES, SAMPLE, CONTAMINATION, NU, SEED = 100, 256, 0.1, 0.1, 42
ERROR_QUANTILE = 0.95
RANDOM_FEATURES = 256
NODE = ["feature", "threshold", "left", "right", "depth"]
# Number of the draw that orders a tree's rows: beyond those that pick its trees.
_ORDER = 1 << 20
FOREST = "tree int, node int, feature int, threshold double, left int, right int, depth double"


def _stable_hash(seed: int, *columns: Column) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _cut(df: DataFrame, score: str, share: float) -> float:
    """Score below which the given share of rows lies, exact; scores are made once and written, as they are counted three times."""
    return exact_quantiles(written(df.select(score), "scores"), [score], [share])[score, float(share)]


def _judged(df: DataFrame, name: str, cut: float) -> DataFrame:
    return df.withColumn(name, F.when(F.col(f"{name}_score") < cut, -1).otherwise(1))


def _add_array_score(df: DataFrame, features: Sequence[str], name: str, fn) -> DataFrame:
    """Add a score computed from the feature matrix of each Arrow batch."""
    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(fn(np.column_stack([c.to_numpy(dtype="float64") for c in columns])))

    # A missing feature counts as 0.
    return df.withColumn(f"{name}_score", score(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]))


def _moments(df: DataFrame, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    row = df.agg(*[f(F.coalesce(F.col(c).cast("double"), F.lit(0.0))) for c in features for f in (F.avg, F.stddev_pop)]).first()
    mean, spread = np.array(row[0::2], dtype="float64"), np.array(row[1::2], dtype="float64")
    return mean, np.where(spread > 0, spread, 1.0)


# --- isolation forest -------------------------------------------------------------


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype="float64")
    many = 2.0 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2.0 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


def _grow(points: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple[int, float, int, int, float]]:
    """A random tree as rows (feature, threshold, left, right, depth value); leaf feature is -1."""
    nodes: list[tuple[int, float, int, int, float]] = [(-1, 0.0, 0, 0, 0.0)]
    todo = [(0, points, 0)]
    while todo:
        at, part, depth = todo.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(part) <= 1 or not len(usable):
            nodes[at] = (-1, 0.0, 0, 0, depth + float(average_path(len(part))))
            continue
        f = int(rng.choice(usable))
        threshold = float(rng.uniform(low[f], high[f]))
        left = part[:, f] < threshold
        nodes += [(-1, 0.0, 0, 0, 0.0)] * 2
        nodes[at] = (f, threshold, len(nodes) - 2, len(nodes) - 1, 0.0)
        todo += [(len(nodes) - 2, part[left], depth + 1), (len(nodes) - 1, part[~left], depth + 1)]
    return nodes


def _complete(trees: Sequence[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The trees with all leaves at the deepest one's depth: features and thresholds level by level, and the depth values of the lowest level."""
    at = np.zeros((len(trees), 1), dtype="int64")
    features, thresholds = [], []
    take = lambda i: np.stack([t[i][n] for t, n in zip(trees, at, strict=True)])
    while (take(0) >= 0).any():
        inner = take(0) >= 0
        features.append(np.where(inner, take(0), 0))
        thresholds.append(np.where(inner, take(1), np.inf))
        # Below a leaf there is the leaf itself, on both sides.
        at = np.stack([np.where(inner, take(2), at), np.where(inner, take(3), at)], axis=2).reshape(len(trees), -1)
    none = np.zeros((len(trees), 0))
    return np.concatenate([none.astype("int64"), *features], axis=1), np.concatenate([none, *thresholds], axis=1), take(4)


# Rows that go down all trees together: few enough that what they need stays in the processor's cache.
ROWS_DOWN = 128


def _forest_score(trees: list[tuple[np.ndarray, ...]], size: int):
    norm = float(average_path(size))
    features, thresholds, values = _complete(trees)
    inner, depth = features.shape[1], int(values.shape[1]).bit_length() - 1
    features, thresholds, values = features.ravel(), thresholds.ravel(), values.ravel()
    tops, bottoms = (np.arange(len(trees)) * inner)[:, None], (np.arange(len(trees)) * (inner + 1))[:, None]

    def down(x: np.ndarray) -> np.ndarray:
        numbers, first = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        at = np.zeros((len(trees), len(x)), dtype="int64")
        for _ in range(depth):
            node = at + tops
            cell = features.take(node, mode="clip")
            cell += first
            left = numbers.take(cell, mode="clip") < thresholds.take(node, mode="clip")
            at *= 2
            at += 2
            at -= left
        return values.take(at - inner + bottoms, mode="clip").sum(axis=0)

    def score(x: np.ndarray) -> np.ndarray:
        depths = [down(x[s:s + ROWS_DOWN]) for s in range(0, len(x), ROWS_DOWN)]
        return -np.power(2.0, -np.concatenate([np.zeros(0), *depths]) / len(trees) / norm)

    return score


@dataclass
class IsolationForest:
    features: list[str]
    trees: list[tuple[np.ndarray, ...]] = field(repr=False)
    size: int
    cut: float = float("-inf")
    name: str = "isolation_forest"

    def scores(self, df: DataFrame) -> DataFrame:
        return _add_array_score(df, self.features, self.name, _forest_score(self.trees, self.size))

    def score(self, df: DataFrame) -> DataFrame:
        return _judged(self.scores(df), self.name, self.cut)


def _uniform(seed: np.ndarray, turn: int) -> np.ndarray:
    """Numbers above 0 and up to 1, from hashes and the number of the draw."""
    x = seed + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype("float64") / (1 << 53) + 2.0 ** -53


def _draws(hashes: np.ndarray, trees: int, rate: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, their trees and their place in the tree's order: each row is in each tree with chance ``rate``.

    The trees between one that a row is in and the next are skipped at once, by one geometric
    number; so a row costs as many steps as it has trees, not as there are trees.
    """
    rows, at = np.arange(len(hashes)), np.full(len(hashes), -1.0)
    out, turn = [], 0
    while len(rows):
        skip = np.floor(np.log(_uniform(hashes[rows], turn)) / np.log1p(-rate)) if rate < 1 else np.zeros(len(rows))
        at = at + 1 + skip
        rows, at = rows[at < trees], at[at < trees]
        out.append((rows, at.astype("int64")))
        turn += 1
    row, tree = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, "int64"),) * 2
    place = _uniform(hashes[row] ^ (tree.astype("uint64") * np.uint64(0xD6E8FEB86659FD93)), _ORDER)
    return row, tree, place


def _samples(hashed: DataFrame, names: Sequence[str], trees: int, rate: float) -> DataFrame:
    """(_tree, _pick, values, n): the rows drawn for each tree, alike ones counted; it hangs on ids and values alone, not on partitions."""
    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            row, tree, place = _draws(pdf["_h"].to_numpy().astype("int64").view("uint64"), trees, rate)
            yield pdf.iloc[row].drop(columns="_h").assign(_tree=tree, _pick=place)

    ship(hashed.sparkSession)
    kinds = ", ".join(f"{n} double" for n in names)
    return hashed.mapInPandas(draw, f"{kinds}, _tree long, _pick double").groupBy("_tree", "_pick", *names).agg(F.count(F.lit(1)).alias("n"))


def fit_isolation_forest(df: DataFrame, features: Sequence[str], row_id: Sequence[str], trees: int = TREES,
                         sample: int = SAMPLE, contamination: float = CONTAMINATION, seed: int = SEED) -> IsolationForest:
    """Grow the trees in parallel on hash samples, then set the cut from all scores.

    Each row is drawn for each tree with a chance that gives about twice the rows a tree takes; of these
    the tree takes the ``sample`` first in its own order. Both come from a hash of id and
    values: the forest is the same at any partitioning, and alike rows are drawn together and counted. Where
    many rows are alike, so that a tree has too few, all are drawn again with a larger chance.
    """
    features = list(features)
    names = [f"x{j}" for j in range(len(features))]
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(n) for c, n in zip(features, names)]
    hashed = df.select(_stable_hash(seed, *[F.col(c) for c in row_id], *values).alias("_h"), *values)
    size = df.count()
    if not size:
        raise ValueError("no rows to fit a forest on")
    rate = 2 * (sample + 32) / size
    while True:
        drawn = written(_samples(hashed, names, trees, min(rate, 1.0)), "forest-samples")
        filled = drawn.groupBy("_tree").agg(F.sum("n").alias("n")).where(F.col("n") >= min(sample, size)).count()
        if filled == trees:
            break
        discard(drawn)
        rate *= 4

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_pick", *names])
        before = pdf["n"].cumsum() - pdf["n"]
        pdf = pdf.assign(n=np.minimum(pdf["n"], sample - before))[before < sample]
        points = pdf[names].to_numpy().repeat(pdf["n"].to_numpy(), axis=0)
        limit = max(int(np.ceil(np.log2(max(len(points), 2)))), 1)
        nodes = _grow(points, np.random.default_rng([seed, int(key[0])]), limit)
        out = pd.DataFrame(nodes, columns=NODE)
        return out.assign(tree=int(key[0]), node=range(len(out)))

    # The first of a tree's order, some more than it takes: what is alike is one row of these.
    first = drawn.withColumn("_rank", F.row_number().over(Window.partitionBy("_tree").orderBy("_pick", *names))).where(F.col("_rank") <= sample)
    forest = first.groupBy("_tree").applyInPandas(grow, FOREST)
    grown = forest.toPandas().sort_values(["tree", "node"])
    arrays = [tuple(g[c].to_numpy() for c in NODE) for _, g in grown.groupby("tree")]
    if len(arrays) != trees:
        raise RuntimeError(f"{len(arrays)} of {trees} trees were grown")
    model = IsolationForest(features, arrays, min(sample, size))
    model.cut = _cut(model.scores(df), f"{model.name}_score", contamination)
    discard(drawn)
    return model


# --- kernel one-class -------------------------------------------------------------


# Rows whose random features are made together.
ROWS_MAPPED = 512


@dataclass
class KernelOneClass:
    """Mean similarity to the data under an RBF kernel, by random Fourier features."""

    features: list[str]
    mean: np.ndarray = field(repr=False)
    spread: np.ndarray = field(repr=False)
    weights: np.ndarray = field(repr=False)
    shift: np.ndarray = field(repr=False)
    centre: np.ndarray = field(repr=False)
    cut: float = float("-inf")
    name: str = "one_class_kernel"

    def maps(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The random features of some rows at a time: few enough that they stay in the processor's cache."""
        for s in range(0, len(x), ROWS_MAPPED):
            z = ((x[s:s + ROWS_MAPPED] - self.mean) / self.spread) @ self.weights
            z += self.shift
            yield np.cos(z, out=z)

    def similarity(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *[m @ self.centre for m in self.maps(x)]]) * np.sqrt(2.0 / len(self.shift))

    def scores(self, df: DataFrame) -> DataFrame:
        return _add_array_score(df, self.features, self.name, self.similarity)

    def score(self, df: DataFrame) -> DataFrame:
        return _judged(self.scores(df), self.name, self.cut)


def fit_one_class(df: DataFrame, features: Sequence[str], nu: float = NU, size: int = RANDOM_FEATURES,
                  seed: int = SEED) -> KernelOneClass:
    """One pass for the scale, one for the kernel mean (a vector per task), one for the cut."""
    features = list(features)
    mean, spread = _moments(df, features)
    rng = np.random.default_rng(seed)
    # Scaled features have variance 1, so the kernel width is one over their number.
    gamma = 1.0 / len(features)
    model = KernelOneClass(features, mean, spread, rng.normal(0.0, np.sqrt(2 * gamma), (len(features), size)),
                           rng.uniform(0.0, 2 * np.pi, size), np.zeros(size))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(size), 0
        for pdf in batches:
            for part in model.maps(pdf.to_numpy(dtype="float64")):
                total += part.sum(axis=0)
            n += len(pdf)
        yield pd.DataFrame({"place": np.arange(size), "total": total * np.sqrt(2.0 / size), "n": n})

    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{j}") for j, c in enumerate(features)]
    sums = df.select(*values).mapInPandas(add, "place long, total double, n long").groupBy("place").agg(
        (F.sum("total") / F.sum("n")).alias("m")).orderBy("place").toPandas()
    model.centre = sums["m"].to_numpy()
    model.cut = _cut(model.scores(df), f"{model.name}_score", nu)
    return model


# --- sequence reconstruction ------------------------------------------------------


@dataclass
class SequenceReconstruction:
    """Error of rebuilding each key's latest values from a few principal components."""

    column: str
    order: list[str]
    length: int
    key: str
    mean: np.ndarray = field(repr=False)
    components: np.ndarray = field(repr=False)
    cut: float = float("inf")
    name: str = "sequence_reconstruction"

    def errors(self, windows: np.ndarray) -> np.ndarray:
        # The components are orthonormal: what they do not hold is the error.
        centred = windows - self.mean
        kept = centred @ self.components
        return np.maximum(np.einsum("ij,ij->i", centred, centred) - np.einsum("ij,ij->i", kept, kept), 0.0) / self.length

    def score(self, df: DataFrame) -> DataFrame:
        # Too short a history, or one without any value, gets no error.
        out = window_figure(df, self.order, self.column, self.length, self.errors, "_error", self.key)
        error = F.col("_error")
        return out.withColumns({f"{self.name}_score": F.coalesce(-error, F.lit(0.0)), self.name: F.when(error > self.cut, -1).otherwise(1)}).drop("_error")


def _components(pieces: DataFrame, length: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean window and the leading eigenvectors of the covariance of all windows, from one pass: a task gives sums of its windows, less a middle value."""
    middle = pieces.select("series").mapInArrow(_middles, "total double, n long").agg(F.sum("total") / F.sum("n")).first()[0] or 0.0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, squares = 0, np.zeros(length), np.zeros((length, length))
        for windows, _ in unpacked(batches, length):
            x = windows - middle
            n, total, squares = n + len(x), total + x.sum(axis=0), squares + x.T @ x
        sums = np.concatenate([[n], total, squares.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], names=["place", "total"])

    sums = pieces.mapInArrow(add, "place long, total double").groupBy("place").agg(F.sum("total").alias("total")).toPandas().sort_values("place")["total"].to_numpy()
    if not len(sums) or not sums[0]:
        raise ValueError("no whole window to fit on")
    mean = sums[1:length + 1] / sums[0]
    covariance = sums[length + 1:].reshape(length, length) / sums[0] - np.outer(mean, mean)
    return mean + middle, np.linalg.eigh(covariance)[1][:, ::-1][:, :count]


def _middles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = 0.0, 0
    for batch in batches:
        for piece in batch.column("series").to_pylist():
            values = np.frombuffer(piece)
            known = values[~np.isnan(values)]
            total, n = total + float(known.sum()), n + len(known)
    yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([n])], names=["total", "n"])


def fit_sequence_reconstruction(df: DataFrame, column: str, order: Sequence[str], length: int = 60, components: int = 8,
                                key: str = "equipment_id", quantile: float = ERROR_QUANTILE) -> SequenceReconstruction:
    """The series is dealt and put in order once and written as it is; components and errors come from its windows, which are never stored."""
    pieces = written(packed_series(df, order, column, length, key=key), "series")
    model = SequenceReconstruction(column, list(order), length, key, *_components(pieces, length, min(components, length)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for windows, _ in unpacked(batches, length):
            yield pa.RecordBatch.from_arrays([pa.array(model.errors(windows))], names=["e"])

    model.cut = _cut(pieces.mapInArrow(measure, "e double"), "e", quantile)
    discard(pieces)
    return model


# --- storage ----------------------------------------------------------------------


def save_detector(spark: SparkSession, model, path: str) -> None:
    """Write a detector as tables: its numbers, and its trees."""
    facts: dict = {"kind": model.name, "cut": float(model.cut)}
    if isinstance(model, IsolationForest):
        facts |= {"features": model.features, "size": int(model.size)}
        nodes = [(t, n, *(v.item() for v in node)) for t, tree in enumerate(model.trees) for n, node in enumerate(zip(*tree, strict=True))]
        spark.createDataFrame(nodes, FOREST).write.mode("overwrite").parquet(f"{path}/trees")
    elif isinstance(model, KernelOneClass):
        facts |= {"features": model.features, **{n: getattr(model, n).tolist() for n in ("mean", "spread", "weights", "shift", "centre")}}
    else:
        facts |= {"column": model.column, "order": model.order, "length": model.length, "key": model.key,
                  "mean": model.mean.tolist(), "components": model.components.tolist()}
    spark.createDataFrame([(json.dumps(facts),)], "facts string").write.mode("overwrite").parquet(f"{path}/facts")


def load_detector(spark: SparkSession, path: str):
    facts = json.loads(spark.read.parquet(f"{path}/facts").first()["facts"])
    kind, cut = facts.pop("kind"), facts.pop("cut")
    if kind == "isolation_forest":
        nodes = spark.read.parquet(f"{path}/trees").toPandas().sort_values(["tree", "node"])
        trees = [tuple(g[c].to_numpy() for c in NODE) for _, g in nodes.groupby("tree")]
        return IsolationForest(facts["features"], trees, facts["size"], cut)
    if kind == "one_class_kernel":
        return KernelOneClass(facts.pop("features"), **{n: np.array(v) for n, v in facts.items()}, cut=cut)
    if "mean" not in facts:  # stored by an earlier version, as stages of Spark ML
        centring, projection = PipelineModel.load(f"{path}/pipeline").stages
        facts |= {"mean": centring.mean.toArray(), "components": projection.pc.toArray()}
    return SequenceReconstruction(**facts | {n: np.array(facts[n]) for n in ("mean", "components")}, cut=cut)


# --- family -----------------------------------------------------------------------


def member_scores(df: DataFrame, models: Mapping) -> DataFrame:
    """The columns of each model, one after the other."""
    for model in models.values():
        df = model.score(df)
    return df


@dataclass
class AnomalyModels:
    """Several fitted detectors, their votes, and the choice of the best."""

    models: dict
    ensemble: AnomalyEnsembleModel

    def score(self, df: DataFrame) -> DataFrame:
        return self.ensemble.transform(member_scores(df, self.models))

    def predictions(self) -> Mapping[str, Column]:
        return {**{n: F.col(n) for n in self.models}, "ensemble": F.col("ensemble_prediction")}

    def evaluate(self, scored: DataFrame, label: str) -> DataFrame:
        """Metrics per model and for the ensemble; the label is 1 for an anomaly."""
        rows = long_form(scored, self.predictions(), [label], "model", "p")
        guess = rows.withColumn("p", F.when(F.col("p") == -1, 1).otherwise(0))
        return binary_metrics(guess, label, "p", ["model"])

    def detect(self, scored: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
        """Add the prediction of the best model by F1, or of the ensemble without metrics."""
        if metrics is None:
            return scored.withColumn("prediction", F.col("ensemble_prediction")).withColumn("model_used", F.lit("ensemble"))
        return predictions_of_best(scored, self.predictions(), metrics)

    def best(self, metrics: DataFrame) -> DataFrame:
        return best_model(metrics)


def train_anomaly_models(df: DataFrame, features: Sequence[str], row_id: Sequence[str], order: Sequence[str] | None = None,
                         sequence_column: str | None = None, config: Mapping | None = None) -> AnomalyModels:
    """Fit the detectors a configuration asks for (contamination, nu, sequence_length, voting_method)."""
    config = dict(config or {})
    wanted = config.get("models", ["isolation_forest", "one_class_kernel"] + (["sequence_reconstruction"] if sequence_column else []))
    seed, made = config.get("seed", SEED), {}
    for name in wanted:
        if name == "isolation_forest":
            made[name] = fit_isolation_forest(df, features, row_id, config.get("trees", TREES),
                                              contamination=config.get("contamination", CONTAMINATION), seed=seed)
        elif name == "one_class_kernel":
            made[name] = fit_one_class(df, features, config.get("nu", NU), seed=seed)
        elif name == "sequence_reconstruction":
            made[name] = fit_sequence_reconstruction(df, sequence_column, order, config.get("sequence_length", 60))
        else:
            raise ValueError(f"Unknown model type: {name}")
    ensemble = AnomalyEnsemble(members=list(made), method=config.get("voting_method", "majority"))
    return AnomalyModels(made, ensemble.fit(member_scores(df, made)))


def retrain_anomaly(df: DataFrame, features: Sequence[str], row_id: Sequence[str], label: str, base: str, version: int,
                    config: Mapping | None = None) -> DataFrame:
    """Fit on the training share, evaluate on the test share, store the family and each detector. Returns the metrics."""
    from millwatch.operators.families import save_family

    split = stratified_split(df, label, row_id)
    train, test = (split.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    family = train_anomaly_models(train, features, row_id, config=config)
    metrics = family.evaluate(family.score(test), label)
    found = {row["model"]: {k: v for k, v in row.asDict().items() if k != "model"} for row in metrics.collect()}
    save_family(df.sparkSession, family, base, version, found)
    for name, model in family.models.items():
        save_detector(df.sparkSession, model, f"{base}/detectors/{name}/version={version}")
    return metrics
