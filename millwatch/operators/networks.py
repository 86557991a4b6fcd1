"""Networks fitted on all rows at once: Spark adds up the gradient of every block of rows, NumPy works inside a block.

The fit is that of Spark's ``MultilayerPerceptronClassifier`` (sigmoid layers, softmax, mean log loss, L-BFGS over full passes, its first
weights), and its result is such a model. Spark's own trainer keeps every row as a vector and goes through it without a fast matrix product, so a pass costs
many times more.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from millwatch.session import ship

# As in Spark's optimizer.
MEMORY, TOLERANCE, LOOK_BACK = 10, 1e-6, 20
BLOCK_ROWS = 2048
ROWS_PER_TASK = 2_000_000
#: Gives matrices of rows and their classes from batches of a table.
Blocks = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]]


def matrices(flat: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights (inputs by outputs) and offsets of each layer, in the order in which Spark's models hold them."""
    out, at = [], 0
    for i, o in zip(layers, layers[1:]):
        out.append((flat[at:at + i * o].reshape(i, o), flat[at + i * o:at + i * o + o]))
        at += i * o + o
    return out


def _layers(x: np.ndarray, net: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """What each layer gives, inputs first; the last is the probability of each class."""
    given = [x]
    for w, b in net[:-1]:
        out = given[-1] @ w
        out += b
        with np.errstate(over="ignore"):
            np.exp(np.negative(out, out=out), out=out)
        out += 1.0
        given.append(np.reciprocal(out, out=out))
    w, b = net[-1]
    out = given[-1] @ w
    out += b
    out -= out.max(axis=1, keepdims=True)
    np.exp(out, out=out)
    out /= out.sum(axis=1, keepdims=True)
    return [*given, out]


def probabilities(x: np.ndarray, net: list[tuple[np.ndarray, np.ndarray]], rows: int = BLOCK_ROWS) -> np.ndarray:
    parts = [_layers(x[s:s + rows], net)[-1] for s in range(0, len(x), rows)]
    return np.concatenate(parts) if parts else np.zeros((0, len(net[-1][1])))


def _slope(x: np.ndarray, y: np.ndarray, net: list[tuple[np.ndarray, np.ndarray]]) -> tuple[float, np.ndarray]:
    """Sum of the log loss of some rows and its gradient."""
    given, n = _layers(x, net), np.arange(len(y))
    loss = -float(np.log(np.maximum(given[-1][n, y], 1e-37)).sum(dtype="float64"))
    error, parts = given[-1], []
    error[n, y] -= 1.0
    for i in range(len(net) - 1, -1, -1):
        parts = [(given[i].T @ error).ravel(), error.sum(axis=0), *parts]
        if i:
            error = error @ net[i][0].T
            error *= given[i]
            error *= np.subtract(1.0, given[i], out=given[i])
    return loss, np.concatenate(parts)


class _Passes:
    """``_slope`` for many blocks of at most ``rows`` scaled rows, in single precision and in arrays that are kept from block to block.

    A sigmoid is ``(1 + tanh(z / 2)) / 2``: the halves go into the weights, so that a layer is a product, a sum and one function.
    """

    def __init__(self, weights: np.ndarray, layers: Sequence[int], rows: int = BLOCK_ROWS):
        net = matrices(weights, layers)
        self.forth, self.back = [], [None]
        for i, (w, b) in enumerate(net):
            own, offset = (w / 2, b + w.sum(axis=0) / 2) if i else (w, b)
            half = 0.5 if i < len(net) - 1 else 1.0
            # Offsets stand there once a row: adding arrays of one shape is several times faster.
            self.forth.append(((half * own).astype("float32"), np.tile((half * offset).astype("float32"), (rows, 1))))
            if i:
                self.back.append(np.ascontiguousarray(w.T / 4, dtype="float32"))
        self.given = [np.empty((rows, k), "float32") for k in layers[1:-1]]
        self.errors = [np.empty((rows, k), "float32") for k in layers[1:-1]]
        self.at, self.ones = np.arange(rows), np.ones(rows, "float32")

    def slope(self, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        """Sum of the log loss of some rows and its gradient."""
        n, given = len(y), [x]
        for (w, b), room in zip(self.forth, self.given):
            out = np.matmul(given[-1], w, out=room[:n])
            out += b[:n]
            given.append(np.tanh(out, out=out))
        w, b = self.forth[-1]
        # Classes by rows: few long lines instead of many short ones.
        chance = w.T @ given[-1].T
        chance += b[0][:, None]
        chance -= chance.max(axis=0)
        np.exp(chance, out=chance)
        chance /= chance.sum(axis=0)
        flat, own = chance.reshape(-1), y.astype("int64") * n + self.at[:n]
        hit = flat[own]
        loss = -float(np.log(np.maximum(hit, 1e-37)).sum(dtype="float64"))
        flat[own] = hit - 1.0
        error, parts = chance.T, []
        for i in range(len(given) - 1, -1, -1):
            total = self.ones[:n] @ error
            product = given[i].T @ error
            parts = [((product + total) / 2 if i else product).ravel(), total, *parts]
            if i:
                error = np.matmul(error, self.back[i], out=self.errors[i - 1][:n])
                bend = np.square(given[i], out=given[i])
                error *= np.subtract(1.0, bend, out=bend)
        return loss, np.concatenate(parts)


def _moments(blocks: DataFrame, read: Blocks, size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, mean and sample deviation of each input, from counts, means and squares of the tasks."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, m2 = 0, np.zeros(size), np.zeros(size)
        for x, _ in read(batches):
            if len(x):
                n, mean, m2 = _joined((n, mean, m2), (len(x), x.mean(axis=0), x.var(axis=0) * len(x)))
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([mean.tobytes()]), pa.array([m2.tobytes()])], names=["n", "mean", "m2"])

    total = (0, np.zeros(size), np.zeros(size))
    for row in blocks.mapInArrow(add, "n long, mean binary, m2 binary").collect():
        total = _joined(total, (row["n"], np.frombuffer(row["mean"]), np.frombuffer(row["m2"])))
    if not total[0]:
        raise ValueError("no rows to fit a network on")
    return total[0], total[1], np.sqrt(total[2] / max(total[0] - 1, 1))


def _joined(a, b):
    n = a[0] + b[0]
    if not b[0] or not a[0]:
        return b if b[0] else a
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + gap * gap * (a[0] * b[0] / n)


def _minimum(slope: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, rounds: int) -> np.ndarray:
    """L-BFGS with a line search for the strong Wolfe conditions."""
    x, (value, gradient) = start, slope(start)
    first, seen, steps = value, [value], []
    for turn in range(rounds):
        if np.linalg.norm(gradient) <= TOLERANCE * max(abs(value), 1e-8):
            break
        way, scales = -gradient, []
        for s, y in reversed(steps):
            scales.append((s @ way) / (s @ y))
            way = way - scales[-1] * y
        if steps:
            s, y = steps[-1]
            way = way * ((s @ y) / (y @ y))
        for (s, y), a in zip(steps, reversed(scales)):
            way = way + s * (a - (y @ way) / (s @ y))
        if way @ gradient >= 0:
            way, steps = -gradient, []
        step = 1.0 if steps else 1.0 / np.linalg.norm(gradient)
        found = _along(slope, x, way, value, gradient, step)
        if found is None:
            break
        s, value, grown = found
        if s @ (grown - gradient) > 0:
            steps = [*steps, (s, grown - gradient)][-MEMORY:]
        x, gradient = x + s, grown
        seen = [*seen, value][-LOOK_BACK - 1:]
        if len(seen) > 2 and max(seen[:-1]) - value <= TOLERANCE * abs(first):
            break
    return x


def _along(slope, x: np.ndarray, way: np.ndarray, value: float, gradient: np.ndarray, step: float, tries: int = 20):
    """A step with enough fall and a flat enough end: doubled until such an end is bracketed, then the bracket is cut by a parabola.

    Without one, the last step with enough fall; None if there is no such step.
    """
    fall = way @ gradient
    low, high, best = (0.0, value, fall), None, None
    for _ in range(tries):
        at, g = slope(x + step * way)
        end = way @ g
        if not np.isfinite(at) or at > value + 1e-4 * step * fall or (low[0] > 0 and at >= low[1]):
            high = (step, at)
        else:
            best = (step * way, at, g)
            if abs(end) <= -0.9 * fall:
                return best
            if (end >= 0) if high is None else (end * (high[0] - low[0]) >= 0):
                high = low[:2]
            low = (step, at, end)
        if high is None:
            step *= 2.0
            continue
        width = high[0] - low[0]
        bend = high[1] - low[1] - low[2] * width
        cut = -low[2] * width / (2 * bend) if np.isfinite(bend) and bend > 0 else 0.5
        step = low[0] + min(max(cut, 0.1), 0.9) * width
    return best


def _model(spark: SparkSession, layers: Sequence[int], seed: int, weights: np.ndarray | None, **names: str) -> MultilayerPerceptronClassificationModel:
    """Spark's model with the given weights, or those that its trainer would begin with: no round is run."""
    rows = [(Vectors.dense([0.0] * layers[0]), float(c)) for c in range(layers[-1])]
    few = spark.createDataFrame(rows, ["_x", "_class"])
    learner = MultilayerPerceptronClassifier(layers=list(layers), seed=seed, maxIter=0, featuresCol="_x", labelCol="_class", **names)
    if weights is not None:
        learner.setInitialWeights(Vectors.dense(weights))
    return learner.fit(few)


def _kinds(y: np.ndarray, classes: int) -> np.ndarray:
    kinds = y.astype("int64")
    if (kinds != y).any() or kinds.min() < 0 or kinds.max() >= classes:
        raise ValueError(f"labels must be whole numbers from 0 to {classes - 1}")
    return kinds


def _scaled(blocks: DataFrame, read: Blocks, mean: np.ndarray, scale: np.ndarray, classes: int) -> DataFrame:
    """Rows as the passes take them: inputs scaled and in single precision, classes in as few bytes as they need."""
    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y in read(batches):
            for s in range(0, len(y), BLOCK_ROWS):
                inputs = ((x[s:s + BLOCK_ROWS] - mean) * scale).astype("float32")
                kinds = _kinds(y[s:s + BLOCK_ROWS], classes).astype(np.min_scalar_type(classes - 1))
                yield pa.RecordBatch.from_arrays([pa.array([inputs.tobytes()], pa.binary()), pa.array([kinds.tobytes()], pa.binary())], names=["x", "y"])

    return blocks.mapInArrow(scaled, "x binary, y binary")


def fit_network(blocks: DataFrame, read: Blocks, layers: Sequence[int], rounds: int, seed: int, overlapping: bool = False,
                **names: str) -> MultilayerPerceptronClassificationModel:
    """A network on all rows of ``blocks``, for inputs as they are: their scaling to mean 0 and deviation 1 is part of its first layer.

    Each round passes over all rows once or, where a step has to be searched for, more often. A task sends back one vector as long as the weights.
    Blocks are read twice, and rows are held scaled; ``overlapping`` ones, which are smaller than the rows they give, are held as they are.
    """
    spark, classes = blocks.sparkSession, layers[-1]
    ship(spark)
    tasks = 2 * spark.sparkContext.defaultParallelism
    held = blocks.repartition(tasks).persist() if overlapping else None
    try:
        n, mean, spread = _moments(blocks if held is None else held, read, layers[0])
        scale = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)
        if not overlapping:
            held = _scaled(blocks, read, mean, scale, classes).repartition(max(tasks, math.ceil(n / ROWS_PER_TASK))).persist()

        def of_blocks(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[tuple[int, float, np.ndarray]]:
            # Inside a block in single precision; blocks are added up in double.
            net = matrices(weights.astype("float32"), layers)
            for x, y in read(batches):
                if len(y):
                    yield len(y), *_slope(((x - mean) * scale).astype("float32"), _kinds(y, classes), net)

        def of_scaled(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[tuple[int, float, np.ndarray]]:
            passes, kind = _Passes(weights, layers), np.min_scalar_type(classes - 1)
            for batch in batches:
                for x, y in zip(batch.column("x"), batch.column("y")):
                    kinds = np.frombuffer(y.as_buffer(), kind)
                    yield len(kinds), *passes.slope(np.frombuffer(x.as_buffer(), "float32").reshape(-1, layers[0]), kinds)

        of_rows = of_blocks if overlapping else of_scaled

        def slope(weights: np.ndarray) -> tuple[float, np.ndarray]:
            def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                n, loss, total = 0, 0.0, np.zeros(len(weights))
                for rows, part, change in of_rows(batches, weights):
                    n, loss, total = n + rows, loss + part, total + change
                yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([loss]), pa.array([total.tobytes()])], names=["n", "loss", "total"])

            n, loss, total = 0, 0.0, np.zeros(len(weights))
            for row in held.mapInArrow(add, "n long, loss double, total binary").collect():
                n, loss, total = n + row["n"], loss + row["loss"], total + np.frombuffer(row["total"])
            return loss / n, total / n

        start = _model(spark, layers, seed, None).weights.toArray()
        weights = _minimum(slope, start, rounds)
    finally:
        if held is not None:
            held.unpersist()
    # (x - mean) * scale @ w + b, for x as it is.
    (w, b), rest = matrices(weights, layers)[0], weights[(layers[0] + 1) * layers[1]:]
    own = scale[:, None] * w
    flat = np.concatenate([own.ravel(), b - mean @ own, rest])
    return _model(spark, layers, seed, flat, **names)


def packed_rows(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Rows in blocks of numbers: a table that is passed over many times without being taken apart."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False).astype("float64") for c in [*features, label]]
            yield pa.RecordBatch.from_arrays([pa.array([np.column_stack(columns).tobytes()], pa.binary())], names=["rows"])

    ship(df.sparkSession)
    return df.select(*[F.col(c).cast("double").alias(c) for c in [*features, label]]).mapInArrow(pack, "rows binary")


def read_rows(width: int, rows: int = BLOCK_ROWS) -> Blocks:
    """Inputs and classes of blocks that ``packed_rows`` made, ``width`` inputs a row."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for block in batch.column("rows").to_pylist():
                table = np.frombuffer(block).reshape(-1, width + 1)
                for s in range(0, len(table), rows):
                    yield table[s:s + rows, :-1], table[s:s + rows, -1]

    return read
