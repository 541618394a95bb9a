"""Many fits from one pass: loss and gradient of all (fold, grid point) pairs at once.

Cross-validation fits the same rows again and again, each time without one fold.  Here the rows are
packed once into blocks (fold, label, matrix), cached, and every iteration of *all* fits is one Spark
aggregate over them: a task holds each block against the matrix of all weights, masks a fit's
held-out fold, and returns one sum.  Solvers (``solvers``) stand side by side on the driver and ask
for points; a fit that has converged drops out.  So a grid costs as many jobs as its slowest
fit has evaluations, whatever the number of folds and points, and points that differ only in the
number of iterations share a run.

What reaches the driver is one vector of (fits × weights) per pass, whatever the rows: tasks take several cached
partitions each, and their sums are added by further tasks until one is left.  Objectives, standardisation and start are those of Spark's estimators:

* ``Logistic``: mean log loss, features scaled (not the penalty's intercept), elastic net;
* ``Hinge``: mean hinge loss with an L2 penalty;
* ``Perceptron``: sigmoid layers and a softmax, mean cross entropy over rows, back-propagation.

``scores`` gives the held-out rows' margins of all fits as one long table for ``metrics.fit_metrics``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.operators.solvers import Ask, lbfgs, owlqn

#: Rows of a block, bytes of features of a task, and where there are fewer than that for every core.
BLOCK_ROWS = 4096
TASK_BYTES = 16 << 20
SMALL_TASK_BYTES = 1 << 20
#: Sums that go straight to the driver, and sums that one task adds.
DIRECT = 1
FAN_IN = 64
#: A held-out fold that no row has: the fit uses all rows.
NO_FOLD = -1

Partial = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def partitions_for(rows: int, dim: int, task_bytes: int | None = None) -> int:
    """Partitions of about ``task_bytes`` (``TASK_BYTES``) of features."""
    return max(1, ceil(rows * dim * 8 / (task_bytes or TASK_BYTES)))


class Blocks:
    """Labelled rows as cached blocks of ``fold``, ``label`` and features; close when done."""

    def __init__(self, train: DataFrame, features: str = "features", label: str = "sentiment", fold: str = "fold"):
        rows = train.select(
            F.col(fold).cast("int").alias("fold"), F.col(label).cast("double").alias("label"), vector_to_array(features).alias("x")
        )
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
        n, self.dim = size["n"], size["d"] or 0
        cores = train.sparkSession.sparkContext.defaultParallelism
        self.partitions = max(partitions_for(n, self.dim), min(cores, partitions_for(n, self.dim, SMALL_TASK_BYTES)))
        dim = self.dim

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK_ROWS):
                    some = batch.slice(at, BLOCK_ROWS)
                    x = some.column("x").flatten().to_numpy(zero_copy_only=False).astype("<f8")
                    if len(x) != some.num_rows * dim:
                        raise ValueError(f"feature vectors differ in length from {dim}")
                    parts = some.column("fold").to_numpy().astype("<i4"), some.column("label").to_numpy().astype("<f8"), x
                    yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], ["fold", "label", "x"])

        # small files share a task, by bytes; no row moves
        self.table = rows.coalesce(self.partitions).mapInArrow(pack, "fold binary, label binary, x binary").persist()

    def close(self) -> None:
        self.table.unpersist()

    def total(self, partial: Partial) -> np.ndarray:
        """Sum of ``partial(fold, label, x)`` over all blocks."""
        dim = self.dim

        def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done = None
            for batch in batches:
                for fold, label, x in zip(*(c.to_pylist() for c in batch.columns)):
                    y = np.frombuffer(label, "<f8")
                    part = partial(np.frombuffer(fold, "<i4"), y, np.frombuffer(x, "<f8").reshape(len(y), dim))
                    done = part if done is None else done + part
            if done is not None:
                yield _sum_row(done)

        # a sum a core and not a sum a cached partition, so that sums do not grow with the rows
        left = min(self.partitions, self.table.sparkSession.sparkContext.defaultParallelism)
        sums = self.table.coalesce(left).mapInArrow(of_task, "total binary")
        while left > DIRECT:
            left = ceil(left / FAN_IN)
            sums = sums.repartition(left).mapInArrow(_add, "total binary")
        return np.sum([np.frombuffer(r["total"], "<f8") for r in sums.collect()], axis=0)


def _sum_row(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([total.astype("<f8").tobytes()], pa.binary())], ["total"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done = None
    for batch in batches:
        for total in batch.column("total").to_pylist():
            part = np.frombuffer(total, "<f8")
            done = part if done is None else done + part
    if done is not None:
        yield _sum_row(done)


@dataclass
class Moments:
    """Rows, positives, mean and deviation of the features without each fold."""

    folds: dict[int, tuple[int, int, np.ndarray, np.ndarray]]
    dim: int

    def without(self, skip: int) -> tuple[int, int, np.ndarray, np.ndarray]:
        n, positive, mean, m2 = 0, 0, np.zeros(self.dim), np.zeros(self.dim)
        for fold, (k, p, its_mean, its_m2) in sorted(self.folds.items()):
            if fold != skip:
                gap = its_mean - mean
                mean = mean + gap * (k / (n + k))
                m2 = m2 + its_m2 + gap * gap * (n * k / (n + k))
                n, positive = n + k, positive + p
        return n, positive, mean, np.sqrt(m2 / max(1, n - 1))


def moments(blocks: Blocks, folds: int) -> Moments:
    """One pass for counts and sums by fold about a common centre, itself from one pass."""
    dim = blocks.dim

    def first(fold: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(y)], x.sum(axis=0)])

    sums = blocks.total(first)
    centre = sums[1:] / max(1.0, sums[0])

    def second(fold: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
        one = (fold[:, None] == np.arange(folds)).astype(float).T
        z = x - centre
        return np.concatenate([one.sum(axis=1)[:, None], (one @ y)[:, None], one @ z, one @ (z * z)], axis=1).ravel()

    rows = blocks.total(second).reshape(folds, 2 + 2 * dim)
    out = {}
    for i, row in enumerate(rows):
        n = int(row[0])
        if n:
            shift = row[2 : 2 + dim] / n
            out[i] = n, int(row[1]), centre + shift, np.maximum(row[2 + dim :] - n * shift * shift, 0.0)
    return Moments(out, dim)


@dataclass
class Fit:
    """One fit: the fold that it leaves out, its solver, and how its points become weights on raw features."""

    skip: int
    n: int
    solver: Ask
    weights: Callable[[np.ndarray], np.ndarray]
    #: (mean loss, mean gradient by the raw weights, point) -> (loss, gradient) by the point
    answer: Callable[[float, np.ndarray, np.ndarray], tuple[float, np.ndarray]]
    found: dict[int, np.ndarray] = field(default_factory=dict)


def solve(blocks: Blocks, fits: Sequence[Fit], partial: Callable[[np.ndarray, np.ndarray], Partial]) -> int:
    """Run all solvers to their ends, one pass over the rows a round; returns the number of passes.

    ``partial(weights, skip)`` gives the sums of a block: for every point asked for its loss, then its gradient.
    """
    asked = {i: next(fit.solver) for i, fit in enumerate(fits)}
    passes = 0
    while asked:
        passes += 1
        some = [(i, point) for i in sorted(asked) for point in asked[i]]
        weights = np.stack([fits[i].weights(point) for i, point in some])
        sums = blocks.total(partial(weights, np.array([fits[i].skip for i, _ in some]))).reshape(len(some), -1)
        answers: dict[int, list] = {}
        for (i, point), row in zip(some, sums):
            answers.setdefault(i, []).append(fits[i].answer(row[0] / fits[i].n, row[1:] / fits[i].n, point))
        for i, told in answers.items():
            try:
                asked[i] = fits[i].solver.send(told)
            except StopIteration as end:
                del asked[i]
                fits[i].found = {k: fits[i].weights(p) for k, p in end.value.items()}
    return passes


def _linear(loss: str) -> Callable[[np.ndarray, np.ndarray], Partial]:
    """Sums of a linear model: loss, gradient by the weights, by the intercept."""

    def partial(weights: np.ndarray, skip: np.ndarray) -> Partial:
        w, b = weights[:, :-1].T.copy(), weights[:, -1]

        def of_block(fold: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
            margin = x @ w
            margin += b
            used = fold[:, None] != skip
            if loss == "log":
                value = np.logaddexp(0.0, np.where(y[:, None] > 0, -margin, margin))
                slope = 1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700))) - y[:, None]
                slope *= used
            else:
                sign = 1 - 2 * y[:, None]
                margin *= sign
                margin += 1.0
                value = np.maximum(0.0, margin, out=margin)
                slope = sign * ((value > 0) & used)
            value *= used
            return np.concatenate([value.sum(axis=0)[:, None], slope.T @ x, slope.sum(axis=0)[:, None]], axis=1).ravel()

        return of_block

    return partial


def linear_fit(loss: str, m: Moments, skip: int, reg: float, elastic: float, max_iter: int, tol: float, marks: Sequence[int]) -> Fit:
    """A logistic (``log``) or hinge fit on centred, scaled features; the point holds their weights and the intercept."""
    n, positive, mean, deviation = m.without(skip)
    scale = np.divide(1.0, deviation, out=np.zeros(m.dim), where=deviation > 0)
    centre = mean * scale
    start = np.zeros(m.dim + 1)
    if loss == "log":
        start[-1] = np.log(positive / (n - positive))
    l1, l2 = reg * elastic, reg * (1.0 - elastic)

    def weights(point: np.ndarray) -> np.ndarray:
        return np.append(point[:-1] * scale, point[-1] - point[:-1] @ centre)

    def answer(value: float, grad: np.ndarray, point: np.ndarray) -> tuple[float, np.ndarray]:
        inner = grad[:-1] * scale - grad[-1] * centre + l2 * point[:-1]
        return value + 0.5 * l2 * float(point[:-1] @ point[:-1]), np.append(inner, grad[-1])

    if loss == "log" and l1 == 0:
        solver = lbfgs(start, max_iter, tol, marks)
    else:
        solver = owlqn(start, np.append(np.full(m.dim, l1), 0.0), max_iter, tol, marks)
    return Fit(skip, n, solver, weights, answer)


def layer_shapes(layers: Sequence[int]) -> list[tuple[int, int, int]]:
    """(first weight, inputs, outputs) of each layer; its outputs × inputs weights come before its intercepts."""
    shapes, at = [], 0
    for a, b in zip(layers, layers[1:]):
        shapes.append((at, a, b))
        at += a * b + b
    return shapes


def _forward(weights: np.ndarray, shapes: list[tuple[int, int, int]], x: np.ndarray) -> list[np.ndarray]:
    """Outputs of all layers, the last before its softmax."""
    out = [x]
    for i, (at, a, b) in enumerate(shapes):
        w = weights[at : at + a * b].reshape(b, a, order="F")
        z = out[-1] @ w.T + weights[at + a * b : at + a * b + b]
        out.append(z if i == len(shapes) - 1 else 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700))))
    return out


def _back_propagation(layers: Sequence[int]) -> Callable[[np.ndarray, np.ndarray], Partial]:
    shapes = layer_shapes(layers)

    def partial(weights: np.ndarray, skip: np.ndarray) -> Partial:
        def of_block(fold: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
            rows = []
            for own, left_out in zip(weights, skip):
                used = fold != left_out
                label = y[used].astype(int)
                out = _forward(own, shapes, x[used])
                z = out[-1] - out[-1].max(axis=1, keepdims=True)
                log_p = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
                grad = np.empty(len(own))
                delta = np.exp(log_p)
                delta[np.arange(len(label)), label] -= 1.0
                for i in range(len(shapes) - 1, -1, -1):
                    at, a, b = shapes[i]
                    grad[at : at + a * b] = (delta.T @ out[i]).ravel(order="F")
                    grad[at + a * b : at + a * b + b] = delta.sum(axis=0)
                    if i:
                        delta = (delta @ own[at : at + a * b].reshape(b, a, order="F")) * out[i] * (1.0 - out[i])
                rows.append(np.append(-log_p[np.arange(len(label)), label].sum(), grad))
            return np.concatenate(rows)

        return of_block

    return partial


def perceptron_fit(m: Moments, skip: int, start: np.ndarray, max_iter: int, tol: float, marks: Sequence[int]) -> Fit:
    same = lambda point: point
    return Fit(skip, m.without(skip)[0], lbfgs(start, max_iter, tol, marks), same, lambda value, grad, _: (value, grad))


def start_weights(layers: Sequence[int], seed: int) -> np.ndarray:
    """Small random weights that depend on nothing but the layers and the seed."""
    rng = np.random.default_rng(seed)
    parts = []
    for _, a, b in layer_shapes(layers):
        parts.append(rng.uniform(-2.4, 2.4, a * b + b) / a)
    return np.concatenate(parts)


def perceptron_model(estimator, train: DataFrame, weights: np.ndarray):
    """Spark's model with the given weights: its own fit from there, of no iterations."""
    from pyspark.ml.linalg import Vectors

    at_once = {estimator.initialWeights: Vectors.dense(weights), estimator.maxIter: 0}
    return estimator.fit(train, at_once)


def linear_svc_model(estimator, train: DataFrame, weights: np.ndarray):
    """Spark's model with the given weights (coefficients, then the intercept); its own fit has a job for each loss that it looks at."""
    from pyspark.ml.classification import LinearSVCModel
    from pyspark.ml.common import _py2java
    from pyspark.ml.linalg import Vectors

    context = train.sparkSession.sparkContext
    made = context._jvm.org.apache.spark.ml.classification.LinearSVCModel
    model = LinearSVCModel(made(estimator.uid, _py2java(context, Vectors.dense(weights[:-1])), float(weights[-1])))
    return estimator._copyValues(model)


Points = Sequence[Mapping[str, float]]


def fit_grid(
    model: str, blocks: Blocks, m: Moments, points: Points, folds: Sequence[int], layers: Sequence[int] = (), seed: int = 0
) -> tuple[np.ndarray, int]:
    """Weights of every (fold left out, grid point), and the passes that they took.

    ``model``: ``logistic_regression``, ``linear_svc`` or ``perceptron``; parameters that a point lacks have Spark's
    defaults.  ``blockSize`` is how Spark cuts its work and changes nothing here.
    """
    shared: dict[tuple, list[int]] = {}
    for j, p in enumerate(points):
        reg, elastic = float(p.get("regParam", 0.0)), float(p.get("elasticNetParam", 0.0))
        shared.setdefault((reg, elastic, float(p.get("tol", 1e-6))), []).append(j)
    last = [int(p.get("maxIter", 100)) for p in points]
    fits: list[Fit] = []
    runs: list[tuple[int, list[int]]] = []
    for i, skip in enumerate(folds):
        for (reg, elastic, tol), some in shared.items():
            marks = [last[j] for j in some]
            if model == "perceptron":
                fits.append(perceptron_fit(m, skip, start_weights(layers, seed), max(marks), tol, marks))
            else:
                loss = "log" if model == "logistic_regression" else "hinge"
                fits.append(linear_fit(loss, m, skip, reg, elastic, max(marks), tol, marks))
            runs.append((i, some))
    passes = solve(blocks, fits, _back_propagation(layers) if model == "perceptron" else _linear("log" if model == "logistic_regression" else "hinge"))
    found: list[list[np.ndarray]] = [[None] * len(points) for _ in folds]  # type: ignore[list-item]
    for fit, (i, some) in zip(fits, runs):
        for j in some:
            found[i][j] = fit.found.get(last[j], fit.found[-1])  # converged before: its last point
    return np.array(found), passes


def scores(blocks: Blocks, weights: np.ndarray, folds: Sequence[int], layers: Sequence[int] = ()) -> DataFrame:
    """``fit int, label int, score double, prediction int``: every held-out row under every point of its fold.

    ``weights``: (folds, points, weights); a fit's number is fold's place × points + point.
    """
    points, dim = weights.shape[1], blocks.dim
    place = {skip: i for i, skip in enumerate(folds)}
    shapes = layer_shapes(layers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fold, label, x in zip(*(c.to_pylist() for c in batch.columns)):
                y, folds_of = np.frombuffer(label, "<f8"), np.frombuffer(fold, "<i4")
                rows = np.frombuffer(x, "<f8").reshape(len(y), dim)
                for value in np.unique(folds_of):
                    if int(value) not in place:
                        continue
                    i, own = place[int(value)], folds_of == value
                    if shapes:
                        last = [_forward(w, shapes, rows[own])[-1] for w in weights[i]]
                        margin = np.stack([z[:, 1] - z[:, 0] for z in last], axis=1)
                    else:
                        margin = rows[own] @ weights[i, :, :-1].T + weights[i, :, -1]
                    fit = np.tile(np.arange(i * points, (i + 1) * points, dtype=np.int32), len(margin))
                    of = np.repeat(y[own].astype(np.int32), points)
                    flat = margin.ravel()
                    columns = [pa.array(fit), pa.array(of), pa.array(flat), pa.array((flat > 0).astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, ["fit", "label", "score", "prediction"])

    return blocks.table.mapInArrow(run, "fit int, label int, score double, prediction int")
