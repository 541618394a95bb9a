"""K-fold cross-validation over parameter grids, on precomputed hash folds.

Folds come from the ``fold`` column (``split.with_folds``), so they do not
depend on partitioning.

* Models whose loss is a sum over rows (logistic regression, linear SVC, perceptron) are fitted for all
  folds and grid points together (``batched``): every iteration is one aggregate, and one set of jobs
  scores and evaluates all held-out rows of all fits.
* Forests are independent Spark fits, one a (fold, grid point); one pool of ``parallelism`` driver
  threads runs them, fold by fold, so all fits of a fold share one cached copy of its rows, which
  is released after the last.  On a table partitioned by fold, a held-out read is that fold's folder alone.

The winning grid point of each model is refitted on all training rows by Spark's estimator; the SVC's and the perceptron's
weights on all rows come with the others.
Only sums of the size of the models, and metric numbers, reach the driver.

With a ``journal`` folder every finished unit is kept there (``journal``): a run that is started again on the
same rows reads them and fits only what is not there yet, and the winners.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from threading import Lock

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.operators import batched
from reviewlens.operators.journal import ALL_ROWS, Journal, training_digest
from reviewlens.operators.metrics import fit_metrics
from reviewlens.operators.models import DEFAULT_MODEL_SEED, HIDDEN, Grid, ModelSpec, param_grid, params_text
from reviewlens.operators.split import check_classes
from reviewlens.schema import GRID_METRICS
from reviewlens.session import in_threads


#: Bytes of features of a forest's task.  At every level each task sends the bin counts of all open nodes, whatever its rows: more
#: rows a task, fewer of them; fits run side by side.
FOREST_TASK_BYTES = 64 << 20


@dataclass
class TuneResult:
    spec: ModelSpec
    best_model: PipelineModel
    best_params: str
    params: list[str]
    avg: list[float]
    std: list[float]
    grid_metrics: DataFrame


class _Folds:
    """Fit and held-out rows of each fold, cached while fits of that fold are to come."""

    def __init__(self, train: DataFrame, fold: str, fits: dict[int, int], partitions: int):
        # small files share a task, by bytes: every level of a tree is a job
        self.train, self.fold, self.left = train.coalesce(partitions), fold, dict(fits)
        self.rows: dict[int, tuple[DataFrame, DataFrame]] = {}
        self.lock = Lock()

    def take(self, i: int) -> tuple[DataFrame, DataFrame]:
        with self.lock:
            if i not in self.rows:
                here = F.col(self.fold) == i
                self.rows[i] = self.train.filter(~here).persist(), self.train.filter(here).persist()
            return self.rows[i]

    def done(self, i: int) -> None:
        with self.lock:
            self.left[i] -= 1
            if not self.left[i]:
                for df in self.rows.pop(i):
                    df.unpersist()


#: Models fitted for all folds and points together, and the parameters that their grids may hold for that.
BATCHED = {
    "logistic_regression": {"regParam", "elasticNetParam", "maxIter", "tol"},
    "linear_svc": {"regParam", "maxIter", "tol"},
    "perceptron": {"blockSize", "maxIter", "tol"},
}


#: Models that are not refitted, as their weights on all rows come with the folds, and what makes Spark's model of them.
WHOLE = {"linear_svc": batched.linear_svc_model, "perceptron": batched.perceptron_model}


def _names(grid: Sequence[Mapping]) -> list[str]:
    return [p.name for point in grid for p in point]


def fold_scores(
    spec: ModelSpec, blocks: batched.Blocks, seen: batched.Moments, grid: Sequence[Mapping], k: int, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """The tuning metric of every (fold, grid point), fitted, scored and evaluated together; every point's weights on all rows."""
    points = [{p.name: v for p, v in point.items()} for point in grid]
    layers = (blocks.dim, HIDDEN, 2) if spec.name == "perceptron" else ()
    left_out = [*range(k), batched.NO_FOLD] if spec.name in WHOLE else range(k)
    weights, _ = batched.fit_grid(spec.name, blocks, seen, points, left_out, layers, seed)
    scored = batched.scores(blocks, weights[:k], range(k), layers).persist()
    try:
        values = fit_metrics(scored, [spec.metric])
    finally:
        scored.unpersist()
    table = [[values[i * len(points) + j][spec.metric] for j in range(len(points))] for i in range(k)]
    return np.array(table, float), weights[k:]


def tune_models(
    specs: Sequence[ModelSpec],
    train: DataFrame,
    n_features: int,
    k: int,
    grids: Mapping[str, Grid] | None = None,
    feature_set: str = "summary",
    label: str = "sentiment",
    features: str = "features",
    fold: str = "fold",
    seed: int = DEFAULT_MODEL_SEED,
    parallelism: int = 1,
    check: bool = True,
    journal: str | None = None,
) -> list[TuneResult]:
    """Cross-validate each spec over its grid and refit its best point on ``train``.

    ``journal``: a folder of the shared store that keeps finished fits for a run started again.
    """
    if check:
        check_classes(train, label, by=fold, groups=k, what="training folds")
    pipes, maps = [], []
    for spec in specs:
        pipe, est = spec.pipeline(n_features, seed=seed, features=features, label=label)
        pipes.append(pipe)
        maps.append(param_grid(est, (grids or {}).get(spec.name, spec.grid)) or [{}])
    scores = [np.zeros((k, len(grid))) for grid in maps]
    whole: dict[int, np.ndarray] = {}  # weights on all rows, of models that are not refitted
    together = [m for m, spec in enumerate(specs) if spec.name in BATCHED and set(_names(maps[m])) <= BATCHED[spec.name]]
    texts = [[params_text(p) for p in grid] for grid in maps]
    log = None
    if journal:
        log = Journal(train.sparkSession, journal, training_digest(train, features, label, fold, n_features, k, seed))

    def kept(m: int, i: int, j: int) -> tuple | None:
        return log.get(specs[m].name, specs[m].metric, i, texts[m][j]) if log else None

    def keep(m: int, fits: list[tuple]) -> None:
        if log:
            log.put([(specs[m].name, specs[m].metric, i, texts[m][j], v, w) for i, j, v, w in fits])

    todo = []
    for m in together:
        sides = [*range(k), ALL_ROWS] if specs[m].name in WHOLE else range(k)
        found = {(i, j): kept(m, i, j) for i in sides for j in range(len(maps[m]))}
        if None in found.values():
            todo.append(m)
            continue
        scores[m][:] = [[found[i, j][0] for j in range(len(maps[m]))] for i in range(k)]
        if ALL_ROWS in sides:
            whole[m] = np.array([[found[ALL_ROWS, j][1] for j in range(len(maps[m]))]])
    if todo:
        blocks = batched.Blocks(train, features, label, fold)
        try:
            seen = batched.moments(blocks, k)
            for m in todo:
                scores[m][:], whole[m] = fold_scores(specs[m], blocks, seen, maps[m], k, seed)
                fits = [(i, j, float(scores[m][i, j]), None) for i in range(k) for j in range(len(maps[m]))]
                keep(m, fits + [(ALL_ROWS, j, None, w.tolist()) for own in whole[m] for j, w in enumerate(own)])
        finally:
            blocks.close()
    alone = [m for m in range(len(specs)) if m not in together]
    tasks = []
    for i, m, j in [(i, m, j) for i in range(k) for m in alone for j in range(len(maps[m]))]:
        if found := kept(m, i, j):
            scores[m][i, j] = found[0]
        else:
            tasks.append((i, m, j))
    partitions = batched.partitions_for(train.count(), n_features, FOREST_TASK_BYTES) if alone else 1
    folds = _Folds(train, fold, dict(Counter(i for i, _, _ in tasks)), partitions)

    def run(task: tuple[int, int, int]) -> float:
        i, m, j = task
        fit_rows, held_out = folds.take(i)
        try:
            value = specs[m].evaluator(label).evaluate(pipes[m].fit(fit_rows, maps[m][j]).transform(held_out))
        finally:
            folds.done(i)
        keep(m, [(i, j, float(value), None)])
        return value

    def refit(m: int) -> PipelineModel:
        if len(whole.get(m, ())):
            estimator = pipes[m].getStages()[0].copy(maps[m][best[m]])
            return PipelineModel(stages=[WHOLE[specs[m].name](estimator, train, whole[m][0, best[m]])])
        return pipes[m].fit(train if m in together else folds.train, maps[m][best[m]])

    for (i, m, j), v in zip(tasks, in_threads(train.sparkSession, run, tasks, parallelism)):
        scores[m][i, j] = v
    avg = [s.mean(axis=0).tolist() for s in scores]
    std = [s.std(axis=0).tolist() for s in scores]
    best = [int(np.argmax(a)) for a in avg]
    models = in_threads(train.sparkSession, refit, range(len(specs)), parallelism)
    out = []
    for m, spec in enumerate(specs):
        rows = [(feature_set, spec.name, t, spec.metric, a, s) for t, a, s in zip(texts[m], avg[m], std[m])]
        table = train.sparkSession.createDataFrame(rows, GRID_METRICS)
        out.append(TuneResult(spec, models[m], texts[m][best[m]], texts[m], avg[m], std[m], table))
    return out


def tune(spec: ModelSpec, train: DataFrame, n_features: int, k: int, grid: Grid | None = None, **options) -> TuneResult:
    """``tune_models`` of one spec."""
    return tune_models([spec], train, n_features, k, {spec.name: grid} if grid is not None else None, **options)[0]
