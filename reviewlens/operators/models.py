"""The four classifiers, their default grids and tuning metrics.

Each estimator is a Spark ML stage wrapped in a one-stage ``Pipeline``.
Default grids (regParam, elasticNetParam, ...) are the values the review
study tuned over; callers may pass smaller or larger grids.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.param import Params
from pyspark.ml.tuning import ParamGridBuilder

DEFAULT_MODEL_SEED = 7
HIDDEN = 50

Grid = Mapping[str, Sequence]


@dataclass(frozen=True)
class ModelSpec:
    name: str
    metric: str  # tuning metric: "areaUnderROC" or "accuracy"
    grid: Grid = field(default_factory=dict)

    def estimator(
        self,
        n_features: int,
        seed: int = DEFAULT_MODEL_SEED,
        features: str = "features",
        label: str = "sentiment",
        layers: Sequence[int] | None = None,
    ):
        common = {"featuresCol": features, "labelCol": label}
        if self.name == "logistic_regression":
            return LogisticRegression(**common)
        if self.name == "linear_svc":
            return LinearSVC(**common)
        if self.name == "random_forest":
            # Node ids are cached with the rows instead of shipping every tree
            # to the executors at each level (deep trees); same trees either way.
            return RandomForestClassifier(seed=seed, cacheNodeIds=True, **common)
        if self.name == "perceptron":
            layers = list(layers) if layers is not None else [n_features, HIDDEN, 2]
            if layers[0] != n_features:
                raise ValueError(f"perceptron input layer {layers[0]} != feature size {n_features}")
            return MultilayerPerceptronClassifier(layers=layers, seed=seed, **common)
        raise ValueError(f"unknown model {self.name!r}")

    def pipeline(self, *args, **kwargs) -> tuple[Pipeline, object]:
        est = self.estimator(*args, **kwargs)
        return Pipeline(stages=[est]), est

    def evaluator(self, label: str = "sentiment") -> Evaluator:
        if self.metric == "areaUnderROC":
            return BinaryClassificationEvaluator(
                labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0
            )
        return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=self.metric)


LOGISTIC = ModelSpec(
    "logistic_regression", "areaUnderROC", {"regParam": [0.01, 0.1, 0.2], "elasticNetParam": [0.0, 0.5, 1.0]}
)
SVC = ModelSpec("linear_svc", "accuracy", {"regParam": [0.01, 0.1, 0.2], "maxIter": [10, 50, 100]})
FOREST = ModelSpec("random_forest", "accuracy", {"numTrees": [10, 100], "maxDepth": [5, 10]})
PERCEPTRON = ModelSpec("perceptron", "accuracy", {"blockSize": [128, 256], "maxIter": [100, 200]})

SPECS: dict[str, ModelSpec] = {s.name: s for s in (LOGISTIC, SVC, FOREST, PERCEPTRON)}


def param_grid(est: Params, grid: Grid) -> list[dict]:
    """Cartesian product of ``grid`` as param maps of ``est`` (first key varies slowest)."""
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), list(values))
    return b.build()


def params_text(param_map: Mapping) -> str:
    """``'k=v, ...'`` sorted by parameter name."""
    items = sorted((p.name, v) for p, v in param_map.items())
    return ", ".join(f"{k}={v}" for k, v in items)
