"""Score tuned models on the same held-out rows and tabulate the results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.operators.metrics import METRICS, fit_metrics, score_column
from reviewlens.operators.tuning import TuneResult


def scored_side_by_side(results: Sequence[TuneResult], test: DataFrame, label: str = "sentiment") -> DataFrame:
    """``fit, label, score, prediction``: the rows under every best model, from one scan.

    The models' outputs stand side by side in one narrow plan and are turned into one row a model at its end.
    """
    keep = test.columns
    wide, outputs = test, []
    for i, result in enumerate(results):
        score, prediction = f"__score_{i}", f"__prediction_{i}"
        scored = result.best_model.transform(wide)
        wide = scored.select(*keep, score_column().alias(score), F.col("prediction").cast("int").alias(prediction))
        keep = wide.columns
        outputs.append(F.struct(F.lit(i).alias("fit"), F.col(label).cast("int").alias("label"), F.col(score).alias("score"), F.col(prediction).alias("prediction")))
    return wide.select(F.inline(F.array(*outputs)))


def report_rows(feature_set: str, results: Sequence[TuneResult], test: DataFrame, label: str = "sentiment") -> list[tuple]:
    """``(feature_set, model, params, metric, value)`` for AUC, accuracy and F1 of every model: one scoring of the rows."""
    scored = scored_side_by_side(results, test, label).persist()
    try:
        values = fit_metrics(scored)
    finally:
        scored.unpersist()
    return [(feature_set, r.spec.name, r.best_params, m, values[i][m]) for i, r in enumerate(results) for m in METRICS]
