"""Classification metrics as aggregations.

* ``confusion``: rows per (label, prediction) -- at most 4 rows for two classes.
* ``accuracy`` and label-weighted ``weighted_f1`` are computed from those few rows.
* ``auc``: exact area under the ROC curve with ties counted half.  Scores
  are first grouped (one row per distinct score) and range-partitioned into a
  written table, which is read for everything else: a running sum of negatives
  inside each range plus the total of all lower ranges gives, for every score, the
  negatives ranked below it.  Adaptive execution sizes the ranges by their data.  The
  only unpartitioned window runs over one row per range.  Counts are decimal(38,0)
  until the final division, so the value does not depend on summation order.

* ``auc_by``, ``accuracy_and_f1_by``: the same for many scored fits in one long table, keyed by fit: one set of
  jobs whatever the number of fits.

``accuracy``, ``weighted_f1``, ``accuracy_and_f1`` and ``auc`` return one-row DataFrames;
``fit_metrics`` collects the three numbers of every fit (three numbers a fit), ``evaluate`` those of one scored model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.session import materialize, remove_path, shared_path, written

DEC = "decimal(38,0)"
METRICS = ("areaUnderROC", "accuracy", "f1")


def confusion(df: DataFrame, label: str = "sentiment", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)`` with both as int."""
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def accuracy(cm: DataFrame) -> DataFrame:
    """Share of rows with prediction = label."""
    return cm.agg(
        (
            F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
            / F.sum("n").cast("double")
        ).alias("accuracy")
    )


def _per_label(cm: DataFrame) -> DataFrame:
    """Support, predicted count and true positives per label, in one pass.

    Each confusion row counts once for its true label (support, true
    positives) and once for its predicted label.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0).cast("long"))
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("l"), F.col("n").alias("sup"), zero.alias("prd"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("l"), zero.alias("sup"), F.col("n").alias("prd"), zero.alias("tp")),
    )
    return (
        cm.select(F.inline(sides))
        .groupBy("l")
        .agg(F.sum("sup").alias("sup"), F.sum("prd").alias("prd"), F.sum("tp").alias("tp"))
    )


def _f1_expr():
    f1 = F.when(F.col("tp") == 0, F.lit(0.0)).otherwise(2.0 * F.col("tp") / (F.col("sup") + F.col("prd")))
    return F.sum(F.col("sup") * f1) / F.sum("sup")


def weighted_f1(cm: DataFrame) -> DataFrame:
    """F1 per true label, weighted by the label's share of rows."""
    return _per_label(cm).agg(_f1_expr().alias("f1"))


def accuracy_and_f1(cm: DataFrame) -> DataFrame:
    """Both label metrics from one aggregation (correct rows = sum of true positives)."""
    return _per_label(cm).agg(
        (F.sum("tp") / F.sum("sup").cast("double")).alias("accuracy"), _f1_expr().alias("f1")
    )


def score_column(raw: str = "rawPrediction") -> Column:
    """Class-1 score from an ML raw-prediction vector."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(raw))[1]


def auc_of_counts(scored: DataFrame) -> DataFrame:
    """AUC from ``pos, neg, below`` per score: positives, negatives, negatives with a lower score."""
    pos, neg, below = (F.col(c).cast(DEC) for c in ("pos", "neg", "below"))
    sums = scored.agg(
        F.sum(pos * (2 * below + neg)).cast(DEC).alias("num"), F.sum(pos).cast(DEC).alias("p"), F.sum(neg).cast(DEC).alias("n")
    )
    pairs = 2.0 * F.col("p").cast("double") * F.col("n").cast("double")
    return sums.select(F.try_divide(F.col("num").cast("double"), pairs).alias("auc"))


def auc(df: DataFrame, label: str = "sentiment", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve of ``score`` for a 0/1 ``label``."""
    y = F.col(label).cast("long")
    by_score = (
        df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score)) & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("s"))
        .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    )
    ranged = materialize(by_score.repartitionByRange("s").withColumn("r", F.spark_partition_id()), "scores")
    below_in_range = Window.partitionBy("r").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumn("cin", F.coalesce(F.sum("neg").over(below_in_range), F.lit(0)))
    lower_ranges = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("r")
        .agg(F.sum("neg").alias("rn"))
        .withColumn("off", F.coalesce(F.sum("rn").over(lower_ranges), F.lit(0)))
        .select("r", "off")
    )
    # offsets holds one row per range, at most one a shuffle partition: a bounded broadcast.
    scored = within.join(F.broadcast(offsets), "r")
    return auc_of_counts(scored.select("pos", "neg", (F.col("off") + F.col("cin")).alias("below")))


def accuracy_and_f1_by(df: DataFrame, by: str = "fit", label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``by, accuracy, f1`` of every fit's rows."""
    cells = df.groupBy(by, F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hit, zero = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0), F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("l"), F.col("n").alias("sup"), zero.alias("prd"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("l"), zero.alias("sup"), F.col("n").alias("prd"), zero.alias("tp")),
    )
    per_label = cells.select(by, F.inline(sides)).groupBy(by, "l").agg(*(F.sum(c).alias(c) for c in ("sup", "prd", "tp")))
    share = F.sum("tp") / F.sum("sup").cast("double")
    return per_label.groupBy(by).agg(share.alias("accuracy"), _f1_expr().alias("f1"))


def auc_by(ranged: DataFrame, by: str = "fit") -> DataFrame:
    """``by, auc`` from ``by, s, pos, neg, r``: classes by fit and score, and the range of (fit, score) that a row lies in."""
    below_in_range = Window.partitionBy("r", by).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumn("cin", F.coalesce(F.sum("neg").over(below_in_range), F.lit(0)))
    lower_ranges = Window.partitionBy(by).orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(by, "r").agg(F.sum("neg").alias("rn"))
    offsets = offsets.select(by, "r", F.coalesce(F.sum("rn").over(lower_ranges), F.lit(0)).alias("off"))
    # ranges follow one another, so offsets holds at most one row a range and a fit: a bounded broadcast.
    scored = within.join(F.broadcast(offsets), [by, "r"])
    pos, neg, below = (c.cast(DEC) for c in (F.col("pos"), F.col("neg"), F.col("off") + F.col("cin")))
    sums = scored.groupBy(by).agg(
        F.sum(pos * (2 * below + neg)).cast(DEC).alias("num"), F.sum(pos).cast(DEC).alias("p"), F.sum(neg).cast(DEC).alias("n")
    )
    pairs = 2.0 * F.col("p").cast("double") * F.col("n").cast("double")
    return sums.select(by, F.try_divide(F.col("num").cast("double"), pairs).alias("auc"))


def scored_ranges(df: DataFrame, path: str, by: str = "fit", label: str = "label", score: str = "score") -> DataFrame:
    """Class counts by (fit, score), dealt by ranges of both and written to ``path``: what ``auc_by`` reads."""
    y = F.col(label).cast("long")
    by_score = (
        df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score)) & F.col(label).isNotNull())
        .groupBy(by, F.col(score).cast("double").alias("s"))
        .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    )
    return written(by_score.repartitionByRange(by, "s").withColumn("r", F.spark_partition_id()), path)


def fit_metrics(scored: DataFrame, metrics: Sequence[str] = METRICS) -> dict[int, dict[str, float | None]]:
    """Every fit's metrics from ``fit, label, score, prediction`` rows: three numbers a fit reach the driver."""
    found: dict[int, dict[str, float | None]] = {}
    if "accuracy" in metrics or "f1" in metrics:
        for r in accuracy_and_f1_by(scored).collect():
            found.setdefault(r["fit"], {}).update(accuracy=r["accuracy"], f1=r["f1"])
    if "areaUnderROC" in metrics:
        path = shared_path(scored.sparkSession, "scores")
        for r in auc_by(scored_ranges(scored, path)).collect():
            found.setdefault(r["fit"], {})["areaUnderROC"] = r["auc"]
        remove_path(scored.sparkSession, path)
    return {fit: {m: values.get(m) for m in metrics} for fit, values in found.items()}


def evaluate(
    predictions: DataFrame,
    label: str = "sentiment",
    prediction: str = "prediction",
    raw: str = "rawPrediction",
) -> dict[str, float | None]:
    """AUC (on the class-1 raw score), accuracy and weighted F1 of scored rows."""
    p = predictions.select(
        F.col(label).cast("int").alias(label),
        F.col(prediction).alias(prediction),
        score_column(raw).alias("score"),
    ).persist()
    try:
        labels = accuracy_and_f1(confusion(p, label, prediction)).first()
        return {
            "areaUnderROC": auc(p, label, "score").first()["auc"],
            "accuracy": labels["accuracy"],
            "f1": labels["f1"],
        }
    finally:
        p.unpersist()
