"""Aggregate metrics against Spark's evaluators and brute force."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

from reviewlens.operators import metrics as M


def scored(spark, n=600, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = 1 if rnd.random() < 0.7 else 0
        s = round(min(1.0, max(0.0, rnd.gauss(0.6 if y else 0.4, 0.2))), 2)  # many ties
        rows.append((i, y, s, 1.0 if s > 0.5 else 0.0))
    return spark.createDataFrame(rows, "review_id long, y int, score double, prediction double"), rows


def brute_auc(rows):
    pos = [r[2] for r in rows if r[1] == 1]
    neg = [r[2] for r in rows if r[1] == 0]
    total = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return total / (len(pos) * len(neg))


def test_auc_exact(spark):
    df, rows = scored(spark)
    got = M.auc(df, "y", "score").first()["auc"]
    assert got == pytest.approx(brute_auc(rows), abs=1e-12)
    ev = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="score", numBins=0).evaluate(df)
    assert got == pytest.approx(ev, abs=1e-12)
    # independent of how rows are dealt
    assert M.auc(df.repartition(7), "y", "score").first()["auc"] == pytest.approx(got, abs=1e-15)


def test_auc_of_very_many_rows(spark):
    """Class totals whose product is beyond 64 bits."""
    counts = [(2 * 10**9, 10**9, 0), (10**9, 2 * 10**9, 10**9)]
    df = spark.createDataFrame(counts, "pos long, neg long, below long")
    want = sum(p * (2 * b + n) for p, n, b in counts) / (2 * 3 * 10**9 * 3 * 10**9)
    assert M.auc_of_counts(df).first()["auc"] == pytest.approx(want, rel=1e-12)


def test_auc_one_class_is_null(spark):
    df, _ = scored(spark)
    assert M.auc(df.filter("y = 1"), "y", "score").first()["auc"] is None


def test_accuracy_and_f1(spark):
    df, _ = scored(spark)
    cm = M.confusion(df, "y", "prediction")
    acc = M.accuracy(cm).first()["accuracy"]
    f1 = M.weighted_f1(cm).first()["f1"]
    ev = MulticlassClassificationEvaluator(labelCol="y", predictionCol="prediction")
    assert acc == pytest.approx(ev.setMetricName("accuracy").evaluate(df), abs=1e-12)
    assert f1 == pytest.approx(ev.setMetricName("f1").evaluate(df), abs=1e-12)


def test_f1_with_missing_prediction_class(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0), (0, 1.0)], "y int, prediction double")
    cm = M.confusion(df, "y", "prediction")
    ev = MulticlassClassificationEvaluator(labelCol="y", predictionCol="prediction", metricName="f1")
    assert M.weighted_f1(cm).first()["f1"] == pytest.approx(ev.evaluate(df), abs=1e-12)


def test_auc_reads_one_table_and_broadcasts_range_totals(spark):
    df, _ = scored(spark)
    plan = M.auc(df, "y", "score")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LocalTableScan" not in plan and "Scan ExistingRDD" not in plan
    windows = [x for x in plan.splitlines() if " Window " in x or x.strip().startswith("+- Window")]
    assert any("[r#" in x for x in windows)  # the running sum is inside a range


def test_accuracy_and_f1_together(spark):
    df, _ = scored(spark)
    cm = M.confusion(df, "y", "prediction")
    both = M.accuracy_and_f1(cm).first()
    assert both["accuracy"] == pytest.approx(M.accuracy(cm).first()["accuracy"], abs=1e-15)
    assert both["f1"] == pytest.approx(M.weighted_f1(cm).first()["f1"], abs=1e-15)
