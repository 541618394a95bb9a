"""Batched cross-validation against Spark's own estimators, fit by fit."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewlens.operators import batched, solvers
from reviewlens.operators import metrics as M
from reviewlens.operators.models import LOGISTIC, SVC, SPECS
from reviewlens.operators.tuning import tune

FOLDS = 3
DIM = 8


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((240, DIM)) * np.arange(1, DIM + 1) + 3
    x[:, 5] = 2.0  # a feature that never varies
    y = (x[:, 0] - 0.3 * x[:, 1] + rng.standard_normal(240) * 2 > 1).astype(int)
    rows = [(int(i % FOLDS), int(y[i]), x[i].tolist()) for i in range(240)]
    df = spark.createDataFrame(rows, "fold int, sentiment int, x array<double>").repartition(4)
    return df.select("fold", "sentiment", array_to_vector("x").alias("features")).persist()


@pytest.fixture(scope="module")
def blocks(train):
    made = batched.Blocks(train)
    yield made
    made.close()


@pytest.fixture(scope="module")
def seen(blocks):
    return batched.moments(blocks, FOLDS)


def test_moments_leave_a_fold_out(train, seen):
    for skip in (0, 2, batched.NO_FOLD):
        rows = train.filter(F.col("fold") != skip).collect()
        x = np.stack([r["features"].toArray() for r in rows])
        n, positive, mean, deviation = seen.without(skip)
        assert (n, positive) == (len(rows), sum(r["sentiment"] for r in rows))
        assert np.allclose(mean, x.mean(0)) and np.allclose(deviation, x.std(0, ddof=1))


def held_out(model, train, fold, metric):
    rows = model.transform(train.filter(F.col("fold") == fold))
    if metric == "areaUnderROC":
        return BinaryClassificationEvaluator(labelCol="sentiment", numBins=0).evaluate(rows)
    return MulticlassClassificationEvaluator(labelCol="sentiment", metricName="accuracy").evaluate(rows)


def test_logistic_points_equal_sparks(train, blocks, seen):
    points = [{"regParam": r, "elasticNetParam": e} for r, e in ((0.01, 0.0), (0.1, 0.5), (0.2, 1.0))]
    weights, _ = batched.fit_grid("logistic_regression", blocks, seen, points, range(FOLDS))
    values = M.fit_metrics(batched.scores(blocks, weights, range(FOLDS)), ["areaUnderROC"])
    for fold in range(2):
        for j, p in enumerate(points):
            model = LogisticRegression(labelCol="sentiment", **p).fit(train.filter(F.col("fold") != fold))
            assert np.allclose(weights[fold, j, :-1], model.coefficients.toArray(), atol=1e-3)
            assert weights[fold, j, -1] == pytest.approx(model.intercept, abs=1e-3)
            assert values[fold * 3 + j]["areaUnderROC"] == pytest.approx(held_out(model, train, fold, "areaUnderROC"), abs=1e-3)


def test_svc_points_share_a_run_and_equal_sparks(train, blocks, seen):
    points = [{"regParam": 0.01, "maxIter": n} for n in (100, 10, 50)]
    weights, passes = batched.fit_grid("linear_svc", blocks, seen, points, range(FOLDS))
    alone = sum(batched.fit_grid("linear_svc", blocks, seen, [p], [0])[1] for p in points)
    assert passes < alone
    values = M.fit_metrics(batched.scores(blocks, weights, range(FOLDS)), ["accuracy"])
    for j, p in enumerate(points):
        model = LinearSVC(labelCol="sentiment", **p).fit(train.filter(F.col("fold") != 1).coalesce(1))
        assert np.allclose(weights[1, j, :-1], model.coefficients.toArray(), atol=1e-6)
        assert values[3 + j]["accuracy"] == pytest.approx(held_out(model, train, 1, "accuracy"), abs=1e-3)


def test_perceptron_points_share_a_run_and_equal_sparks(train, blocks, seen):
    layers = (DIM, 50, 2)
    points = [{"blockSize": b, "maxIter": n} for b in (128, 256) for n in (5, 15)]
    weights, passes = batched.fit_grid("perceptron", blocks, seen, points, [0, batched.NO_FOLD], layers, seed=3)
    assert passes < 40 and np.array_equal(weights[:, 0], weights[:, 2])
    start = Vectors.dense(batched.start_weights(layers, 3))
    rows = train.filter(F.col("fold") != 0).coalesce(1)
    for j, n in ((0, 5), (1, 15)):
        model = MultilayerPerceptronClassifier(labelCol="sentiment", layers=layers, maxIter=n, blockSize=4096, initialWeights=start).fit(rows)
        assert np.allclose(weights[0, j], model.weights.toArray(), atol=1e-6)
    whole = batched.perceptron_model(SPECS["perceptron"].estimator(DIM), train, weights[1, 3])
    assert np.array_equal(whole.weights.toArray(), weights[1, 3])
    margins = batched.scores(blocks, weights[:1], [0], layers).filter("fit = 1").agg(F.sum("prediction")).first()[0]
    assert margins == model.transform(train.filter("fold = 0")).agg(F.sum("prediction")).first()[0]


def test_sums_do_not_depend_on_partitions(train, blocks, seen, monkeypatch):
    points = [{"regParam": 0.1, "maxIter": 10}]
    want, _ = batched.fit_grid("linear_svc", blocks, seen, points, [0])
    monkeypatch.setattr(batched, "TASK_BYTES", 1 << 12)
    monkeypatch.setattr(batched, "DIRECT", 1)
    monkeypatch.setattr(batched, "BLOCK_ROWS", 7)
    many = batched.Blocks(train)
    assert many.partitions > 1 and many.table.rdd.getNumPartitions() == 4
    got, _ = batched.fit_grid("linear_svc", many, batched.moments(many, FOLDS), points, [0])
    many.close()
    assert np.allclose(got, want, atol=1e-9)


def test_one_sum_reaches_the_driver(train, monkeypatch):
    monkeypatch.setattr(batched, "TASK_BYTES", 1 << 12)
    many = batched.Blocks(train)
    assert many.table.rdd.getNumPartitions() == 4
    sums, collect = [], type(many.table).collect
    monkeypatch.setattr(type(many.table), "collect", lambda df: sums.append(collect(df)) or sums[-1])
    total = many.total(lambda fold, y, x: x.sum(axis=0))
    monkeypatch.undo()
    assert [len(rows) for rows in sums] == [1]
    assert np.allclose(total, np.sum([r["features"].toArray() for r in train.collect()], axis=0))
    many.close()


def test_metrics_by_fit_equal_one_by_one(spark):
    rng = np.random.default_rng(1)
    rows = [(int(f), int(rng.integers(2)), float(rng.integers(20)) / 20, int(rng.integers(2))) for f in range(5) for _ in range(60 + f)]
    rows += [(5, 1, 0.5, 1), (5, 1, 0.25, 0), (6, 0, None, 0)]  # one class only; no score
    long = spark.createDataFrame(rows, "fit int, label int, score double, prediction int").repartition(5)
    got = M.fit_metrics(long)
    for fit in range(6):
        own = long.filter(F.col("fit") == fit)
        both = M.accuracy_and_f1(M.confusion(own, "label")).first()
        assert got[fit]["areaUnderROC"] == M.auc(own, "label").first()["auc"]
        assert (got[fit]["accuracy"], got[fit]["f1"]) == pytest.approx((both["accuracy"], both["f1"]), abs=1e-12)
    assert got[5]["areaUnderROC"] is None and got[6]["areaUnderROC"] is None


def test_tuning_picks_the_best_point_of_all(train):
    result = tune(SVC, train, DIM, FOLDS, {"regParam": [0.01, 0.2], "maxIter": [10, 50]})
    assert len(result.avg) == 4 and result.best_params == result.params[int(np.argmax(result.avg))]
    lasso = tune(LOGISTIC, train, DIM, FOLDS, {"regParam": [10.0], "elasticNetParam": [1.0]})
    assert lasso.avg == [0.5] and lasso.std == [0.0]
    other = tune(LOGISTIC, train, DIM, FOLDS, {"regParam": [0.1], "threshold": [0.5]})  # not a batched parameter
    assert other.avg[0] > 0.6


def hinge_rows():
    rng = np.random.default_rng(9)
    x = rng.standard_normal((1000, 3))
    x[:, 0] = 1
    return x, np.where(rng.standard_normal(1000) > 0, 1.0, -1.0)


def run_hinge(x, sign, max_iter):
    """(points by iteration, passes, points asked for) of a hinge fit that is answered point by point."""

    def loss(w):
        slack = np.maximum(0.0, 1.0 - sign * (x @ w))
        return slack.mean() + 0.005 * float(w @ w), -(x.T @ (sign * (slack > 0))) / len(x) + 0.01 * w

    solver, passes, points = solvers.owlqn(np.zeros(x.shape[1]), np.zeros(x.shape[1]), max_iter, 0.0, range(max_iter)), 0, 0
    asked = next(solver)
    while True:
        passes, points = passes + 1, points + len(asked)
        try:
            asked = solver.send([loss(w) for w in asked])
        except StopIteration as end:
            return end.value, passes, points


def test_a_search_asks_for_its_trials_together(monkeypatch):
    """The hinge's searches take up to 20 trials each; one trial, then seven at a time made 410 passes here."""
    x, sign = hinge_rows()
    together, passes, _ = run_hinge(x, sign, 100)
    monkeypatch.setattr(solvers, "_following", lambda step, shrink, count, grew: [step])
    one_by_one, each, trials = run_hinge(x, sign, 100)
    assert together.keys() == one_by_one.keys() and all(np.array_equal(together[i], one_by_one[i]) for i in together)
    assert each == trials > 5 * len(together)
    assert passes < 2.2 * len(together)


def test_trials_that_may_follow():
    assert solvers._following(1.0, 0.5, 3, False) == [1.0, 0.5, 0.25]
    assert solvers._following(2.1, 0.5, 4, True) == [2.1, 1.05, 0.525, 0.2625, 1.05 * 2.1, 1.05 * 2.1 * 0.5]
    assert solvers._following(3e-10, 0.5, 5, False) == [3e-10, 1.5e-10]


def test_the_best_svc_comes_with_the_folds(train, monkeypatch):
    points = {"regParam": [0.01], "maxIter": [50]}
    want = LinearSVC(labelCol="sentiment", regParam=0.01, maxIter=50).fit(train.coalesce(1))

    def fitted_again(*_):
        raise AssertionError("fitted once more, a job for each loss")

    monkeypatch.setattr(LinearSVC, "_fit", fitted_again)
    model = tune(SVC, train, DIM, FOLDS, points).best_model.stages[0]
    assert np.allclose(model.coefficients.toArray(), want.coefficients.toArray(), atol=1e-6)
    assert model.intercept == pytest.approx(want.intercept, abs=1e-6)
    scored = [m.transform(train).select("prediction").collect() for m in (model, want)]
    assert scored[0] == scored[1] and len(scored[0]) == 240


def test_few_rows_are_summed_on_all_cores(train, blocks, monkeypatch):
    assert blocks.partitions == 1
    monkeypatch.setattr(batched, "SMALL_TASK_BYTES", 1 << 12)
    many = batched.Blocks(train)
    assert many.partitions == 4 and many.table.rdd.getNumPartitions() == 4
    many.close()
