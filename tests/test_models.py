"""Learned models on separable hand-made text: bounds, failures, determinism."""

import random

import pytest
from pyspark.sql import functions as F

from reviewlens.operators.models import SPECS, param_grid, params_text
from reviewlens.plans.sentiment import prepare_features, run_section

GOOD = ["great", "excellent", "superb", "lovely", "fantastic", "brilliant"]
BAD = ["awful", "terrible", "poor", "broken", "boring", "dreadful"]
SMALL = {
    "logistic_regression": {"regParam": [0.01], "elasticNetParam": [0.0]},
    "linear_svc": {"regParam": [0.01], "maxIter": [50]},
    "random_forest": {"numTrees": [20], "maxDepth": [4]},
    "perceptron": {"blockSize": [128], "maxIter": [100]},
}


def separable(spark, n=160, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        pos = i % 2 == 0
        words = [rnd.choice(GOOD if pos else BAD) for _ in range(rnd.randint(4, 8))]
        rows.append((i, " ".join(words), 8.0 if pos else 2.0))
    return spark.createDataFrame(rows, "review_id long, review_summary string, rating double")


@pytest.fixture(scope="module")
def feats(spark):
    return prepare_features(separable(spark), "summary", k=3, dim=16, num_partitions=1)


def test_feature_table_shape(feats):
    assert feats.n_features == 16
    assert set(feats.train.columns) == {"review_id", "sentiment", "fold", "features"}
    tr = {r.review_id for r in feats.train.collect()}
    te = {r.review_id for r in feats.test.collect()}
    assert not tr & te and len(tr | te) == 160


def test_all_models_learn_separable_text(feats):
    res = run_section(feats, grids=SMALL, parallelism=2)
    report = {(r.model, r.metric): r.value for r in res.report.collect()}
    assert len(report) == 12
    for model in SPECS:
        assert report[(model, "areaUnderROC")] > 0.9, model
        assert report[(model, "accuracy")] > 0.8, model
    grid = res.grid_metrics.collect()
    assert len(grid) == 4 and all(0.0 <= r.avg <= 1.0 for r in grid)


def test_same_seed_same_results(spark, feats):
    a = run_section(feats, ["random_forest"], grids=SMALL).report.collect()
    feats2 = prepare_features(separable(spark), "summary", k=3, dim=16, num_partitions=1)
    b = run_section(feats2, ["random_forest"], grids=SMALL).report.collect()
    assert a == b


def test_perceptron_layer_mismatch():
    with pytest.raises(ValueError, match="input layer"):
        SPECS["perceptron"].estimator(200, layers=[100, 50, 2])
    est = SPECS["perceptron"].estimator(200)
    assert est.getLayers() == [200, 50, 2]


def test_default_grids_and_params_text():
    sizes = {name: len(param_grid(spec.estimator(100), spec.grid)) for name, spec in SPECS.items()}
    assert sizes == {"logistic_regression": 9, "linear_svc": 9, "random_forest": 4, "perceptron": 4}
    est = SPECS["logistic_regression"].estimator(100)
    first = param_grid(est, SPECS["logistic_regression"].grid)[0]
    assert params_text(first) == "elasticNetParam=0.0, regParam=0.01"


def test_one_class_fold_raises(spark):
    rows = [(i, "great superb lovely great superb", 8.0) for i in range(40)]
    df = spark.createDataFrame(rows, "review_id long, review_summary string, rating double")
    f = prepare_features(df, "summary", k=3, dim=8, num_partitions=1)
    with pytest.raises(ValueError, match="one class"):
        run_section(f, ["logistic_regression"], grids=SMALL)


def test_study_over_two_feature_sets(spark):
    from reviewlens.plans.sentiment import run_study

    rnd = random.Random(11)
    rows = []
    for i in range(120):
        pos = i % 2 == 0
        pick = lambda: rnd.choice(GOOD if pos else BAD)
        rows.append((i, " ".join(pick() for _ in range(4)), " ".join(pick() for _ in range(6)), 8.0 if pos else 2.0))
    df = spark.createDataFrame(rows, "review_id long, review_summary string, review_detail string, rating double")
    study = run_study(df, ["summary", "both"], ["logistic_regression"], SMALL, k=3, dim=8, num_partitions=1)
    assert {(r.feature_set, r.metric) for r in study.report.collect()} == {
        (fs, m) for fs in ("summary", "both") for m in ("areaUnderROC", "accuracy", "f1")
    }
    assert study.grid_metrics.count() == 2
    assert study.sections[1].features.n_features == 16


def test_parallel_tuning_equals_sequential(feats):
    from reviewlens.operators.tuning import tune

    grid = {"regParam": [0.01, 0.1], "elasticNetParam": [0.0]}
    a = tune(SPECS["logistic_regression"], feats.train, feats.n_features, feats.k, grid, parallelism=1)
    b = tune(SPECS["logistic_regression"], feats.train, feats.n_features, feats.k, grid, parallelism=4)
    assert a.avg == b.avg and a.std == b.std and a.best_params == b.best_params


def test_held_out_reads_are_one_folder(feats):
    plan = feats.train.filter("fold = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_no_exchange_of_texts(spark):
    f = prepare_features(separable(spark), "summary", k=3, dim=4, num_partitions=1, persist=False)
    assert "Exchange" not in f.train._jdf.queryExecution().executedPlan().toString()


def test_study_leaves_nothing_behind(spark):
    import os

    from reviewlens.plans.sentiment import run_study
    from reviewlens.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    left = lambda: {n for n in os.listdir(base) if n.startswith("features-")}
    before = left()
    run_study(separable(spark), ["summary"], ["logistic_regression"], SMALL, k=3, dim=4, num_partitions=1)
    assert left() == before


def test_learned_at_the_registered_partitions(spark):
    f = prepare_features(separable(spark, 400), "summary", k=3, dim=16)
    report = {r.metric: r.value for r in run_section(f, ["logistic_regression"], grids=SMALL, parallelism=2).report.collect()}
    assert report["areaUnderROC"] > 0.8
    f.close()
    assert f.paths == []


def test_rows_without_an_id_are_used(spark):
    df = separable(spark).withColumn("review_id", F.when(F.col("review_id") % 4 != 0, F.col("review_id")))
    f = prepare_features(df, "summary", k=3, dim=4, num_partitions=1)
    assert f.train.count() + f.test.count() == 160 and f.train.filter("review_id is null").count() == 0


def test_forest_tasks_hold_more_rows_than_the_blocks_of_sums(feats, monkeypatch):
    from reviewlens.operators import batched, tuning

    monkeypatch.setattr(batched, "TASK_BYTES", 1 << 12)
    used, make = [], tuning._Folds

    def folds(train, fold, fits, partitions):
        used.append(partitions)
        return make(train, fold, fits, partitions)

    monkeypatch.setattr(tuning, "_Folds", folds)
    found = tuning.tune(SPECS["random_forest"], feats.train, feats.n_features, feats.k, {"numTrees": [2], "maxDepth": [2]})
    assert used == [1] and len(found.avg) == 1


def test_features_and_forests_of_the_sets_follow_each_other(spark, monkeypatch):
    from threading import Lock
    from time import sleep

    from reviewlens.plans import catalog

    running, most, lock = {}, {}, Lock()

    def alone(kind):
        with lock:
            running[kind] = running.get(kind, 0) + 1
            most[kind] = max(most.get(kind, 0), running[kind])
        sleep(0.2)
        with lock:
            running[kind] -= 1
        return kind

    monkeypatch.setattr(catalog.SE, "prepare_features", lambda *_, **__: alone("features"))
    monkeypatch.setattr(catalog.SE, "run_section", lambda _, models, **__: alone(models[0]))
    monkeypatch.setattr(catalog, "_content", lambda *_: ("a test",))
    monkeypatch.setattr(catalog, "reviews_view", lambda *_: None)
    monkeypatch.setattr(catalog, "_FEATURES", {})
    monkeypatch.setattr(catalog, "_TUNED", {})
    found = catalog._sections(spark, "", catalog.SETS, ("random_forest",))
    assert found == ["random_forest"] * 3 and most == {"features": 1, "random_forest": 1}
