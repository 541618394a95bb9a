"""A tuning run that was stopped goes on: finished fits are read, only the others are fitted."""

import os

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import batched, tuning
from reviewlens.operators.journal import Journal, rows_digest, training_digest
from reviewlens.operators.models import SPECS
from reviewlens.plans import sentiment as SE
from reviewlens.sources.fixtures import reviews_view

from conftest import SF_MID

GRIDS = {
    "logistic_regression": {"regParam": [0.01, 0.3]},
    "perceptron": {"maxIter": [5], "blockSize": [128]},
    "random_forest": {"numTrees": [3, 5], "maxDepth": [2]},
}
K = 3


class Stop(Exception):
    pass


@pytest.fixture()
def fits(monkeypatch):
    """Batched fits and forest fits that are made; ``stop_after`` forests are journalled."""
    made = {"batched": [], "forests": 0, "embedded": 0, "stop_after": None}
    fit_grid, put, fit_features = batched.fit_grid, Journal.put, SE.fit_features

    def counted_grid(name, *args):
        made["batched"].append(name)
        return fit_grid(name, *args)

    def counted_put(self, rows):
        if rows[0][0] == "random_forest":
            if made["forests"] == made["stop_after"]:
                raise Stop
            made["forests"] += 1
        put(self, rows)

    def counted_features(*args):
        made["embedded"] += 1
        return fit_features(*args)

    monkeypatch.setattr(batched, "fit_grid", counted_grid)
    monkeypatch.setattr(Journal, "put", counted_put)
    monkeypatch.setattr(SE, "fit_features", counted_features)
    return made


def grid_rows(df):
    return sorted((r.model, r.params, r.avg, r.std) for r in df.collect())


def test_a_stopped_study_goes_on(spark, tmp_dir, fits):
    reviews, journal = reviews_view(spark, SF_MID), os.path.join(tmp_dir, "journal")
    study = lambda rows: SE.run_study(rows, ["summary"], list(GRIDS), GRIDS, K, dim=8, journal=journal)
    fits["stop_after"] = 4
    with pytest.raises(Stop):
        study(reviews)
    assert fits["batched"] == ["logistic_regression", "perceptron"] and fits["forests"] == 4 and fits["embedded"] == 1

    fits["stop_after"] = None
    resumed = study(reviews.repartition(5))  # the same rows in another order
    assert fits["batched"] == ["logistic_regression", "perceptron"] and fits["embedded"] == 1
    assert fits["forests"] == 6  # 3 folds, 2 points: the last two
    feats = resumed.sections[0].features
    plain = SE.run_section(feats, list(GRIDS), GRIDS)
    for found, want in ((resumed.grid_metrics, plain.grid_metrics), (resumed.report, plain.report)):
        found, want = (sorted(map(tuple, df.collect())) for df in (found, want))
        assert len(found) == len(want) > 0
        for a, b in zip(found, want):
            texts, numbers = ([[v for v in r if isinstance(v, kind)] for r in (a, b)] for kind in (str, float))
            assert texts[0] == texts[1] and numbers[0] == pytest.approx(numbers[1], abs=1e-9)

    again = study(reviews)
    assert fits["forests"] == 6 and grid_rows(again.grid_metrics) == grid_rows(resumed.grid_metrics)

    before = len(fits["batched"])
    changed = reviews.withColumn("rating", F.when(F.col("review_id") % 10 == 0, 9.0).otherwise(F.col("rating")))
    study(changed)  # other labels: nothing old is served
    assert len(fits["batched"]) == before + 2 and fits["forests"] == 12 and fits["embedded"] == 2


def test_digest_tells_rows_and_settings_apart(spark):
    rows = spark.createDataFrame([(1, 0.5), (2, None), (2, None)], "a int, b double")
    same = rows_digest(rows, 10, 1)
    assert same == rows_digest(rows.repartition(4, "a"), 10, 1)
    others = [rows_digest(rows, 10, 2), rows_digest(rows.distinct(), 10, 1), rows_digest(rows.fillna(0.0), 10, 1)]
    assert len({same, *others}) == 4
    empty = rows.limit(0)
    assert rows_digest(empty) == rows_digest(empty)


def test_entries_of_another_run_are_not_served(spark, tmp_dir):
    mine, other = (Journal(spark, tmp_dir, d) for d in ("a", "b"))
    mine.put([("random_forest", "areaUnderROC", 0, "p", 0.5, None)])
    other.put([("perceptron", "accuracy", -1, "p", None, [0.1, 0.2])])
    found = Journal(spark, tmp_dir, "a")
    assert found.get("random_forest", "areaUnderROC", 0, "p") == (0.5, None)
    assert found.get("perceptron", "accuracy", -1, "p") is None
    assert Journal(spark, tmp_dir, "b").get("perceptron", "accuracy", -1, "p") == (None, [0.1, 0.2])
