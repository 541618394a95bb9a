"""Sentiment from review text, end to end.

For one feature set (one or more text columns):

1. keep rows with the texts and a rating, label them (rating > 5);
2. split by key hash (80/20), the same split for every feature set;
3. fit tokens -> stop words -> Word2Vec on the training side only;
4. embed all rows in one pass, add hash folds to the training side, and write the narrow
   feature rows, partitioned by side and fold, to the shared checkpoint folder (they
   feed every fit);
5. cross-validate each model over its grid, refit the best point;
6. score every best model on the same test rows with AUC, accuracy and F1.

``Features.close`` removes the written rows; ``run_study`` closes each section.  With a ``journal`` folder
features and fits are kept there, and a stopped study goes on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.operators.compare import report_rows
from reviewlens.operators.journal import rows_digest
from reviewlens.operators.models import DEFAULT_MODEL_SEED, SPECS, Grid
from reviewlens.operators.prepare import label_sentiment, require
from reviewlens.operators.split import DEFAULT_SEED, check_classes, with_folds, with_split
from reviewlens.operators.text import (
    DEFAULT_DIM,
    DEFAULT_MAX_ITER,
    DEFAULT_MIN_COUNT,
    DEFAULT_NUM_PARTITIONS,
    DEFAULT_W2V_SEED,
    embed,
    fit_features,
)
from reviewlens.operators.tuning import TuneResult, tune_models
from reviewlens.operators.word_vectors import embed_by_words, train_word_vectors
from reviewlens.schema import MODEL_REPORT
from reviewlens.session import path_exists, release, remove_path, shared_path, written

FEATURE_SETS: dict[str, tuple[str, ...]] = {
    "summary": ("review_summary",),
    "detail": ("review_detail",),
    "both": ("review_summary", "review_detail"),
}

KEY = "review_id"
LABEL = "sentiment"


@dataclass
class Features:
    feature_set: str
    text_cols: tuple[str, ...]
    model: PipelineModel | None  # none of repeatable vectors
    train: DataFrame  # review_id, sentiment, fold, features
    test: DataFrame  # review_id, sentiment, features
    n_features: int
    k: int
    paths: list[str] = field(default_factory=list)  # written rows

    def close(self) -> None:
        """Remove the written rows; ``train`` and ``test`` cannot be read afterwards."""
        for path in self.paths:
            remove_path(self.train.sparkSession, path)
        self.paths.clear()


def labelled_rows(reviews: DataFrame, text_cols: Sequence[str], threshold: float = 5) -> DataFrame:
    """Key, label and texts; a row without a key gets the hash of its texts and rating."""
    rows = require(reviews, [*text_cols, "rating"])
    rows = rows.withColumn(KEY, F.coalesce(F.col(KEY), F.xxhash64(*text_cols, "rating")))
    return label_sentiment(rows, threshold=threshold).select(KEY, LABEL, *text_cols)


def _sides(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of a written feature table."""
    train = table.filter(F.col("part") >= 0).withColumnRenamed("part", "fold")
    return train, table.filter(F.col("part") == -1).drop("part")


def prepare_features(
    reviews: DataFrame,
    feature_set: str = "summary",
    text_cols: Sequence[str] | None = None,
    k: int = 10,
    seed: int = DEFAULT_SEED,
    train_percent: int = 80,
    dim: int = DEFAULT_DIM,
    min_count: int = DEFAULT_MIN_COUNT,
    w2v_seed: int = DEFAULT_W2V_SEED,
    num_partitions: int = DEFAULT_NUM_PARTITIONS,
    max_iter: int = DEFAULT_MAX_ITER,
    vocab_budget_bytes: int | None = None,
    persist: bool = True,
    folder: str | None = None,
    repeatable: bool = False,
) -> Features:
    """Split, fit the text features on the training side, embed both sides.

    With ``persist`` the feature rows are written once, laid out by side and fold and
    sorted by key and label, so that the forests' bootstrap samples do not depend on
    where the texts were read.  Adaptive execution sizes the layout and splits a
    partition that many copies (one key) would otherwise make hot.

    With ``folder`` (in the shared store) rows and feature model are kept there, by a digest of the labelled
    texts and the settings: a run started again reads what an earlier one finished, as Word2Vec
    does not repeat exactly.  ``Features.close`` leaves them.

    ``repeatable`` takes the word vectors of ``operators.word_vectors``, which are equal in every run, with ``max_iter``
    passes (0: hashed words, untrained); ``num_partitions`` and ``vocab_budget_bytes`` do not matter then.
    """
    cols = tuple(text_cols) if text_cols is not None else FEATURE_SETS[feature_set]
    rows = with_split(labelled_rows(reviews, cols), KEY, train_percent, seed)
    if folder:
        settings = (feature_set, *cols, k, seed, train_percent, dim, min_count, w2v_seed, num_partitions, max_iter)
        settings += ("repeatable",) if repeatable else ()
        name = hashlib.sha256(rows_digest(rows, *settings).encode()).hexdigest()[:32]
        folder = f"{folder.rstrip('/')}/features-{feature_set}-{name}"
        # the model is saved last, and its stages after its metadata: the mark is what tells that both are whole
        if path_exists(reviews.sparkSession, f"{folder}/done/_SUCCESS"):
            schema = T.StructType().add(KEY, rows.schema[KEY].dataType).add(LABEL, rows.schema[LABEL].dataType)
            schema = schema.add("features", VectorUDT()).add("part", T.IntegerType())
            table = reviews.sparkSession.read.schema(schema).parquet(f"{folder}/rows")
            train, test = _sides(table)
            model = None if repeatable else PipelineModel.load(f"{folder}/model")
            return Features(feature_set, cols, model, train, test, dim * len(cols), k)
        remove_path(reviews.sparkSession, folder)
    model, paths = None, []
    if repeatable:  # several steps read the texts: labels are joined to them once
        paths = [shared_path(reviews.sparkSession, f"labelled-{feature_set}")]
        rows = written(rows, paths[0])
    train_rows = rows.filter(F.col("split") == "train")
    if repeatable:
        words = {c: train_word_vectors(train_rows, c, dim, min_count, w2v_seed, max_iter) for c in cols}
        paths += [path for _, path in words.values()]
        embedded = embed_by_words(rows, {c: table for c, (table, _) in words.items()}, dim, [KEY, LABEL, "split"])
    else:
        model = fit_features(train_rows, cols, dim, min_count, w2v_seed, num_partitions, max_iter, vocab_budget_bytes)
        embedded = embed(model, rows, [KEY, LABEL, "split"])
    table = with_folds(embedded, k, KEY, seed)
    if persist or folder:
        table = table.withColumn("part", F.when(F.col("split") == "train", F.col("fold")).otherwise(-1))
        table = table.hint("rebalance", "part").sortWithinPartitions("part", KEY, LABEL)
        path = f"{folder}/rows" if folder else shared_path(reviews.sparkSession, f"features-{feature_set}")
        table = written(table.drop("fold", "split"), path, "part")
        for done in paths:
            remove_path(reviews.sparkSession, done)
        release(reviews.sparkSession)
        paths = []
        if folder:
            if model is not None:
                model.write().overwrite().save(f"{folder}/model")
            reviews.sparkSession.range(0).write.parquet(f"{folder}/done")
        else:
            paths = [path]
        train, test = _sides(table)
    else:
        train = table.filter(F.col("split") == "train").drop("split")
        test = table.filter(F.col("split") == "test").drop("split", "fold")
    return Features(feature_set, cols, model, train, test, dim * len(cols), k, paths)


def embedded_rows(features: Features) -> DataFrame:
    """All labelled rows with their side of the split and the vector as an array."""
    tr = features.train.select(KEY, LABEL, F.lit("train").alias("split"), "features")
    te = features.test.select(KEY, LABEL, F.lit("test").alias("split"), "features")
    return tr.unionByName(te).withColumn("features", vector_to_array("features"))


@dataclass
class SectionResult:
    features: Features
    tuned: list[TuneResult]
    grid_metrics: DataFrame
    report: DataFrame


def run_section(
    features: Features,
    models: Sequence[str] = tuple(SPECS),
    grids: Mapping[str, Grid] | None = None,
    parallelism: int = 1,
    model_seed: int = DEFAULT_MODEL_SEED,
    journal: str | None = None,
) -> SectionResult:
    """Tune each model on the training folds, then score all on the test side.

    One pool of ``parallelism`` threads runs the fits of all models, fold by fold.  ``journal``: see ``tune_models``.
    """
    check_classes(features.train, LABEL, by="fold", groups=features.k, what="training folds")
    check_classes(features.test, LABEL, what="test side")
    spark = features.train.sparkSession
    tuned = tune_models(
        [SPECS[name] for name in models],
        features.train,
        features.n_features,
        features.k,
        grids=grids,
        feature_set=features.feature_set,
        seed=model_seed,
        parallelism=parallelism,
        check=False,
        journal=journal,
    )
    rows = report_rows(features.feature_set, tuned, features.test)
    grid_metrics = tuned[0].grid_metrics
    for t in tuned[1:]:
        grid_metrics = grid_metrics.unionByName(t.grid_metrics)
    return SectionResult(features, tuned, grid_metrics, spark.createDataFrame(rows, MODEL_REPORT))


@dataclass
class StudyResult:
    sections: list[SectionResult]
    grid_metrics: DataFrame  # every section, model and grid point
    report: DataFrame  # every section, model and metric on the held-out rows


def run_study(
    reviews: DataFrame,
    feature_sets: Sequence[str] = tuple(FEATURE_SETS),
    models: Sequence[str] = tuple(SPECS),
    grids: Mapping[str, Grid] | None = None,
    k: int = 10,
    parallelism: int = 1,
    journal: str | None = None,
    **feature_kwargs,
) -> StudyResult:
    """The whole sentiment study: each feature set, each model, same split and metrics.

    ``journal``: a folder of the shared store for features and finished fits.  A study that was stopped and is
    started again on the same reviews goes on from there; the caller removes the folder.
    """
    sections = []
    for fs in feature_sets:
        feats = prepare_features(reviews, fs, k=k, folder=journal, **feature_kwargs)
        try:
            sections.append(run_section(feats, models, grids, parallelism, journal=journal))
        finally:
            feats.close()
    grid_metrics = sections[0].grid_metrics
    report = sections[0].report
    for sec in sections[1:]:
        grid_metrics = grid_metrics.unionByName(sec.grid_metrics)
        report = report.unionByName(sec.report)
    return StudyResult(sections, grid_metrics, report)


def compare_feature_sets(
    reviews: DataFrame,
    feature_sets: Sequence[str] = tuple(FEATURE_SETS),
    models: Sequence[str] = tuple(SPECS),
    grids: Mapping[str, Grid] | None = None,
    k: int = 10,
    parallelism: int = 1,
    **feature_kwargs,
) -> DataFrame:
    """The model report for each feature set, same split and metrics for all."""
    return run_study(reviews, feature_sets, models, grids, k, parallelism, **feature_kwargs).report
