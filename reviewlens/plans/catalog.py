"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables of ``sf_dir`` whole (through the review
views in ``reviewlens.sources.fixtures``); its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.operators import metrics as M
from reviewlens.operators import split as S
from reviewlens.operators import text as TX
from reviewlens.operators import votes as V
from reviewlens.operators.models import SPECS
from reviewlens.operators.prepare import drop_columns, label_sentiment, require
from reviewlens.operators.tuning import tune
from reviewlens.plans import sentiment as SE
from reviewlens.plans.helpfulness import complete_reviews, helpfulness
from reviewlens.session import in_threads, shared_path
from reviewlens.sources.csv import read_reviews_csv, write_reviews_csv
from reviewlens.sources.fixtures import reviews_scale, reviews_view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


# --- A. sources -------------------------------------------------------------


@register("reviews_view")
def q_reviews_view(spark: SparkSession, sf: str) -> DataFrame:
    return reviews_view(spark, sf)


@register("csv_scan")
def q_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews written as CSV into the shared folder, then read back."""
    path = shared_path(spark, "csv_scan")
    write_reviews_csv(reviews_view(spark, sf), path)
    return read_reviews_csv(spark, path)


@register("csv_scan_split")
def q_csv_scan_split(spark: SparkSession, sf: str) -> DataFrame:
    """As ``csv_scan``, the files read in byte ranges."""
    path = shared_path(spark, "csv_scan_split")
    write_reviews_csv(reviews_view(spark, sf), path)
    return read_reviews_csv(spark, path, split=True)


# --- B. filters, label, drop ------------------------------------------------


@register("require_summary")
def q_require_summary(spark: SparkSession, sf: str) -> DataFrame:
    return require(reviews_view(spark, sf), ["review_summary", "rating"])


@register("require_detail")
def q_require_detail(spark: SparkSession, sf: str) -> DataFrame:
    return require(reviews_view(spark, sf), ["review_detail", "rating"])


@register("require_both")
def q_require_both(spark: SparkSession, sf: str) -> DataFrame:
    return complete_reviews(reviews_view(spark, sf))


@register("label_sentiment")
def q_label_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    rows = require(reviews_view(spark, sf), ["review_summary", "rating"])
    return label_sentiment(rows).select("review_id", "reviewer", "rating", "sentiment")


@register("drop_summary")
def q_drop_summary(spark: SparkSession, sf: str) -> DataFrame:
    return drop_columns(reviews_view(spark, sf), "review_summary")


# --- D/E/F. votes -----------------------------------------------------------


@register("parse_votes")
def q_parse_votes(spark: SparkSession, sf: str) -> DataFrame:
    rows = reviews_view(spark, sf).select("review_id", "reviewer", "helpful_str")
    return V.parse_votes(rows)


@register("parse_vote_fractions")
def q_parse_vote_fractions(spark: SparkSession, sf: str) -> DataFrame:
    """Votes written as bare and signed fractions."""
    rows = reviews_view(spark, sf).select("review_id")
    part = F.col("review_id") % 7
    sign = F.when(part < 2, "-.").when(part < 4, ".").otherwise("+")
    text = F.concat(sign, part.cast("string"), F.lit(", ."), (F.col("review_id") % 5).cast("string"))
    return V.parse_votes(rows.withColumn("helpful_str", text))


@register("vote_totals")
def q_vote_totals(spark: SparkSession, sf: str) -> DataFrame:
    return V.vote_totals(helpfulness(reviews_view(spark, sf)).parsed)


@register("net_votes")
def q_net_votes(spark: SparkSession, sf: str) -> DataFrame:
    return helpfulness(reviews_view(spark, sf)).net


@register("review_counts")
def q_review_counts(spark: SparkSession, sf: str) -> DataFrame:
    return helpfulness(reviews_view(spark, sf)).counts


@register("helpful_rate_join")
def q_helpful_rate_join(spark: SparkSession, sf: str) -> DataFrame:
    h = helpfulness(reviews_view(spark, sf))
    return V.helpful_rate_join(h.net, h.counts)


@register("helpful_rate_single_pass")
def q_helpful_rate_single_pass(spark: SparkSession, sf: str) -> DataFrame:
    return helpfulness(reviews_view(spark, sf)).rates


@register("top_net")
def q_top_net(spark: SparkSession, sf: str) -> DataFrame:
    return helpfulness(reviews_view(spark, sf)).top_net()


@register("bottom_net")
def q_bottom_net(spark: SparkSession, sf: str) -> DataFrame:
    return helpfulness(reviews_view(spark, sf)).bottom_net()


@register("top_rate")
def q_top_rate(spark: SparkSession, sf: str) -> DataFrame:
    return helpfulness(reviews_view(spark, sf)).top_rate()


@register("bottom_rate")
def q_bottom_rate(spark: SparkSession, sf: str) -> DataFrame:
    return helpfulness(reviews_view(spark, sf)).bottom_rate()


@register("bottom_rate_literal")
def q_bottom_rate_literal(spark: SparkSession, sf: str) -> DataFrame:
    """The rate table ordered by net votes ascending, as the original heading's sort did."""
    rates = helpfulness(reviews_view(spark, sf)).rates
    return V.rank_reviewers(rates, "net_helpful_votes", ascending=True)


@register("votes_scale")
def q_votes_scale(spark: SparkSession, sf: str) -> DataFrame:
    return helpfulness(reviews_scale(spark, sf), complete_only=False).rates


@register("votes_scale_top_rate")
def q_votes_scale_top_rate(spark: SparkSession, sf: str) -> DataFrame:
    return helpfulness(reviews_scale(spark, sf), complete_only=False).top_rate()


# --- G. split and folds -----------------------------------------------------


SUMMARY_ROWS = ["review_summary", "rating"]
DETAIL_ROWS = ["review_detail", "rating"]


def labelled(spark: SparkSession, sf: str, needed: list[str]) -> DataFrame:
    """Reviews with the needed columns present, labelled 0/1."""
    return label_sentiment(require(reviews_view(spark, sf), needed))


@register("hash_split")
def q_hash_split(spark: SparkSession, sf: str) -> DataFrame:
    return S.with_split(reviews_view(spark, sf)).select("review_id", "split")


@register("hash_split_null_keys")
def q_hash_split_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Sides and folds of rows every fifth of which has lost its key."""
    rows = reviews_view(spark, sf).select("review_id", "reviewer", "helpful_str", "review_detail")
    key = F.when(F.col("review_id") % 5 != 0, F.col("review_id"))
    rows = rows.select(key.alias("review_id"), "reviewer", "helpful_str", F.md5("review_detail").alias("digest"))
    train, test = S.hash_split(rows)
    return S.with_folds(S.with_split(train).unionByName(S.with_split(test)).drop("reviewer"), 10, out="fold").select(
        "review_id", "digest", "split", "fold"
    )


@register("hash_folds")
def q_hash_folds(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = S.hash_split(labelled(spark, sf, SUMMARY_ROWS))
    return S.with_folds(train, 10).select("review_id", "sentiment", "fold")


@register("split_class_counts")
def q_split_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per (side of the split, label): what the one-class checks read."""
    return S.class_counts(S.with_split(labelled(spark, sf, SUMMARY_ROWS)), "sentiment", by="split")


@register("fold_class_counts")
def q_fold_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = S.hash_split(labelled(spark, sf, SUMMARY_ROWS))
    return S.class_counts(S.with_folds(train, 10), "sentiment", by="fold")


# --- H. tokens, stop words, vocabulary --------------------------------------


@register("tokens_summary")
def q_tokens_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = require(reviews_view(spark, sf), SUMMARY_ROWS)
    return TX.token_table(rows, "review_summary")


@register("content_tokens_summary")
def q_content_tokens_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = require(reviews_view(spark, sf), SUMMARY_ROWS)
    return TX.token_table(rows, "review_summary", stop_words=True)


@register("tokens_detail")
def q_tokens_detail(spark: SparkSession, sf: str) -> DataFrame:
    rows = require(reviews_view(spark, sf), DETAIL_ROWS)
    return TX.token_table(rows, "review_detail")


@register("content_tokens_detail")
def q_content_tokens_detail(spark: SparkSession, sf: str) -> DataFrame:
    rows = require(reviews_view(spark, sf), DETAIL_ROWS)
    return TX.token_table(rows, "review_detail", stop_words=True)


@register("vocabulary_summary")
def q_vocabulary_summary(spark: SparkSession, sf: str) -> DataFrame:
    """What Word2Vec learns words for: content tokens of the training side, seen 5+ times."""
    train, _ = S.hash_split(labelled(spark, sf, SUMMARY_ROWS))
    return TX.vocabulary(train, "review_summary")


@register("vocabulary_detail")
def q_vocabulary_detail(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = S.hash_split(labelled(spark, sf, DETAIL_ROWS))
    return TX.vocabulary(train, "review_detail")


# --- J. metrics on a fixed arithmetic score ---------------------------------


def fixed_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled reviews scored by ``(review_id * 37 % 1000) / 1000``, predicted 1 above 0.5."""
    s = (F.col("review_id") * 37 % 1000) / 1000.0
    rows = label_sentiment(require(reviews_view(spark, sf), ["rating"]))
    return rows.select("review_id", "sentiment", s.alias("score")).withColumn(
        "prediction", (F.col("score") > 0.5).cast("int")
    )


@register("eval_confusion")
def q_eval_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return M.confusion(fixed_scores(spark, sf))


@register("eval_accuracy")
def q_eval_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return M.accuracy(M.confusion(fixed_scores(spark, sf)))


@register("eval_f1")
def q_eval_f1(spark: SparkSession, sf: str) -> DataFrame:
    return M.weighted_f1(M.confusion(fixed_scores(spark, sf)))


@register("eval_auc")
def q_eval_auc(spark: SparkSession, sf: str) -> DataFrame:
    return M.auc(fixed_scores(spark, sf), "sentiment", "score")


# --- H3-H7, I-L. embeddings, tuning, comparison -------------------------------

#: The study's folds, and the fits that run side by side.
FOLDS = 10
PARALLELISM = 8

SETS = tuple(SE.FEATURE_SETS)
#: Sections of this session by application, content of the reviews and feature set, and what was tuned in them.
_FEATURES: dict[tuple, SE.Features] = {}
_TUNED: dict[tuple, SE.SectionResult] = {}
#: Features are made one set after another: each set's work fills the cores, and what it shuffles is gone before the next one's.
_MAKING = Lock()
#: So are forests: PARALLELISM fits fill the cores, and each keeps its binned rows and node ids until it ends.
_FORESTS = Lock()


def _content(spark: SparkSession, sf: str) -> tuple:
    """What the reviews hold, in a number: changed files are other reviews."""
    rows = reviews_view(spark, sf)
    hashed = F.xxhash64(*rows.columns).cast("decimal(38,0)")
    return spark.sparkContext.applicationId, *rows.agg(F.count(F.lit(1)), F.sum(hashed)).first()


def _sections(spark: SparkSession, sf: str, sets: tuple[str, ...], models: tuple[str, ...]) -> list[SE.SectionResult]:
    """Each model tuned over its whole grid with all folds in each feature set, once a session.

    The sets are worked on side by side, as most fits are rounds of small jobs; their features and forests are not.
    """
    content = _content(spark, sf)

    def section(feature_set: str) -> list[SE.SectionResult]:
        feats = _features(spark, sf, feature_set, content)
        for model in models:
            key = (*content, feature_set, model)
            if key not in _TUNED:
                with _FORESTS if model == "random_forest" else nullcontext():
                    _TUNED[key] = SE.run_section(feats, [model], parallelism=PARALLELISM)
        return [_TUNED[*content, feature_set, model] for model in models]

    return [result for results in in_threads(spark, section, sets, len(sets)) for result in results]


def _features(spark: SparkSession, sf: str, feature_set: str, content: tuple | None = None) -> SE.Features:
    """A feature set's rows, made once a session: several queries tune on them.

    The word vectors are a table: Spark's Word2Vec would hold the vocabulary, which grows with the text, on the driver.
    """
    key = (*(content or _content(spark, sf)), feature_set)
    with _MAKING:
        if key not in _FEATURES:
            _FEATURES[key] = SE.prepare_features(reviews_view(spark, sf), feature_set, k=FOLDS, repeatable=True)
    return _FEATURES[key]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _embed_query(feature_set: str) -> Query:
    return lambda spark, sf: SE.embedded_rows(_features(spark, sf, feature_set))


def _embed_facts_query(feature_set: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        rows = SE.embedded_rows(_features(spark, sf, feature_set))
        zero = F.forall("features", lambda x: x == 0)
        return rows.select("review_id", "sentiment", "split", F.size("features").alias("dims"), zero.alias("is_zero"))

    return q


for _set in SETS:
    register(f"embed_{_set}")(_embed_query(_set))
    # what SQL can state of the vectors: their rows, length, and which are zero
    register(f"embed_facts_{_set}")(_embed_facts_query(_set))


def _repeatable(spark: SparkSession, sf: str, feature_set: str, passes: int) -> DataFrame:
    feats = SE.prepare_features(reviews_view(spark, sf), feature_set, k=FOLDS, max_iter=passes, repeatable=True)
    return SE.embedded_rows(feats)


@register("embed_repeatable_both")
def q_embed_repeatable_both(spark: SparkSession, sf: str) -> DataFrame:
    return _repeatable(spark, sf, "both", 1)


@register("embed_hashed_both")
def q_embed_hashed_both(spark: SparkSession, sf: str) -> DataFrame:
    """Random indexing: untrained vectors, a row a component."""
    rows = _repeatable(spark, sf, "both", 0)
    return rows.select("review_id", "sentiment", "split", F.posexplode("features").alias("component", "value"))


def _tune_query(model: str, sets: tuple[str, ...]) -> Query:
    return lambda spark, sf: _union([r.grid_metrics for r in _sections(spark, sf, sets, (model,))])


MODEL_NAMES = {"lr": "logistic_regression", "svc": "linear_svc", "rf": "random_forest", "mlp": "perceptron"}
for _short, _model in MODEL_NAMES.items():
    register(f"tune_{_short}")(_tune_query(_model, SETS))
    register(f"tune_{_short}_summary")(_tune_query(_model, ("summary",)))


def _closed_query(model: str, grid: dict[str, list]) -> Query:
    """Tuning whose result is known: a grid point that can learn nothing."""

    def q(spark: SparkSession, sf: str) -> DataFrame:
        feats = _features(spark, sf, "summary")
        rows = tune(SPECS[model], feats.train, feats.n_features, FOLDS, grid, parallelism=PARALLELISM).grid_metrics
        return rows.withColumns({c: F.round(c, 9) for c in ("avg", "std")})

    return q


register("tune_lr_closed")(_closed_query("logistic_regression", {"regParam": [10.0], "elasticNetParam": [1.0]}))
register("tune_rf_closed")(_closed_query("random_forest", {"numTrees": [10], "maxDepth": [0]}))


@register("compare_models")
def q_compare_models(spark: SparkSession, sf: str) -> DataFrame:
    return _union([r.report for r in _sections(spark, sf, ("summary",), tuple(SPECS))])


@register("compare_feature_sets")
def q_compare_feature_sets(spark: SparkSession, sf: str) -> DataFrame:
    return _union([r.report for r in _sections(spark, sf, SETS, tuple(SPECS))])


@register("compare_shape")
def q_compare_shape(spark: SparkSession, sf: str) -> DataFrame:
    """The comparison's rows and whether each value is a share: what SQL can state of it."""
    rows = q_compare_feature_sets(spark, sf)
    return rows.select("feature_set", "model", "metric", F.col("value").between(0, 1).alias("in_bounds"))
