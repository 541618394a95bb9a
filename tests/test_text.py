"""Tokens, stop words, vocabulary, Word2Vec document vectors."""

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from reviewlens.functions.stopwords import ENGLISH_STOP_WORDS
from reviewlens.operators import text as TX


def test_stop_words_equal_spark_default(spark):
    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


EDGE_TEXTS = ["Hello  World", " lead", "trail  ", "", "   ", "tab\tand\nnew line", "MiXeD Case I'll"]


def test_token_table_edges(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGE_TEXTS)], "review_id long, t string")
    got = {}
    for r in TX.token_table(df, "t").collect():
        got.setdefault(r.review_id, []).append((r.pos, r.token))
    toks = {k: [t for _, t in sorted(v)] for k, v in got.items()}
    assert toks[0] == ["hello", "", "world"]
    assert toks[1] == ["", "lead"]
    assert toks[2] == ["trail"]
    assert toks[3] == [""]
    assert 4 not in toks  # whitespace only: no tokens
    assert toks[5] == ["tab", "and", "new", "line"]
    content = {}
    for r in TX.token_table(df, "t", stop_words=True).collect():
        content.setdefault(r.review_id, []).append(r.token)
    assert content[6] == ["mixed", "case"]


def test_vocabulary_matches_word2vec(spark):
    words = ["alpha", "beta", "gamma", "delta"]
    rows = [(i, " ".join(words[: 1 + i % 4] + ["the", "rare%d" % i])) for i in range(40)]
    df = spark.createDataFrame(rows, "review_id long, t string")
    vocab = {r.token: r.n for r in TX.vocabulary(df, "t", min_count=5).collect()}
    assert vocab == {"alpha": 40, "beta": 30, "gamma": 20, "delta": 10}
    model = TX.fit_features(df, ["t"], dim=8, min_count=5, num_partitions=1)
    w2v_words = {r.word for r in model.stages[-1].getVectors().collect()}
    assert w2v_words == set(vocab)


def test_document_vector_is_sum_over_all_tokens(spark):
    rows = [(i, "alpha beta gamma unknownword%d" % i) for i in range(30)] + [(99, "the a"), (100, "")]
    df = spark.createDataFrame(rows, "review_id long, t string")
    model = TX.fit_features(df, ["t"], dim=6, min_count=5, num_partitions=1)
    vecs = {r.word: list(r.vector) for r in model.stages[-1].getVectors().collect()}
    emb = {r.review_id: list(r.features) for r in TX.embed(model, df, ["review_id"]).collect()}
    expect = [sum(vecs[w][j] for w in ("alpha", "beta", "gamma")) / 4 for j in range(6)]
    assert emb[0] == pytest.approx(expect, abs=1e-6)
    assert emb[99] == [0.0] * 6  # only stop words: empty token list
    # explode-join-average form over the whole table
    toks = TX.token_table(df, "t", stop_words=True)
    sizes = toks.groupBy("review_id").agg(F.count(F.lit(1)).alias("n"))
    vec_df = model.stages[-1].getVectors().withColumnRenamed("word", "token")
    from pyspark.ml.functions import vector_to_array

    joined = toks.join(vec_df, "token").select("review_id", F.posexplode(vector_to_array("vector")).alias("j", "v"))
    sums = joined.groupBy("review_id", "j").agg(F.sum("v").alias("s")).join(sizes, "review_id")
    for r in sums.collect():
        assert emb[r.review_id][r.j] == pytest.approx(r.s / r.n, abs=1e-6)


def test_assembled_width_and_determinism(spark):
    rows = [(i, "alpha beta gamma", "delta epsilon zeta eta") for i in range(20)]
    df = spark.createDataFrame(rows, "review_id long, a string, b string")
    m1 = TX.fit_features(df, ["a", "b"], dim=5, min_count=5, num_partitions=1)
    m2 = TX.fit_features(df, ["a", "b"], dim=5, min_count=5, num_partitions=1)
    e1 = {r.review_id: list(r.features) for r in TX.embed(m1, df, ["review_id"]).collect()}
    e2 = {r.review_id: list(r.features) for r in TX.embed(m2, df, ["review_id"]).collect()}
    assert len(e1[0]) == 10
    assert e1 == e2


def test_vocabulary_budget_guard(spark):
    df = spark.createDataFrame([(i, "alpha beta") for i in range(10)], "review_id long, t string")
    with pytest.raises(ValueError, match="budget"):
        TX.fit_features(df, ["t"], dim=100, min_count=5, vocab_budget_bytes=100, num_partitions=1)


def test_missing_text_column(spark):
    from reviewlens.operators.prepare import require

    df = spark.createDataFrame([(1, "x")], "review_id long, t string")
    with pytest.raises(ValueError):
        require(df, ["review_summary"])


def test_training_settings_are_fixed_arguments(spark):
    import inspect

    have = inspect.signature(TX.fit_features).parameters
    assert have["num_partitions"].default == 8 and have["max_iter"].default == 1
    assert have["vocab_budget_bytes"].default is None
    stage = TX.feature_pipeline(["t"], num_partitions=3, max_iter=2).getStages()[-1]
    assert (stage.getNumPartitions(), stage.getMaxIter()) == (3, 2)


def test_vocabulary_sizes_one_pass(spark):
    rows = [(i, "alpha beta the", "gamma " * (i % 2) + "delta") for i in range(12)]
    df = spark.createDataFrame(rows, "review_id long, a string, b string")
    sizes = TX.vocabulary_sizes(df, ["a", "b"], min_count=5)
    assert sizes == {"a": 2, "b": 2}
    assert sizes["a"] == TX.vocabulary(df, "a", 5).count()
    assert TX.vocabulary_sizes(df, ["a"], min_count=50) == {"a": 0}
