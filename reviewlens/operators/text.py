"""Text to vectors: tokens, stop words, vocabulary, Word2Vec document vectors.

The feature pipeline is Spark ML stages only (``Tokenizer``,
``StopWordsRemover``, ``Word2Vec``, ``VectorAssembler``), all JVM-side.  The
token tables explode the same stages' output to one row per token, which is
what the vocabulary step counts.

Scale notes: Word2Vec keeps the vocabulary (words seen ``min_count`` times)
times the vector size on the driver and in every training task, and
``transform`` broadcasts it.  ``fit_features`` can count the vocabulary first, with a
distributed aggregation, and refuse to train when it would exceed
``vocab_budget_bytes`` (an argument without a default: only the caller knows the
driver).  Training runs in ``num_partitions`` tasks and ``max_iter`` passes, fixed defaults
that depend on neither cluster nor data: raise them for a large corpus.  With more
than one partition Spark's Word2Vec does not repeat exactly, as its training tasks update
shared arrays.  Long documents are cut into windows of ``max_sentence_length`` words by
Word2Vec itself; every word is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StopWordsRemover, Tokenizer, VectorAssembler, Word2Vec
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_DIM = 100
DEFAULT_MIN_COUNT = 5
DEFAULT_W2V_SEED = 42
DEFAULT_NUM_PARTITIONS = 8
DEFAULT_MAX_ITER = 1


def words_col(text_col: str) -> str:
    return f"{text_col}__words"


def content_col(text_col: str) -> str:
    return f"{text_col}__content"


def vector_col(text_col: str) -> str:
    return f"{text_col}__vec"


def text_stages(text_col: str) -> list:
    """Tokenizer (lower case, split on each whitespace char) then stop words."""
    return [
        Tokenizer(inputCol=text_col, outputCol=words_col(text_col)),
        StopWordsRemover(inputCol=words_col(text_col), outputCol=content_col(text_col)),
    ]


def tokenize(df: DataFrame, text_col: str, stop_words: bool = False) -> DataFrame:
    """Add the token array (and, with ``stop_words``, the content-token array)."""
    stages = text_stages(text_col)
    out = stages[0].transform(df)
    return stages[1].transform(out) if stop_words else out


def token_table(df: DataFrame, text_col: str, key: str = "review_id", stop_words: bool = False) -> DataFrame:
    """One row per token: ``(key, pos, token)``; ``pos`` counts from 0.

    ``posexplode_outer`` + a null filter instead of ``posexplode``: for the
    latter Catalyst infers ``size(tokens) > 0`` and pushes it below joins,
    which runs the tokenizer twice per document.  Tokens are never null, so
    the filter drops exactly the placeholder row of an empty array.
    """
    toks = tokenize(df.select(key, text_col), text_col, stop_words)
    arr = content_col(text_col) if stop_words else words_col(text_col)
    return toks.select(key, F.posexplode_outer(arr).alias("pos", "token")).filter(F.col("token").isNotNull())


def vocabulary(df: DataFrame, text_col: str, min_count: int = DEFAULT_MIN_COUNT) -> DataFrame:
    """Content tokens seen at least ``min_count`` times: ``(token, n)``.

    Same words as a Word2Vec vocabulary on the same rows.  Partial
    aggregation per task keeps a very common token from becoming a hot key.
    """
    toks = tokenize(df.select(text_col), text_col, stop_words=True)
    return (
        toks.select(F.explode_outer(content_col(text_col)).alias("token"))
        .filter(F.col("token").isNotNull())  # see token_table
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_count)
    )


def feature_pipeline(
    text_cols: Sequence[str],
    dim: int = DEFAULT_DIM,
    min_count: int = DEFAULT_MIN_COUNT,
    seed: int = DEFAULT_W2V_SEED,
    num_partitions: int = DEFAULT_NUM_PARTITIONS,
    max_iter: int = DEFAULT_MAX_ITER,
    max_sentence_length: int = 1000,
    out: str = "features",
) -> Pipeline:
    """3 stages per text column, plus a ``VectorAssembler`` for several columns."""
    if not text_cols:
        raise ValueError("need at least one text column")
    stages: list = []
    single = len(text_cols) == 1
    for c in text_cols:
        stages += text_stages(c)
        stages.append(
            Word2Vec(
                vectorSize=dim,
                minCount=min_count,
                seed=seed,
                numPartitions=num_partitions,
                maxIter=max_iter,
                maxSentenceLength=max_sentence_length,
                inputCol=content_col(c),
                outputCol=out if single else vector_col(c),
            )
        )
    if not single:
        stages.append(VectorAssembler(inputCols=[vector_col(c) for c in text_cols], outputCol=out))
    return Pipeline(stages=stages)


def vocabulary_sizes(df: DataFrame, text_cols: Sequence[str], min_count: int = DEFAULT_MIN_COUNT) -> dict[str, int]:
    """Vocabulary size of every text column, in one pass over the rows.

    Tokens are tagged with their column and counted by ``(column, token)``;
    at most one row per column reaches the driver.
    """
    toks = df.select(*text_cols)
    for c in text_cols:
        toks = tokenize(toks, c, stop_words=True)
    tagged = F.array(*[F.struct(F.lit(c).alias("col"), F.col(content_col(c)).alias("toks")) for c in text_cols])
    words = (
        toks.select(F.inline(tagged))
        .select("col", F.explode_outer("toks").alias("token"))
        .filter(F.col("token").isNotNull())
    )
    kept = (
        words.groupBy("col", "token")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_count)
        .groupBy("col")
        .agg(F.count(F.lit(1)).alias("v"))
    )
    found = {r["col"]: r["v"] for r in kept.collect()}
    return {c: found.get(c, 0) for c in text_cols}


def check_vocabulary(
    train: DataFrame, text_cols: Sequence[str], dim: int, min_count: int, budget_bytes: int
) -> dict[str, int]:
    """Vocabulary size per column; raise if the Word2Vec state would exceed the budget.

    Word2Vec trains two float matrices of vocabulary × dim.
    """
    sizes = vocabulary_sizes(train, text_cols, min_count)
    need = sum(sizes.values()) * dim * 4 * 2
    if need > budget_bytes:
        raise ValueError(
            f"Word2Vec vocabulary {sizes} needs ~{need} bytes on the driver, over the "
            f"budget of {budget_bytes}; raise min_count or the budget"
        )
    return sizes


def fit_features(
    train: DataFrame,
    text_cols: Sequence[str],
    dim: int = DEFAULT_DIM,
    min_count: int = DEFAULT_MIN_COUNT,
    seed: int = DEFAULT_W2V_SEED,
    num_partitions: int = DEFAULT_NUM_PARTITIONS,
    max_iter: int = DEFAULT_MAX_ITER,
    vocab_budget_bytes: int | None = None,
    out: str = "features",
) -> PipelineModel:
    """Fit the feature pipeline on training rows only (test text never shapes the vectors).

    ``vocab_budget_bytes``, if given, is what Word2Vec may hold on the driver; a larger
    vocabulary raises before training.
    """
    if vocab_budget_bytes is not None:
        check_vocabulary(train, text_cols, dim, min_count, vocab_budget_bytes)
    return feature_pipeline(text_cols, dim, min_count, seed, num_partitions, max_iter, out=out).fit(train)


def embed(model: PipelineModel, df: DataFrame, keep: Sequence[str], out: str = "features") -> DataFrame:
    """``keep`` columns plus the document vector ``out``.

    A document vector is the sum of its known word vectors divided by its
    number of content tokens (unknown words count in the divisor); a
    document without tokens gets the zero vector.  ``transform`` broadcasts the word
    vectors, as training did.
    """
    return model.transform(df).select(*keep, out)
