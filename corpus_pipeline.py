"""The corpus pipeline: language, near-duplicates, repeated passages, token windows.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet in the shared folder and read again as the next stage's documents.  All but the
last return the columns that they got.  ``n_chars``, where there is such a column, follows
the text.

Edge cases are those of the operators: documents without a letter are rejected by the
first stage; of documents equal in id and text one stays; a document of which nothing but
repeated passages remains goes; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import lang_id, minhash, packing, passages
from reviewlens.llm.common import small_batches, unused
from reviewlens.session import materialize

#: Documents whose language is less certain than this, or hardly above chance among many languages, are rejected.
MIN_LANGUAGE_SCORE = 0.3
ABOVE_CHANCE = 1.2


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language that the network tells; it is learnt from these documents.

    Where no document says its language, nothing can be told, and documents with a letter stay.
    """
    small_batches(spark)
    model = lang_id.learn(docs)
    if model is None:
        return docs.filter(F.regexp_like("text", F.lit(r"\p{L}")))
    (found,) = unused(docs, "__found")
    told = docs.withColumn(found, lang_id.identify("text", model))
    least = min(MIN_LANGUAGE_SCORE, ABOVE_CHANCE / len(model.langs))
    known = (F.col(f"{found}.lang_pred") != lang_id.UNDETERMINED) & (F.col(f"{found}.score") >= least)
    return told.filter(known).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    small_batches(spark)
    return minhash.deduplicate(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere."""
    small_batches(spark)
    cut = passages.without_passages(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in cut.columns else cut


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows: one row a piece of a document, with its ids."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_duplicates),
    ("passage_dedup", cut_repeated_passages),
    ("packing", pack_windows),
]

#: A recurrent network, locality-sensitive hashes and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
