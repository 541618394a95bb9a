"""Journal of a tuning run, so that a lost driver goes on where it stopped.

A folder of the shared store holds one row a cross-validated fit: what it was fitted on, which fit, and its
value.  What it was fitted on is a digest of the training rows (count, and two sums of hashes of
fold, label and features, independent of order and partitioning) and of the seed, so values of other rows,
folds or settings are never served.  Rows are appended when a unit of work ends: a forest's fit, or all
folds and points of a model that is fitted for all together.  Models without a refit keep the weights on all
rows beside their values (fold -1).

The table has (folds × points) rows a model; what the driver reads of it is bounded by that.  An append is a
job of its own with Spark's commit, so a killed one leaves no half rows.  One run writes to a folder at a time.
"""

from __future__ import annotations

from threading import Lock

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.session import path_exists

SCHEMA = "digest string, model string, metric string, fold int, point string, value double, weights array<double>"
#: The fold of rows about a fit on all rows.
ALL_ROWS = -1


def rows_digest(rows: DataFrame, *settings: object) -> str:
    """Digest of ``rows``, whatever their order, and of ``settings``."""
    total = lambda *salt: F.sum(F.xxhash64(*rows.columns, *map(F.lit, salt)).cast("decimal(38,0)"))
    count, a, b = rows.agg(F.count(F.lit(1)), total(), total("other")).first()
    return "-".join(map(str, (count, a, b, *settings)))


def training_digest(train: DataFrame, features: str, label: str, fold: str, *settings: object) -> str:
    vector = vector_to_array(F.col(features)).alias("features")
    return rows_digest(train.select(F.col(fold).alias("fold"), F.col(label).cast("double").alias("label"), vector), *settings)


class Journal:
    """The fits of one training table in the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str, digest: str):
        self.spark, self.path, self.digest, self.lock = spark, path.rstrip("/") + "/fits", digest, Lock()
        self.known: dict[tuple[str, str, int, str], tuple[float | None, list[float] | None]] = {}
        if path_exists(spark, self.path):
            for r in spark.read.schema(SCHEMA).parquet(self.path).filter(F.col("digest") == digest).collect():
                self.known[r["model"], r["metric"], r["fold"], r["point"]] = r["value"], r["weights"]

    def get(self, model: str, metric: str, fold: int, point: str) -> tuple[float | None, list[float] | None] | None:
        return self.known.get((model, metric, fold, point))

    def put(self, rows: list[tuple[str, str, int, str, float | None, list[float] | None]]) -> None:
        """Append (model, metric, fold, point, value, weights) rows; known ones afterwards."""
        with self.lock:
            table = self.spark.createDataFrame([(self.digest, *r) for r in rows], SCHEMA)
            table.coalesce(1).write.mode("append").parquet(self.path)
            for *key, value, weights in rows:
                self.known[tuple(key)] = value, weights
