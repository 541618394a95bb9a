"""Row filters and the sentiment label."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where every column in ``columns`` is non-null.

    Names resolve like Spark's own lookup (case-insensitive unless
    ``spark.sql.caseSensitive``), so ``Rating`` and ``rating`` both work.

    One conjunctive filter; on a Parquet source it becomes ``IsNotNull``
    pushed filters on the scan.
    """
    case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    have = set(df.columns) if case_sensitive else {c.lower() for c in df.columns}
    missing = [c for c in columns if (c if case_sensitive else c.lower()) not in have]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.filter(cond)


def label_sentiment(
    df: DataFrame,
    rating: str = "rating",
    threshold: float = 5,
    out: str = "sentiment",
) -> DataFrame:
    """``out`` = 1 when ``rating > threshold`` else 0 (int; the threshold itself is 0)."""
    return df.withColumn(out, F.when(F.col(rating) > threshold, 1).otherwise(0))


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns; Catalyst then prunes them from the scan."""
    return df.drop(*columns)
