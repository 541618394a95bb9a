"""Deterministic train/test split and cross-validation folds.

Both come from an md5 bucket of the key and a seed, so a row's side and fold
depend on nothing else: not on partitioning, row order, file layout or
cluster size (``randomSplit`` depends on all of those).  No shuffle.  A row with
a null key is hashed by its content (``functions.hashing.row_key``), so it lands on
one side and in one fold like any other; the split and the folds agree on it when they
see the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.hashing import hash_bucket, row_key

DEFAULT_SEED = 123


def split_bucket(df: DataFrame, key: str = "review_id", seed: int = DEFAULT_SEED) -> Column:
    """Bucket 0..99 of the train/test split; never null."""
    return hash_bucket(row_key(df, key), seed, 100)


def with_split(
    df: DataFrame, key: str = "review_id", train_percent: int = 80, seed: int = DEFAULT_SEED, out: str = "split"
) -> DataFrame:
    """Add ``out`` = ``'train'`` for buckets below ``train_percent``, else ``'test'``."""
    return df.withColumn(
        out, F.when(split_bucket(df, key, seed) < train_percent, F.lit("train")).otherwise(F.lit("test"))
    )


def hash_split(
    df: DataFrame, key: str = "review_id", train_percent: int = 80, seed: int = DEFAULT_SEED
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: disjoint, together all rows of ``df``."""
    b = split_bucket(df, key, seed)
    return df.filter(b < train_percent), df.filter(b >= train_percent)


def with_folds(
    df: DataFrame, k: int, key: str = "review_id", seed: int = DEFAULT_SEED, out: str = "fold"
) -> DataFrame:
    """Add int ``out`` in ``[0, k)``; salted apart from the split bucket."""
    if k < 2:
        raise ValueError("need at least 2 folds")
    return df.withColumn(out, hash_bucket(row_key(df, key), f"{seed}:fold", k))


def class_counts(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Rows per (``by``, label); at most 2·groups rows."""
    keys = [by, label] if by else [label]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def check_classes(df: DataFrame, label: str, by: str | None = None, groups: int | None = None, what: str = "data") -> None:
    """Raise ``ValueError`` when ``df`` (or a group of it) lacks a class.

    One small aggregation; the result has at most ``2 * groups`` rows.
    """
    rows = class_counts(df, label, by).collect()
    if by is None:
        seen = {r[label] for r in rows}
        if len(seen) < 2:
            raise ValueError(f"{what} holds one class only: {sorted(seen)}")
        return
    per: dict = {}
    for r in rows:
        per.setdefault(r[by], set()).add(r[label])
    expected = range(groups) if groups is not None else per.keys()
    bad = sorted(g for g in expected if len(per.get(g, ())) < 2)
    if bad:
        raise ValueError(f"{what}: {by} {bad} hold(s) one class or no rows; use fewer folds or more data")
