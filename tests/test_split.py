"""Hash split and folds: disjoint, complete, independent of partitioning."""

import pytest
from pyspark.sql import functions as F

from reviewlens.operators.split import check_classes, hash_split, with_folds, with_split


def ids(df):
    return sorted(r.review_id for r in df.select("review_id").collect())


def test_split_disjoint_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "review_id")
    train, test = hash_split(df)
    a, b = ids(train), ids(test)
    assert not set(a) & set(b)
    assert sorted(a + b) == list(range(2000))
    assert 0.75 < len(a) / 2000 < 0.85


def test_split_independent_of_partitioning(spark):
    df = spark.range(1000).withColumnRenamed("id", "review_id")
    t1, _ = hash_split(df)
    t2, _ = hash_split(df.repartition(7).orderBy(F.rand(3)))
    assert ids(t1) == ids(t2)
    s = with_split(df).groupBy("split").count().collect()
    assert {r.split for r in s} == {"train", "test"}


def test_folds_range_and_stability(spark):
    df = spark.range(1000).withColumnRenamed("id", "review_id")
    f1 = {r.review_id: r.fold for r in with_folds(df, 10).collect()}
    f2 = {r.review_id: r.fold for r in with_folds(df.repartition(5), 10).collect()}
    assert f1 == f2
    assert set(f1.values()) == set(range(10))


def test_folds_not_aligned_with_split(spark):
    df = spark.range(4000).withColumnRenamed("id", "review_id")
    train, _ = hash_split(df)
    counts = [r["count"] for r in with_folds(train, 10).groupBy("fold").count().collect()]
    assert len(counts) == 10 and min(counts) > 200


def test_check_classes(spark):
    df = spark.createDataFrame([(i, i % 2, i % 3) for i in range(30)], "review_id long, y int, fold int")
    check_classes(df, "y")
    check_classes(df, "y", by="fold", groups=3)
    with pytest.raises(ValueError):
        check_classes(df.filter("y = 1"), "y")
    with pytest.raises(ValueError):
        check_classes(df, "y", by="fold", groups=4)
    with pytest.raises(ValueError):
        with_folds(df, 1)


def test_no_row_is_lost_without_a_key(spark):
    rows = [(None if i % 3 == 0 else i, f"text {i % 40}") for i in range(600)]
    df = spark.createDataFrame(rows, "review_id long, t string")
    train, test = hash_split(df)
    assert train.count() + test.count() == 600
    sides = with_split(df)
    assert sides.filter("split = 'train'").count() == train.count()
    assert sides.filter("review_id is null").select("split").distinct().count() == 2
    folds = with_folds(df, 5)
    assert folds.filter("fold is null").count() == 0
    per_text = folds.filter("review_id is null").groupBy("t").agg(F.countDistinct("fold").alias("n"))
    assert per_text.filter("n > 1").count() == 0  # equal rows share a fold
