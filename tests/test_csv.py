"""CSV source: quoted newlines and quotes, missing values, header matching, round trip."""

import os

from reviewlens.sources.csv import CORRUPT, corrupt_rows, land_parquet, read_reviews_csv, write_reviews_csv
from reviewlens.sources.fixtures import reviews_view

from conftest import SF_SMALL

CSV = 'reviewer,rating,review_summary,review_detail,helpful_str\nann,8,ok,"line one\nline ""two"", end","3,7"\nbob,,meh,short,"1,2"\n'


def test_hand_made_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "r.csv")
    with open(path, "w") as f:
        f.write(CSV)
    rows = {r.reviewer: r for r in read_reviews_csv(spark, path).collect()}
    assert set(rows) == {"ann", "bob"}
    assert rows["ann"].review_detail == 'line one\nline "two", end'
    assert rows["ann"].rating == 8.0
    assert rows["ann"].helpful_str == "3,7"
    assert rows["bob"].rating is None
    assert rows["ann"].review_id is not None and rows["ann"].review_id != rows["bob"].review_id


def test_header_case_and_bad_rating(spark, tmp_dir):
    path = os.path.join(tmp_dir, "r.csv")
    with open(path, "w") as f:
        f.write("Rating,Reviewer,review_id\nseven,x,5\n9,y,6\n")
    rows = sorted(tuple(r) for r in read_reviews_csv(spark, path).select("review_id", "reviewer", "rating").collect())
    assert rows == [(5, "x", None), (6, "y", 9.0)]


def test_round_trip_and_landing(spark, tmp_dir):
    src = reviews_view(spark, SF_SMALL)
    out = os.path.join(tmp_dir, "csv")
    write_reviews_csv(src, out)
    back = read_reviews_csv(spark, out)
    expected = src.withColumn("rating", src.rating.cast("double"))
    assert back.subtract(expected).count() == 0 and expected.subtract(back).count() == 0
    landed = land_parquet(back, os.path.join(tmp_dir, "pq"))
    assert landed.count() == src.count()


def test_single_line_mode_splits_large_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "big.csv")
    with open(path, "w") as f:
        f.write("review_id,reviewer,rating,review_summary,review_detail,helpful_str\n")
        for i in range(20000):
            f.write(f'{i},r{i % 50},{i % 10},"sum, {i}","detail text {i} with ""quotes""","{i % 7},{i % 3}"\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        single = read_reviews_csv(spark, path, multi_line=False)
        multi = read_reviews_csv(spark, path)
        assert single.rdd.getNumPartitions() > 1
        assert multi.rdd.getNumPartitions() == 1
        assert single.count() == 20000
        assert single.subtract(multi).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_with_their_own_headers(spark, tmp_dir):
    """Column order differs between files; one has a column of its own; one lacks some."""
    texts = {
        "a.csv": "reviewer,rating,review_summary\nann,8,ok\n",
        "b.csv": "Rating,review_summary,Reviewer,color\n3,no,bob,red\n",
        "c.csv": "reviewer\ncid\n",
        "d.csv": "",
    }
    for name, text in texts.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    got = {(r.reviewer, r.rating, r.review_summary) for r in read_reviews_csv(spark, tmp_dir).collect()}
    assert got == {("ann", 8.0, "ok"), ("bob", 3.0, "no"), ("cid", None, None)}
    more = read_reviews_csv(spark, tmp_dir, extra=True)
    assert {(r.reviewer, r.color) for r in more.collect()} == {("ann", None), ("bob", "red"), ("cid", None)}


def test_ragged_rows_are_kept_and_counted(spark, tmp_dir):
    path = os.path.join(tmp_dir, "r.csv")
    with open(path, "w") as f:
        f.write("reviewer,rating\nann,8\nbob,7,extra\ncid\n")
    df = read_reviews_csv(spark, path, corrupt=True)
    got = {r.reviewer: r[CORRUPT] for r in df.collect()}
    assert got == {"ann": None, "bob": "bob,7,extra", "cid": "cid"}
    assert tuple(corrupt_rows(df).first()) == (3, 2)


def test_malformed_ids_are_replaced(spark, tmp_dir):
    path = os.path.join(tmp_dir, "r.csv")
    with open(path, "w") as f:
        f.write("review_id,reviewer\nA17,x\n2,y\n,z\n")
    ids = {r.reviewer: r.review_id for r in read_reviews_csv(spark, path).collect()}
    assert ids["y"] == 2 and None not in ids.values() and len(set(ids.values())) == 3


def test_landed_presence_is_read_instead_of_texts(spark, tmp_dir):
    from reviewlens.plans.helpfulness import helpfulness

    view = reviews_view(spark, SF_SMALL)
    landed = land_parquet(view, os.path.join(tmp_dir, "t"))
    rates = helpfulness(landed).rates
    assert "review_detail" not in rates._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, rates.collect())) == sorted(map(tuple, helpfulness(view).rates.collect()))
