"""Vote parsing and helpfulness tables on hand-made rows."""

from pyspark.sql import functions as F

from reviewlens.operators import votes as V
from reviewlens.plans.helpfulness import helpfulness

ROWS = [
    ("a", "3,7"),
    ("a", "5"),
    ("b", "x,2"),
    (None, "9,1"),
    ("c", None),
    ("d", " 4 , 6"),
    ("d", ""),
    ("e", "['1', '2']"),
    ("f", "5.7,1"),
]


FRACTIONS = [(".5,-.25", 0, 0), ("+.9, .1 ", 0, 0), (".,-", None, None), ("5.,1.0", 5, 1)]


def test_bare_fractions_are_zero(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in FRACTIONS], "helpful_str string")
    got = [(r.helpful_str, r.helpful_votes, r.non_helpful_votes) for r in V.parse_votes(df).collect()]
    assert got == FRACTIONS


def votes_df(spark):
    return spark.createDataFrame(ROWS, "reviewer string, helpful_str string")


def test_parse_votes(spark):
    got = [
        (r.helpful_str, r.helpful_votes, r.non_helpful_votes)
        for r in V.parse_votes(votes_df(spark)).collect()
    ]
    assert got == [
        ("3,7", 3, 7),
        ("5", 5, None),
        ("x,2", None, 2),
        ("9,1", 9, 1),
        (None, None, None),
        (" 4 , 6", 4, 6),
        ("", None, None),
        ("['1', '2']", None, None),
        ("5.7,1", 5, 1),
    ]


def test_lenient_int_edges(spark):
    from reviewlens.functions.votes import lenient_int

    cases = ["+5", "-3", " 7 ", "5.", "1e2", "99999999999", "", "  ", "12abc"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r.v for r in df.select(lenient_int(F.col("t")).alias("v")).collect()]
    assert got == [5, -3, 7, 5, None, None, None, None, None]


def test_totals_net_counts_rates(spark):
    parsed = V.parse_votes(votes_df(spark))
    net = {r.reviewer: (r.total_helpful_votes, r.total_non_helpful_votes, r.net_helpful_votes)
           for r in V.net_votes(V.vote_totals(parsed)).collect()}
    assert net == {
        "a": (8, 7, 1),
        "b": (None, 2, None),
        "c": (None, None, None),
        "d": (4, 6, -2),
        "e": (None, None, None),
        "f": (5, 1, 4),
        None: (9, 1, 8),
    }
    counts = {r.reviewer: r.review_count for r in V.review_counts(parsed).collect()}
    assert counts == {"a": 2, "b": 1, "c": 1, "d": 2, "e": 1, "f": 1, None: 1}
    rates = {r.reviewer: r.helpful_rate for r in V.helpful_rate(parsed).collect()}
    assert rates == {"a": 0.5, "b": None, "c": None, "d": -1.0, "e": None, "f": 4.0}


def test_join_form_equals_single_pass(spark):
    parsed = V.parse_votes(votes_df(spark))
    net = V.net_votes(V.vote_totals(parsed))
    joined = V.helpful_rate_join(net, V.review_counts(parsed))
    single = V.helpful_rate(parsed)
    cols = sorted(single.columns)
    assert sorted(joined.columns) == cols
    assert sorted(map(tuple, joined.select(cols).collect()), key=str) == sorted(
        map(tuple, single.select(cols).collect()), key=str
    )


def test_single_pass_has_one_shuffle_and_no_join(spark):
    plan = V.helpful_rate(V.parse_votes(votes_df(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Exchange") <= 1


def test_rank_tie_break_and_limit(spark):
    rows = [(f"r{i:02d}", 10, 0) for i in range(25)] + [("z", 1, 5)]
    df = spark.createDataFrame(rows, "reviewer string, total_helpful_votes long, total_non_helpful_votes long")
    net = V.net_votes(df)
    top = [r.reviewer for r in V.rank_reviewers(net, "net_helpful_votes", ascending=False).collect()]
    assert top == [f"r{i:02d}" for i in range(20)]
    bottom = [r.reviewer for r in V.rank_reviewers(net, "net_helpful_votes", ascending=True, k=3).collect()]
    assert bottom == ["z", "r00", "r01"]
    plan = V.rank_reviewers(net, "net_helpful_votes", ascending=False)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_complete_only_counts_complete_rows(spark):
    df = spark.createDataFrame(
        [(1, "a", 7.0, "s", "d", "1,0"), (2, "a", None, "s", "d", "5,0"), (3, "a", 3.0, None, "d", "2,0")],
        "review_id long, reviewer string, rating double, review_summary string, review_detail string, helpful_str string",
    )
    h = helpfulness(df)
    assert [tuple(r) for r in h.rates.select("reviewer", "total_helpful_votes", "review_count").collect()] == [("a", 1, 1)]
    h_all = helpfulness(df, complete_only=False)
    assert [tuple(r) for r in h_all.rates.select("reviewer", "total_helpful_votes", "review_count").collect()] == [("a", 8, 3)]


def test_require_and_label_resolve_names_case_insensitively(spark):
    from reviewlens.operators.prepare import label_sentiment, require

    df = spark.createDataFrame([(1, 5.0, "x"), (2, 6.0, None), (3, None, "y"), (4, 9.0, "z")], "review_id long, Rating double, Review_Summary string")
    got = [(r.review_id, r.sentiment) for r in label_sentiment(require(df, ["review_summary", "rating"])).collect()]
    assert got == [(1, 0), (4, 1)]  # a rating of exactly 5 is negative


def test_helpfulness_report_written_as_parquet(spark, tmp_dir):
    from reviewlens.sources.fixtures import reviews_view

    from conftest import SF_SMALL

    h = helpfulness(reviews_view(spark, SF_SMALL))
    paths = h.write(tmp_dir + "/report")
    assert set(paths) == {"net_votes", "review_counts", "helpful_rates", "top_net", "bottom_net", "top_rate", "bottom_rate"}
    assert spark.read.parquet(paths["helpful_rates"]).count() == h.rates.count()
    assert spark.read.parquet(paths["top_rate"]).count() <= 20


def test_report_is_written_from_one_scan(spark, tmp_dir):
    import os

    h = helpfulness(votes_df(spark), complete_only=False)
    paths = h.write(os.path.join(tmp_dir, "report"))
    for name, df in h.tables().items():
        assert sorted(map(str, spark.read.parquet(paths[name]).collect())) == sorted(map(str, df.collect())), name
    once = spark.read.parquet(os.path.join(tmp_dir, "report", "reviewers"))
    assert once.count() == votes_df(spark).select("reviewer").distinct().count()
