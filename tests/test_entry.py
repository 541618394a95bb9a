"""The driver contract."""

import __spark_entry__ as E

from reviewlens.plans.catalog import QUERIES
from reviewlens.plans.oracle import ORACLE


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 20
    assert df.columns == [
        "reviewer",
        "total_helpful_votes",
        "total_non_helpful_votes",
        "net_helpful_votes",
        "review_count",
        "helpful_rate",
    ]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(ORACLE) <= set(QUERIES) <= set(E.queries())
    tuned = {f"tune_{m}{s}" for m in ("lr", "svc", "rf", "mlp") for s in ("", "_summary")}
    assert set(QUERIES) - set(ORACLE) == tuned | {
        "embed_summary",
        "embed_detail",
        "embed_both",
        "embed_repeatable_both",
        "compare_models",
        "compare_feature_sets",
    }
