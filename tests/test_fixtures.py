"""The review views match the fixture description (FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from reviewlens.sources.fixtures import reviews_scale, reviews_view
from reviewlens.sources.tables import read_table


@pytest.mark.parametrize("sf, docs, items", [("0.001", 200, 6000), ("0.01", 1000, 60000)])
def test_row_counts(spark, sf, docs, items):
    d = f"/root/testdata/sf{sf}"
    assert reviews_view(spark, d).count() == docs
    assert reviews_scale(spark, d).count() == items


def test_rating_above_five_exactly_for_quality_one(spark):
    d = "/root/testdata/sf0.01"
    v = reviews_view(spark, d).join(
        read_table(spark, d, "labels").select(F.col("doc_id").alias("review_id"), "quality"), "review_id", "left"
    )
    bad = v.filter(
        (F.col("rating").isNull() != F.col("quality").isNull())
        | (F.col("quality").isNotNull() & ((F.col("rating") > 5) != (F.col("quality") == 1)))
    )
    assert bad.count() == 0
    kinds = v.select(
        F.sum(F.col("reviewer").isNull().cast("int")).alias("null_reviewer"),
        F.sum(F.col("review_summary").isNull().cast("int")).alias("null_summary"),
        F.sum(F.col("helpful_str").isNull().cast("int")).alias("null_votes"),
        F.sum(F.col("helpful_str").startswith("n/a").cast("int")).alias("text_votes"),
        F.sum((~F.col("helpful_str").contains(",")).cast("int")).alias("one_sided"),
    ).first()
    assert all(x > 0 for x in kinds)
