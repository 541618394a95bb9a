"""Review-shaped views over the driver tables.

``reviews_view`` gives every review column, including null reviewers,
ratings, summaries and vote strings, plus unparsable and one-sided votes.
``reviews_scale`` is a votes-only table with one row per line item, for the
bench.  Both are plain projections and joins; Catalyst prunes the scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.sources.tables import read_table


def _s(c: Column) -> Column:
    return c.cast("string")


def reviews_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` left-joined to ``labels`` and shaped as reviews.

    ``rating`` is null for unlabelled documents and above 5 exactly when
    ``quality = 1``.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    d = F.col("doc_id")
    q = F.col("quality")
    return docs.join(labels, "doc_id", "left").select(
        d.alias("review_id"),
        F.when(d % 29 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("r"), _s(d % 97)))
        .alias("reviewer"),
        F.when(q == 1, 6 + d % 5).when(q == 0, 1 + d % 5).alias("rating"),
        F.when(d % 31 == 0, F.lit(None).cast("string"))
        .otherwise(F.substring_index(F.col("text"), "\n", 1))
        .alias("review_summary"),
        F.col("text").alias("review_detail"),
        F.when(d % 23 == 0, F.lit(None).cast("string"))
        .when(d % 19 == 0, F.concat(F.lit("n/a,"), _s(d % 7)))
        .when(d % 17 == 0, _s(d % 11))
        .otherwise(F.concat(_s(d % 13), F.lit(","), _s(d % 7)))
        .alias("helpful_str"),
    )


def reviews_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vote row per line item; reviewer = the order's customer.

    ``review_id`` is not unique here, so nothing splits on it.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    k = F.col("l_orderkey")
    return li.join(orders, k == F.col("o_orderkey")).select(
        (k * 10 + F.col("l_linenumber")).alias("review_id"),
        F.concat(F.lit("c"), _s(F.col("o_custkey"))).alias("reviewer"),
        (1 + k % 10).alias("rating"),
        F.concat(_s(k % 13), F.lit(","), _s(F.col("l_linenumber"))).alias("helpful_str"),
    )
