"""Reviewer helpfulness: votes per review, totals, net votes, rates, rankings.

All aggregates group by ``reviewer`` with partial (map-side) aggregation, so a
reviewer holding a large share of the rows costs one partial row per map task,
not a hot reducer.  A null reviewer is one group in the totals and counts but
never matches in the equi-join, so it is absent from the rate table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.votes import vote_part

REVIEWER = "reviewer"


def parse_votes(df: DataFrame, helpful_str: str = "helpful_str") -> DataFrame:
    """Add ``helpful_votes`` and ``non_helpful_votes`` (int, null when unparsable)."""
    return df.withColumns(
        {
            "helpful_votes": vote_part(helpful_str, 0),
            "non_helpful_votes": vote_part(helpful_str, 1),
        }
    )


def vote_totals(parsed: DataFrame) -> DataFrame:
    """Sum of helpful and of non-helpful votes per reviewer (null when none parse)."""
    return parsed.groupBy(REVIEWER).agg(
        F.sum("helpful_votes").alias("total_helpful_votes"),
        F.sum("non_helpful_votes").alias("total_non_helpful_votes"),
    )


def net_votes(totals: DataFrame) -> DataFrame:
    """Add ``net_helpful_votes`` = helpful − non-helpful (null if either is)."""
    return totals.withColumn(
        "net_helpful_votes", F.col("total_helpful_votes") - F.col("total_non_helpful_votes")
    )


def review_counts(parsed: DataFrame) -> DataFrame:
    """Rows per reviewer, unparsable votes included."""
    return parsed.groupBy(REVIEWER).agg(F.count(F.lit(1)).alias("review_count"))


def _with_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("helpful_rate", F.col("net_helpful_votes") / F.col("review_count"))


def helpful_rate_join(net: DataFrame, counts: DataFrame) -> DataFrame:
    """Net votes joined to review counts on ``reviewer``, plus the rate.

    Both inputs are unique per reviewer, so the join emits at most one row
    per reviewer; AQE chooses broadcast or sort-merge from runtime sizes.
    """
    return _with_rate(net.join(counts, REVIEWER, "inner"))


def per_reviewer(parsed: DataFrame) -> DataFrame:
    """Vote totals and review count per reviewer (a null reviewer is one group): one scan, one shuffle."""
    return parsed.groupBy(REVIEWER).agg(
        F.sum("helpful_votes").alias("total_helpful_votes"),
        F.sum("non_helpful_votes").alias("total_non_helpful_votes"),
        F.count(F.lit(1)).alias("review_count"),
    )


def rate_of(reviewers: DataFrame) -> DataFrame:
    """Net votes and rate of the ``per_reviewer`` rows that have a reviewer."""
    return _with_rate(net_votes(reviewers.filter(F.col(REVIEWER).isNotNull()))).select(
        REVIEWER,
        "total_helpful_votes",
        "total_non_helpful_votes",
        "net_helpful_votes",
        "review_count",
        "helpful_rate",
    )


def helpful_rate(parsed: DataFrame) -> DataFrame:
    """Same rows as ``helpful_rate_join`` in one aggregation: one scan, one shuffle, no join."""
    return rate_of(per_reviewer(parsed.filter(F.col(REVIEWER).isNotNull())))


def rank_reviewers(df: DataFrame, by: str, ascending: bool, k: int = 20) -> DataFrame:
    """First ``k`` reviewers with non-null net votes, ordered by ``by``.

    ``reviewer`` breaks ties so the result is determined.  Sort + limit plans
    as ``TakeOrderedAndProject``: a top-k per task, merged on one node, so
    only ``k`` rows per task move.
    """
    key = F.col(by).asc() if ascending else F.col(by).desc()
    return (
        df.filter(F.col("net_helpful_votes").isNotNull())
        .orderBy(key, F.col(REVIEWER).asc())
        .limit(k)
    )
