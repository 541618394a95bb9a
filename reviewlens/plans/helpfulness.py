"""Reviewer helpfulness, end to end: parse votes, total, rate, rank."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from reviewlens.operators.prepare import require
from reviewlens.operators.votes import (
    helpful_rate,
    net_votes,
    parse_votes,
    per_reviewer,
    rank_reviewers,
    rate_of,
    review_counts,
    vote_totals,
)

COMPLETE = ("review_summary", "review_detail", "rating")


@dataclass(frozen=True)
class Helpfulness:
    parsed: DataFrame
    net: DataFrame
    counts: DataFrame
    rates: DataFrame

    def top_net(self, k: int = 20) -> DataFrame:
        return rank_reviewers(self.net, "net_helpful_votes", ascending=False, k=k)

    def bottom_net(self, k: int = 20) -> DataFrame:
        return rank_reviewers(self.net, "net_helpful_votes", ascending=True, k=k)

    def top_rate(self, k: int = 20) -> DataFrame:
        return rank_reviewers(self.rates, "helpful_rate", ascending=False, k=k)

    def bottom_rate(self, k: int = 20) -> DataFrame:
        return rank_reviewers(self.rates, "helpful_rate", ascending=True, k=k)

    def tables(self, k: int = 20) -> dict[str, DataFrame]:
        """Every table of the report, by name."""
        return {
            "net_votes": self.net,
            "review_counts": self.counts,
            "helpful_rates": self.rates,
            "top_net": self.top_net(k),
            "bottom_net": self.bottom_net(k),
            "top_rate": self.top_rate(k),
            "bottom_rate": self.bottom_rate(k),
        }

    def write(self, path: str, mode: str = "error", k: int = 20) -> dict[str, str]:
        """Write every table as Parquet under ``path/<name>``; return the paths.

        The source is read once: one aggregate per reviewer is written as
        ``path/reviewers``, and every table comes from that.
        """
        base = f"{path.rstrip('/')}/reviewers"
        per_reviewer(self.parsed).write.mode(mode).parquet(base)
        reviewers = self.parsed.sparkSession.read.parquet(base)
        totals = reviewers.drop("review_count")
        once = Helpfulness(
            parsed=self.parsed,
            net=net_votes(totals),
            counts=reviewers.select("reviewer", "review_count"),
            rates=rate_of(reviewers),
        )
        out = {}
        for name, df in once.tables(k).items():
            target = f"{path.rstrip('/')}/{name}"
            df.write.mode(mode).parquet(target)
            out[name] = target
        return out


def complete_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews with summary, detail and rating present: the rows votes are counted on.

    On a landed table the presence columns are filtered on, so no text is read.
    """
    present = [f"has_{c}" for c in ("summary", "detail")]
    if all(c in reviews.columns for c in present):
        return require(reviews, ["rating"]).filter(" and ".join(present))
    return require(reviews, COMPLETE)


def helpfulness(reviews: DataFrame, complete_only: bool = True) -> Helpfulness:
    """All helpfulness tables over ``reviews``.

    With ``complete_only`` (the default) only reviews that have both texts
    and a rating count.  ``rates`` is the single-pass form (one shuffle).
    """
    rows = complete_reviews(reviews) if complete_only else reviews
    parsed = parse_votes(rows.select("reviewer", "helpful_str"))
    return Helpfulness(
        parsed=parsed,
        net=net_votes(vote_totals(parsed)),
        counts=review_counts(parsed),
        rates=helpful_rate(parsed),
    )
