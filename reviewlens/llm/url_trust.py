"""URL filter with link-graph propagation, in DataFrame functions only.

A url is judged by the longest rule that fits it.  What no rule decides is judged by its
host: trust flows from trusted hosts along links (personalised PageRank), distrust flows
from blocked hosts against the links, to those that link to them.  Seeds are the hosts
most of whose pages the rules allow, or block (a host without pages: its root url).  Each
round a host passes on ``DAMPING`` of its trust, in equal parts per link; scores are
relative to a seed's own 1.  Distrust is what each linker takes by the share that a link has in its
*own* links: the damped chance that a walk from the host along links ends at a blocked
one, its personalised PageRank seen from the far end.  So it is at most ``DAMPING`` for a host that is no seed, and
does not fade with the number of other hosts that link to the same seed.  A host is blocked if its
distrust reaches ``MIN_DISTRUST`` and exceeds its trust.

Links are ``<a href>`` with a host of their own, outside comments and scripts, between
different hosts; they are summed by (from, to) before any shuffle of them, so a hot host
or a hot link is one row.  The work is on hosts and host pairs; every round is a join and
an aggregate, written to the shared folder.  Rounds end when no score changes by more
than ``TOLERANCE``, which the damping bounds to about ``log(TOLERANCE) / log(DAMPING)``.

Edge cases: very long pages are searched whole, by expressions that keep no more than the
links found; a null url, or one without ``://``, has an empty host and path, fits no rule and
is allowed; null html has no links; repeated rows count as pages each and get a row each;
an empty table gives no rows; other columns are not read; rules of equal length: the
longer host first, then block before allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.session import materialize, remove_path, shared_path, written

ALLOW, BLOCK = "allow", "block"
DAMPING = 0.85
#: Least distrust that blocks: 0.25 is what a host has some three in ten of whose links lead to a blocked one.
MIN_DISTRUST = 0.25
TOLERANCE = 1e-9

# A-Z and a-z.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""
NOT_LINKS = r"(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script|$)|<style\b.*?(?:</style|$)"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def deciding_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) that decides a url, both null if none fits; ``rules``: (verdict, host/path)."""

    def rank(rule: tuple[str, str]) -> tuple:
        return -len(rule[1]), -len(rule[1].partition("/")[0]), rule[0] != BLOCK

    which = verdict = F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=rank, reverse=True):  # the last one wrapped is looked at first
        name, slash, rest = rule.partition("/")
        fits = (host == name) | host.endswith("." + name)
        fits &= path.startswith(slash + rest)
        which, verdict = F.when(fits, rule).otherwise(which), F.when(fits, kind).otherwise(verdict)
    return which, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """``src, dst, n``: links between different hosts of ``host, html`` pages."""
    urls = F.explode(F.regexp_extract_all(F.regexp_replace("html", NOT_LINKS, " "), F.lit(LINK), F.lit(1)))
    found = pages.filter(F.contains(F.lower("html"), F.lit("//")) & (F.col("host") != "")).select("host", urls.alias("url"))
    # a link without a scheme has the page's
    full = F.when(F.col("url").startswith("//"), F.concat(F.lit("x:"), "url")).otherwise(F.col("url"))
    links = found.select(F.col("host").alias("src"), host_of(full).alias("dst"))
    return links.filter("dst != '' and src != dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(
    seeds: DataFrame, links: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """``host, trust, distrust`` for every host of ``seeds`` (``host, seed``: 1, -1 or 0) and of ``links``."""
    links = materialize(links, "url-links")
    ends = links.select(F.col("src").alias("host")).union(links.select("dst")).distinct()
    hosts = ends.join(seeds, "host", "full").select("host", F.coalesce("seed", F.lit(0)).alias("seed"))
    base = materialize(
        hosts.select(
            "host",
            F.when(F.col("seed") > 0, 1.0).otherwise(0.0).alias("trust_seed"),
            F.when(F.col("seed") < 0, 1.0).otherwise(0.0).alias("distrust_seed"),
        ),
        "url-hosts",
    )
    # trust goes forward, distrust backward, both by the shares that the links have in those of the linking host
    out = links.groupBy("src").agg(F.sum("n").alias("total"))
    shared = links.join(out, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share"))
    way = lambda a, b, way: F.struct(F.col(a).alias("src"), F.col(b).alias("dst"), F.lit(way).alias("way"))
    ways = F.array(way("src", "dst", 1), way("dst", "src", -1))
    edges = materialize(shared.select(F.explode(ways).alias("edge"), "share").select("edge.*", "share"), "url-edges")
    scores = base.select("host", F.col("trust_seed").alias("trust"), F.col("distrust_seed").alias("distrust"))
    last = None
    while not edges.isEmpty():
        has = F.when(F.col("way") > 0, F.col("trust")).otherwise(F.col("distrust")) * F.col("share")
        sent = edges.join(scores.filter("trust > 0 or distrust > 0"), edges["src"] == scores["host"])
        sent = sent.select(F.col("dst").alias("host"), "way", has.alias("part")).groupBy("host").agg(
            F.sum(F.when(F.col("way") > 0, F.col("part"))).alias("t"),
            F.sum(F.when(F.col("way") < 0, F.col("part"))).alias("d"),
        )
        gets = lambda c: F.coalesce(c, F.lit(0.0)) * F.lit(damping)
        new = base.join(sent, "host", "left").select(
            "host",
            (F.col("trust_seed") + gets("t")).alias("trust"),
            (F.col("distrust_seed") + gets("d")).alias("distrust"),
        )
        path = shared_path(seeds.sparkSession, "url-scores")
        new = written(new, path)
        old = scores.select("host", F.col("trust").alias("t"), F.col("distrust").alias("d"))
        moved = new.join(old, "host").agg(
            F.max(F.greatest(F.abs(F.col("trust") - F.col("t")), F.abs(F.col("distrust") - F.col("d")))).alias("m")
        )
        most = moved.first()["m"] or 0.0
        if last:
            remove_path(seeds.sparkSession, last)
        scores, last = new, path
        if most <= tolerance:
            break
    return scores


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str]], page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page."""
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        F.col(html).cast("string").alias("html"),
    )
    rule, verdict = deciding_rule(F.col("host"), F.col("path"), rules)
    judged = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    links = host_links(rows.select("host", "html"))
    count = lambda kind: F.sum(F.when(F.col("ruled") == kind, 1).otherwise(0))
    own = judged.filter("host != ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), count(ALLOW).alias("allowed"), count(BLOCK).alias("blocked")
    )
    own = own.select("host", F.when(F.col("allowed") * 2 > F.col("n"), 1).when(F.col("blocked") * 2 > F.col("n"), -1).otherwise(0).alias("seed"))
    links = materialize(links, "url-links")
    _, at_root = deciding_rule(F.col("host"), F.lit("/"), rules)
    linked = links.select(F.col("dst").alias("host")).distinct().join(own, "host", "left_anti")
    linked = linked.select("host", F.when(at_root == ALLOW, 1).when(at_root == BLOCK, -1).otherwise(0).alias("seed"))
    scores = propagate(own.union(linked), links)
    bad = (F.col("distrust") >= MIN_DISTRUST) & (F.col("distrust") > F.col("trust"))
    blocked = scores.filter(bad).select("host", F.lit(True).alias("distrusted"))
    by_host = F.when(F.col("distrusted"), BLOCK).otherwise(ALLOW)
    return judged.join(blocked, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict")
    )
