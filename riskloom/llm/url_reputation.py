"""URL filters: path rules first, then empirical-Bayes host reputation.

Rules name a host and a path prefix; the longest fitting rule decides.  Pages that
no rule decides are judged by their host's reputation.  A labelled page
outcome is good or bad (in the query: what a rule said of the page).  Each level's
share of good pages has a beta prior around its parent's posterior mean: the suffix's
around the overall share, the registered domain's around its suffix, the host's around its
domain.  A level's prior strength is estimated by moments from how far its members'
shares differ from their common share.  A page is blocked if the posterior's upper bound
(mean plus ``z`` standard deviations) for its host is under ``cut``: only evidence
blocks, an unknown host is allowed.

Only built-in functions.  Pages are reduced to one row per host by partial
aggregates; a host with most of the pages meets its verdict in a join that adaptive
execution splits.

Defined cases: a null url, or one without ``://``, has empty host and path; no rule fits an
empty host; the registered domain is the last two labels and the suffix the last
(of an empty host: empty); with no labelled page every posterior stays at 0.5; repeated rows
count each and get the same verdict each; a url of any length is read whole; an empty table gives an empty result.  Only the
named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def first_fitting(rules: list[Rule], host: Column, path: Column, value) -> Column:
    """``value(rule)`` of the longest fitting rule (equally long ones: the first
    listed), else null."""
    ordered = sorted(rules, key=lambda r: -len(r.name))
    return F.coalesce(*[F.when(_fits(r, host, path), F.lit(value(r))) for r in ordered], F.lit(None).cast("string"))


def split_url(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    out = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                       path_of(F.col(url_col)).alias("path"))
    return out.select("*", first_fitting(rules, F.col("host"), F.col("path"), lambda r: r.name).alias("rule"),
                      first_fitting(rules, F.col("host"), F.col("path"), lambda r: r.verdict).alias("said"))


def _strength(level: DataFrame, low: float = 1.0, high: float = 1000.0) -> DataFrame:
    """One row: the common share ``p`` of good pages and the prior strength of a
    level with rows (n, good), from the spread of its members' shares."""
    total = level.agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.count_if(F.col("n") > 0).alias("k"),
                      F.sum(F.when(F.col("n") > 0, F.col("good") * F.col("good") / F.col("n"))).alias("q"))
    p = F.when(F.col("n") > 0, F.col("good") / F.col("n")).otherwise(0.5)
    spread = (F.col("q") - F.col("good") * F.col("good") / F.col("n")) / F.col("n")  # between members
    noise = p * (1 - p) * F.col("k") / F.col("n")  # expected of equal members
    between = spread - noise
    strength = F.when(between > 0, F.greatest(F.lit(low), F.least(F.lit(high), p * (1 - p) / between - 1))).otherwise(high)
    return total.select(p.alias("p"), F.coalesce(strength, F.lit(low)).alias("strength"))


def _posterior(level: DataFrame, key: str, prior_mean: Column, strength: Column) -> DataFrame:
    mean = (F.col("good") + strength * prior_mean) / (F.col("n") + strength)
    return level.withColumn("mean", mean).withColumn("weight", F.col("n") + strength).select(key, "mean", "weight")


def reputation(outcomes: DataFrame, z: float = 1.64) -> DataFrame:
    """(host, mean, upper) from rows (host, good), good being 1, 0 or null (not
    labelled)."""
    hosts = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    hosts = materialize(hosts.withColumn("suffix", F.substring_index("host", ".", -1))
                        .withColumn("domain", F.substring_index("host", ".", -2)), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    root, of_domains, of_hosts = (_strength(x).first() for x in (suffixes, domains, hosts))  # two numbers each
    s = _posterior(suffixes, "suffix", F.lit(root.p), F.lit(root.strength)).select("suffix", F.col("mean").alias("above"))
    d = _posterior(domains.join(s, "suffix"), "domain", F.col("above"), F.lit(of_domains.strength)) \
        .select("domain", F.col("mean").alias("above"))
    h = _posterior(hosts.join(d, "domain"), "host", F.col("above"), F.lit(of_hosts.strength))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return h.select("host", "mean", (F.col("mean") + z * deviation).alias("upper"))


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", cut: float = 0.5,
          z: float = 1.64) -> DataFrame:
    """page_id, host, path, rule, verdict, reputation per row of ``pages``."""
    split = split_url(pages, rules, id_col, url_col)
    good = F.when(F.col("said") == "allow", 1).when(F.col("said") == "block", 0)
    known = reputation(split.select("host", good.alias("good")), z).withColumnRenamed("host", "h")
    joined = split.join(known, F.col("host") == F.col("h"))
    verdict = F.coalesce("said", F.when(F.col("upper") < cut, "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.col("mean").alias("reputation"))
