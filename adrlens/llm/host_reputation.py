"""URL filter by host reputation, in DataFrame functions only.

Labelled page outcomes are shrunk level by level: a suffix towards the overall bad rate, a
registered domain towards its suffix, a host towards its domain.  Each level has a beta prior
whose mean is the level above and whose strength is estimated from the spread of the rates on
that level (one-way analysis of variance; strength = (1 - rho) / rho).  A host is blocked when
the lower bound of its posterior bad rate exceeds ``max_bad``.  Fixed rules come first.

Defined results: a url that is null or has no ``://`` has empty host and path and belongs to
the host ``''``; outcomes that are null count as no outcome; several outcomes of one page all
count; an empty table of outcomes allows every page without a rule.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from adrlens.llm.common import written

URL_PARTS = r"://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Reputation:
    """``two_part_suffixes``: public suffixes of two labels; all others are the last label."""

    rules: Sequence[Rule] = ()
    two_part_suffixes: Sequence[str] = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp")
    max_bad: float = 0.5
    z: float = 1.645
    least_strength: float = 1.0
    most_strength: float = 1000.0


def url_host(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = (((host == rule.host) | host.endswith("." + rule.host))
                & path.startswith(rule.path))
        found = F.when(fits, value(rule)).otherwise(found)
    return found


def _levels(df: DataFrame, config: Reputation) -> DataFrame:
    site = F.regexp_replace("host", ":[0-9]*$", "")
    two = F.substring_index("site", ".", -2)
    long = two.isin(*config.two_part_suffixes)
    return (df.withColumn("site", site)
            .withColumn("domain", F.when(long, F.substring_index("site", ".", -3)).otherwise(two))
            .withColumn("suffix", F.when(long, two)
                        .otherwise(F.substring_index("site", ".", -1))))


def _strength(groups: DataFrame, config: Reputation) -> float:
    """Beta strength on one level, from one aggregate row."""
    n, bad = F.col("n").cast("double"), F.col("bad").cast("double")
    row = groups.where("n > 0").agg(
        F.count("*").alias("k"), F.sum(n).alias("n"), F.sum(bad).alias("bad"),
        F.sum(n * n).alias("nn"), F.sum(bad * bad / n).alias("within")).first()
    k, total = row["k"], row["n"] or 0.0
    if k < 2 or total <= k:
        return config.most_strength
    mean = row["bad"] / total
    between = (row["within"] - total * mean * mean) / (k - 1)
    inside = (row["bad"] - row["within"]) / (total - k)
    size = (total - row["nn"] / total) / (k - 1)
    spread = between + (size - 1) * inside
    rho = (between - inside) / spread if spread > 0 else 0.0
    if rho <= 0:
        return config.most_strength
    return min(max((1 - rho) / rho, config.least_strength), config.most_strength)


def _shrunk(groups: DataFrame, prior: Column | float, strength: float, name: str) -> DataFrame:
    prior = prior if isinstance(prior, Column) else F.lit(prior)
    return groups.withColumn(name, (F.col("bad") + strength * prior) / (F.col("n") + strength))


def host_posteriors(hosts: DataFrame, config: Reputation) -> DataFrame:
    """(host, n, bad, bad_mean, bad_bound) from (host, n, bad)."""
    hosts = _levels(hosts, config)
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    by_host, by_domain, by_suffix = (_strength(g, config) for g in (hosts, domains, suffixes))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((total["bad"] or 0) + 0.5) / ((total["n"] or 0) + 1.0)
    suffixes = _shrunk(suffixes, overall, by_suffix, "suffix_mean").select("suffix", "suffix_mean")
    domains = _shrunk(domains.join(suffixes, "suffix"), F.col("suffix_mean"), by_domain,
                      "domain_mean").select("domain", "suffix", "domain_mean")
    weight = F.col("n") + by_host
    mean = F.col("bad_mean")
    return (_shrunk(hosts.join(domains, ["domain", "suffix"]), F.col("domain_mean"), by_host, "bad_mean")
            .withColumn("bad_bound", mean - config.z * F.sqrt(mean * (1 - mean) / (weight + 1)))
            .select("host", "n", "bad", "bad_mean", "bad_bound"))


def judge_pages(pages: DataFrame, outcomes: DataFrame, config: Reputation) -> DataFrame:
    """Verdict of every page.

    ``pages``: page_id, url; ``outcomes``: page_id, bad (0 or 1).  Other columns are ignored.
    Returns page_id, host, path, rule, verdict, n_labelled, bad_mean, bad_bound.
    """
    pages = pages.select("page_id", url_host(F.col("url")).alias("host"),
                         url_path(F.col("url")).alias("path"))
    labelled = (outcomes.where(F.col("bad").isNotNull()).groupBy("page_id")
                .agg(F.count("*").alias("n"), F.sum("bad").cast("long").alias("bad")))
    hosts = written(pages.join(labelled, "page_id", "left").groupBy("host").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "hosts")
    judged = pages.join(host_posteriors(hosts, config), "host", "left")
    by_rule = matched_rule(F.col("host"), F.col("path"), config.rules, lambda r: F.lit(r.verdict))
    by_host = F.when(F.col("bad_bound") > config.max_bad, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path",
        matched_rule(F.col("host"), F.col("path"), config.rules, lambda r: F.lit(r.name)).alias("rule"),
        F.coalesce(by_rule, by_host).alias("verdict"),
        F.col("n").alias("n_labelled"), "bad_mean", "bad_bound")
