"""URL rules, and for all other pages an empirical-Bayes host reputation.

Labelled page outcomes are counted by host. The rate of bad pages is shrunk step by step: the
suffix towards the whole, the registered domain towards its suffix, the host towards its domain.
Each step is a beta-binomial posterior whose prior strength is estimated by moments from that
level's own groups. A host is blocked when the lower bound of its posterior bad rate is over
``block_over``. A host without labels gets its domain's, suffix's or the overall rate.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and
is judged as the host ''; a null outcome counts as unlabelled; repeated rows count each time; with
no labels at all the rate is 0 and nothing is blocked; an empty table gives no rows. Counts are
combined map-side before any shuffle, so a host with a third of all pages is one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def longest_rule(rules: list[Rule], host: Column, path: Column,
                 value=lambda rule: rule.name) -> Column:
    """``value`` of the longest rule that fits, else null. The host decides first."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host), len(r.path))):
        found = F.when(rule.fits(host, path), F.lit(value(rule))).otherwise(found)
    return found


def suffix_of(host: Column, shared: list[str]) -> Column:
    """The longest of ``shared`` that the host stands under, else its last label."""
    found = F.substring_index(host, ".", -1)
    for suffix in sorted(shared, key=len):
        found = F.when((host == suffix) | host.endswith("." + suffix), F.lit(suffix)
                       ).otherwise(found)
    return found


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and one label more."""
    head = F.substring(host, F.lit(1), F.length(host) - F.length(suffix) - 1)
    return F.when(F.length(host) <= F.length(suffix), host).otherwise(
        F.concat(F.substring_index(head, ".", -1), F.lit("."), suffix))


def strength(groups: DataFrame, least: float = 4.0, most: float = 1000.0) -> DataFrame:
    """One row: the prior's weight in pages, by moments of the groups' (n, bad)."""
    s = groups.agg(F.sum("n").cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"),
                   F.count("*").cast("double").alias("m"),
                   F.sum(F.col("n") * F.col("n")).cast("double").alias("nn"),
                   F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("pp"))
    p = F.try_divide("bad", "n")
    noise = p * (1 - p)
    spread = (F.col("pp") - F.col("n") * p * p - (F.col("m") - 1) * noise)
    between = F.try_divide(spread, F.col("n") - F.try_divide("nn", "n"))
    share = F.try_divide(between, noise)
    weight = F.when(share <= 0, F.lit(most)).otherwise(F.try_divide(1 - share, share))
    return s.select(F.greatest(F.lit(least), F.least(
        F.lit(most), F.coalesce(weight, F.lit(most)))).alias("weight"))


def reputation(outcomes: DataFrame, shared: list[str], z: float = 1.645) -> DataFrame:
    """``outcomes`` has host and bad (0, 1 or null), one row per page; returns one row per host:
    suffix, domain, n, bad, ``bad_rate`` (posterior mean) and ``bad_bound`` (its lower bound)."""
    hosts = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0))
        .alias("bad"))
    hosts = hosts.select("*", suffix_of(F.col("host"), shared).alias("suffix")).select(
        "*", domain_of(F.col("host"), F.col("suffix")).alias("domain"))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"),
                                                    F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # Four numbers come to the driver, whatever the size of the input.
    weight = {name: strength(level.where("n > 0")).first()["weight"] for name, level in (
        ("suffix", suffixes), ("domain", domains), ("host", hosts))}
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = (whole["bad"] or 0) / whole["n"] if whole["n"] else 0.0

    def shrunk(level: str, prior: Column) -> Column:
        w = F.lit(float(weight[level]))
        return (prior * w + F.col("bad")) / (w + F.col("n"))

    suffixes = suffixes.select("suffix", shrunk("suffix", F.lit(float(overall)))
                               .alias("suffix_rate"))
    domains = domains.join(suffixes, "suffix").select(
        "domain", shrunk("domain", F.col("suffix_rate")).alias("domain_rate"))
    rated = hosts.join(domains, "domain").select(
        "host", "domain", "suffix", "n", "bad",
        shrunk("host", F.col("domain_rate")).alias("bad_rate"))
    mean, size = F.col("bad_rate"), F.lit(float(weight["host"])) + F.col("n")
    return rated.select("*", F.greatest(F.lit(0.0), mean - F.lit(z) * F.sqrt(
        mean * (1 - mean) / (size + 1))).alias("bad_bound"))


def judged(pages: DataFrame, rules: list[Rule], shared: list[str], block_over: float = 0.3,
           page_id: str = "page_id", url: str = "url", bad: str = "bad") -> DataFrame:
    """page_id, host, path, rule, verdict, bad_bound for every row of ``pages``."""
    split = pages.select(F.col(page_id).alias("page_id"), F.col(bad).alias("bad"),
                         host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    known = reputation(split.select("host", "bad"), shared).select("host", "bad_bound")
    host, path = F.col("host"), F.col("path")
    return split.join(known, "host").select(
        "page_id", "host", "path", longest_rule(rules, host, path).alias("rule"),
        F.coalesce(longest_rule(rules, host, path, lambda rule: rule.action),
                   F.when(F.col("bad_bound") > block_over, F.lit("block"))
                   .otherwise(F.lit("allow"))).alias("verdict"),
        F.round("bad_bound", 6).alias("bad_bound"))
