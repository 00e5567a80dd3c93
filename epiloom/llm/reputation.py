"""URL filter: path rules, and beta-binomial reputation of hosts below the rules.

A host's share of bad pages is estimated from labelled pages by shrinking
three times: suffixes towards the share of all labelled pages, registered
domains towards their suffix, hosts towards their registered domain. How far
is learned from the data, by the overdispersion of the shares on each level.
A host is blocked if the lower posterior bound of its share passes a limit.

Nulls: a null URL, or one without "://", has an empty host and path; pages with
a null outcome count as unlabelled. Without any labelled page nothing is
blocked. Repeated pages count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom.llm.common import ascii_lower, stored

MAX_RULES = 1000
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Public suffixes of two labels that are looked for; other suffixes are the last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")
LEAST_RHO, MOST_RHO = 0.005, 0.5


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none does.

    Rules are a short parameter and become part of the plan.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.host + rule.path).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def suffix_of(host: Column) -> Column:
    """The public suffix: the last label, or the last two if they are listed. Ports don't count."""
    bare = F.regexp_replace(host, r":\d*$", "")
    two = F.substring_index(bare, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(bare, ".", -1))


def domain_of(host: Column) -> Column:
    """The registered domain: the public suffix and one label before it."""
    bare = F.regexp_replace(host, r":\d*$", "")
    two = F.substring_index(bare, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(bare, ".", -3)).otherwise(two)


def _strength(children: DataFrame, *parent: str) -> Column:
    """How many labelled pages a parent's share weighs, by moments over all parents.

    Of the children's shares around that of their parent, the part that
    binomial noise doesn't explain is the overdispersion rho; the weight is
    1/rho - 1. Returned as a scalar subquery.
    """
    some = children.where("n > 0")
    by = some.groupBy(*parent).agg(
        F.sum("n").alias("n"), F.sum("x").alias("x"), F.count("*").alias("k"),
        F.sum(F.col("x") * F.col("x") / F.col("n")).alias("xx"), F.sum(F.col("n") * F.col("n")).alias("nn"),
    )
    p = F.col("x") / F.col("n")
    noise = p * (1 - p)
    found = by.agg(
        F.sum(F.col("xx") - F.col("x") * p - noise * (F.col("k") - 1)).alias("over"),
        F.sum(noise * (F.col("n") - F.col("nn") / F.col("n") - (F.col("k") - 1))).alias("room"),
    )
    rho = F.when(F.col("room") > 0, F.col("over") / F.col("room")).otherwise(LEAST_RHO)
    rho = F.greatest(F.lit(LEAST_RHO), F.least(F.lit(MOST_RHO), F.coalesce(rho, F.lit(LEAST_RHO))))
    return found.select((1 / rho - 1).alias("strength")).scalar()


def host_counts(pages: DataFrame, host: str = "host", bad: str = "bad") -> DataFrame:
    """Labelled pages n and bad ones x by host, from pages with a host and an outcome 0, 1 or null."""
    return pages.groupBy(F.col(host).alias("host")).agg(
        F.count(bad).cast("double").alias("n"), F.coalesce(F.sum(bad), F.lit(0)).cast("double").alias("x")
    )


def host_posteriors(counts: DataFrame, z: float = 1.645) -> DataFrame:
    """host, n, x, mean and lower (posterior mean and lower bound of the share of bad pages).

    `counts` is read several times: give it as a stored table.
    """
    hosts = counts.select("host", "n", "x", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    overall = counts.agg((F.sum("x") / F.greatest(F.sum("n"), F.lit(1.0))).alias("p")).scalar()

    def shrunk(mean: Column, strength: Column) -> Column:
        return (F.col("x") + strength * mean) / (F.col("n") + strength)

    top = suffixes.select("suffix", shrunk(overall, _strength(suffixes.withColumn("all", F.lit(1)), "all")).alias("suffix_mean"))
    middle = domains.join(top, "suffix").select(
        "domain", shrunk(F.col("suffix_mean"), _strength(domains, "suffix")).alias("domain_mean")
    )
    low = hosts.join(middle, "domain").withColumn("strength", _strength(hosts, "domain"))
    mean = shrunk(F.col("domain_mean"), F.col("strength"))
    spread = F.sqrt(mean * (1 - mean) / (F.col("n") + F.col("strength") + 1))
    return low.select("host", "n", "x", mean.alias("mean"), (mean - z * spread).alias("lower"))


def judge_pages(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], limit: float = 0.5, z: float = 1.645
) -> DataFrame:
    """page_id, host, path, rule and verdict of pages (page_id, url), given outcomes (page_id, bad)."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    one = outcomes.where("page_id IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    # The host is taken from the page itself; only ids and outcomes meet.
    counts = stored(host_counts(parts.join(one, "page_id", "left")), "host-counts")
    known = stored(
        host_posteriors(counts, z).select("host", (F.col("lower") > limit).alias("bad_host")), "host-verdicts"
    )
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("bad_host"), "block").otherwise("allow")
    return parts.join(known, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict")
    )
