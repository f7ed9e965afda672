"""URL filters: allow and block rules, and host reputation by empirical Bayes.

Labelled page outcomes are counted per host, registered domain and public suffix. Each level's
bad share has a beta prior whose mean is the posterior mean one level up and whose strength is
estimated from the level's counts by the method of moments. A page without a rule is blocked if
the lower bound of its host's posterior bad share is over a limit; a host without labels has its
domain's mean and a wide posterior. Everything is DataFrame functions; sums are whole numbers,
so verdicts do not depend on the order of rows.

Defined results: a null URL or one without ``://`` has empty host and path, no rule, and the
reputation of the empty host. Repeated pages are all judged and all counted; of repeated labels
of one page the worst counts, labels without an outcome do not. Without any labels every page
without a rule is allowed. Empty tables give no rows. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Verdict, host and path of each rule.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Public suffixes of more than one label; any other host has its last label as suffix.
SUFFIXES = ("example.com", "example.net", "example.org", "co.uk", "com.au", "co.jp")
#: Block if the bad share is over this limit at the bound below.
LIMIT = 0.3
#: Standard deviations between the posterior's mean and its lower bound.
DEVIATIONS = 1.645
#: Least and largest strength of a prior, in labelled pages.
STRENGTHS = (1.0, 1_000_000.0)
UNIT = 1_000_000


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""

    def group(n: int) -> Column:
        found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", n)
        return F.coalesce(found, F.lit(""))

    return F.translate(group(1), ascii_uppercase, ascii_lowercase), group(2)


def _within(host: Column, name: str) -> Column:
    return (host == name) | host.endswith(f".{name}")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES):
    """The longest fitting rule's text and verdict, null if none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, at, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = _within(host, at) & path.startswith(prefix)
        text = F.when(fits, F.lit(at + prefix)).otherwise(text)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return text, verdict


def registered(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """The registered domain and the public suffix of a host, its port set aside."""
    name = F.regexp_replace(host, ":[0-9]*$", "")
    suffix = F.substring_index(name, ".", -1)
    domain = F.substring_index(name, ".", -2)
    for known in suffixes:
        labels = known.count(".") + 1
        inside = _within(name, known)
        suffix = F.when(inside, F.lit(known)).otherwise(suffix)
        domain = F.when(inside, F.substring_index(name, ".", -labels - 1)).otherwise(domain)
    return domain, suffix


def _squares_in_units(n: Column, k: Column) -> Column:
    """k * k / n, at most k, in whole units: in decimals, because the product outgrows 64 bits."""
    product = k.cast("decimal(15,0)") * k.cast("decimal(15,0)") * F.lit(UNIT).cast("decimal(7,0)")
    left = product % n.cast("decimal(15,0)")
    return ((product - left) / n.cast("decimal(15,0)")).cast("decimal(28,0)")


def _strength(level: str, counts: DataFrame) -> DataFrame:
    """One row: the level's prior strength by the method of moments (Kleinman's estimate).

    With p the pooled share, S the weighted squares of the groups' shares about it, and g groups,
    the correlation within groups is (S - pq(g - 1)) / (pq(N - sum n^2 / N - (g - 1))).
    """
    n, k = F.col("n"), F.col("k")
    sums = counts.filter(n > 0).agg(
        F.count(F.lit(1)).alias("g"),
        F.sum(n).alias("total"),
        F.sum(k).alias("bad"),
        F.sum(n.cast("decimal(19,0)") * n).cast("double").alias("squares"),
        F.sum(_squares_in_units(n, k)).alias("kk"),
    )
    total, fewer = F.col("total"), F.col("g") - 1
    p = F.try_divide(F.col("bad"), total)
    spread = F.col("kk").cast("double") / UNIT - p * F.col("bad")
    pq = p * (1 - p)
    between = total - F.try_divide(F.col("squares"), total) - fewer
    inner = F.try_divide(spread - pq * fewer, pq * between)
    low, high = STRENGTHS
    strength = F.when(
        inner > 0, F.greatest(F.lit(low), F.least(F.lit(high), F.try_divide(1 - inner, inner)))
    )
    return sums.select(
        F.lit(level).alias("level"),
        F.coalesce(strength, F.lit(high)).alias("strength"),
        F.coalesce(p, F.lit(0.0)).alias("share"),
    )


def reputation(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Posterior of every host of ``pages`` (page_id, host) under ``labels`` (page_id, bad).

    Columns: host, n and k (labelled and bad pages), mean and ``bound``, the posterior's lower
    bound.
    """
    bad = (
        labels.filter("page_id is not null and bad is not null")
        .groupBy("page_id")
        .agg(F.max(F.col("bad").cast("int")).alias("bad"))
    )
    domain, suffix = registered(F.col("host"))
    hosts = (
        pages.join(bad, "page_id", "left")
        .groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
        .withColumns({"domain": domain, "suffix": suffix})
    )
    n_and_k = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("domain", "suffix").agg(*n_and_k)
    suffixes = domains.groupBy("suffix").agg(*n_and_k)
    levels = {"host": hosts, "domain": domains, "suffix": suffixes}

    def judged(level: str, counts: DataFrame, mean_above: Column) -> DataFrame:
        prior = _strength(level, levels[level])
        # One row by construction: an aggregate without grouping.
        at = counts.withColumn("level", F.lit(level)).join(F.broadcast(prior), "level", "left")
        a = F.col("strength") * mean_above + F.col("k")
        b = F.col("strength") * (1 - mean_above) + F.col("n") - F.col("k")
        return at.withColumns({"a": a, "b": b}).withColumn("mean", F.col("a") / (a + b))

    by_suffix = judged("suffix", suffixes, F.col("share")).select(
        "suffix", F.col("mean").alias("suffix_mean")
    )
    by_domain = judged(
        "domain", domains.join(by_suffix, "suffix", "left"), F.col("suffix_mean")
    ).select("domain", "suffix", F.col("mean").alias("domain_mean"))
    by_host = judged(
        "host", hosts.join(by_domain, ["domain", "suffix"], "left"), F.col("domain_mean")
    )
    a, b = F.col("a"), F.col("b")
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return by_host.select(
        "host", "n", "k", "mean", (F.col("mean") - DEVIATIONS * deviation).alias("bound")
    )


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict of every page, with the bound of its host.

    The join by host meets hot hosts: its sides come from plain exchanges, so adaptive execution
    splits them.
    """
    host, path = split_url(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    known = reputation(split.select("page_id", "host"), labels).select("host", "bound")
    by_bound = F.when(F.col("bound") > LIMIT, F.lit("block")).otherwise(F.lit("allow"))
    return (
        split.withColumns({"rule": rule, "by_rule": verdict})
        .join(known, "host", "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("by_rule", by_bound).alias("verdict"),
            "bound",
        )
    )
