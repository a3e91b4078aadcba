"""URL filter: rules first, then the reputation of the host by empirical Bayes, in DataFrame functions only.

Labelled pages are counted by host. Each level has a beta prior around the posterior mean of the level above: all
pages, suffix (last label of the host), registered domain (last two labels), host. How strong the prior of a level is comes
from the data: the spread of its members' rates beyond what binomial chance explains (the beta-binomial correlation by
moments, weighted by counts). A host without labels has the mean of its domain. A page is blocked when even the upper
posterior bound of its host's rate of good pages is below ``threshold``.

Counting combines on the map side, so a host with a third of all pages is one row per task; the joins back are
plain and adaptive execution splits hot hosts.

A url that is null or has no ``://`` has an empty host and path, and its reputation is that of the empty host. Several
labels of a page all count. Labels that are null don't. Repeated pages count and come out as often as they are there. Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Host, path and verdict of the rules.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _rule(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits, as (name, verdict), or null."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("name"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _strength(counts: DataFrame) -> DataFrame:
    """One row: how many observations the prior of a level is worth, from its members' counts (n, good).

    With rates r, mean p, N observations and G members: the weighted square sum S = sum n (r - p)^2 has the
    expectation p (1 - p) ((G - 1) + rho (N - sum n^2 / N - (G - 1))). Only sums of integers and of good^2 / n are
    needed, so one aggregation does it.
    """
    sums = counts.where("n > 0").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("a"),
        F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("k"),
        F.count(F.lit(1)).cast("double").alias("g"),
        F.coalesce(F.sum(F.col("good") * F.col("good") / F.col("n")), F.lit(0.0)).alias("r"),
        F.coalesce(F.sum(F.col("n") * F.col("n")), F.lit(0)).cast("double").alias("q"),
    )
    return sums.selectExpr("*", "CASE WHEN a > 0 THEN k / a ELSE 0.5 END AS p").selectExpr(
        "CASE WHEN a > 0 AND p > 0 AND p < 1 AND a - q / a - (g - 1) > 0 THEN "
        "least(greatest((r - a * p * p - p * (1 - p) * (g - 1)) / (p * (1 - p) * (a - q / a - (g - 1))), 0.001), 0.5) "
        "ELSE 0.001 END AS rho"
    ).selectExpr("1 / rho - 1 AS strength")


def _summed(counts: DataFrame, *keys: str) -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))


def _posterior(counts: DataFrame, above: DataFrame, on: str | None) -> DataFrame:
    """``counts`` with the posterior weight and mean of each member; the prior mean is that of the level above."""
    prior = above.select(*([on] if on else []), F.col("mean").alias("prior"))
    joined = counts.join(prior, on) if on else counts.join(F.broadcast(prior))  # one row
    joined = joined.join(F.broadcast(_strength(counts)))  # one row
    return joined.selectExpr(
        *counts.columns, "strength + n AS weight", "(strength * prior + good) / (strength + n) AS mean"
    )


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """(host, n, good, mean, lower, upper) for every host of ``pages`` (page_id, host); ``outcomes`` is (page_id, good 0/1)."""
    own = outcomes.where("good IS NOT NULL").groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("long")).alias("good")
    )
    labelled = pages.join(own, "page_id", "left")
    bare = F.regexp_replace("host", r":[0-9]*$", "")
    label = F.split(bare, r"\.")
    hosts = (
        labelled.groupBy("host")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
        .withColumn("suffix", F.element_at(label, -1))
        .withColumn("domain", F.substring_index(bare, ".", -2))
    )
    domains = _summed(hosts, "domain", "suffix")
    suffixes = _summed(domains, "suffix")
    top = suffixes.agg(
        F.when(F.sum("n") > 0, F.sum("good") / F.sum("n")).otherwise(F.lit(0.5)).alias("mean")
    )
    by_suffix = _posterior(suffixes, top, None)
    by_domain = _posterior(domains, by_suffix, "suffix")
    by_host = _posterior(hosts, by_domain, "domain")
    half = F.lit(z) * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return by_host.select(
        "host", "n", "good", "mean",
        F.greatest(F.col("mean") - half, F.lit(0.0)).alias("lower"),
        F.least(F.col("mean") + half, F.lit(1.0)).alias("upper"),
    )


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, rules=RULES, threshold: float = 0.5, z: float = 1.645,
    id_column: str = "page_id", url_column: str = "url",
) -> DataFrame:
    """(id, host, path, rule, verdict, mean, upper) of each page; rules win over reputation."""
    host, path = host_and_path(F.col("url"))
    own = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url")).select(
        "page_id", host.alias("host"), path.alias("path")
    )
    reputation = host_reputation(own.select("page_id", "host"), outcomes, z)
    judged = own.withColumn("fit", _rule(F.col("host"), F.col("path"), rules)).join(reputation, "host", "left")
    return judged.select(
        F.col("page_id").alias(id_column),
        "host",
        "path",
        F.col("fit.name").alias("rule"),
        F.coalesce("fit.verdict", F.when(F.col("upper") < threshold, "block").otherwise("allow")).alias("verdict"),
        "mean",
        "upper",
    )
