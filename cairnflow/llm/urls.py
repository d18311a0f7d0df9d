"""URL filter: explicit rules, then empirical-Bayes host reputation. Built-in functions only.

Labelled page outcomes (good or bad) are counted by host, registered domain and public suffix. Each
level's bad rate has a beta prior around its parent's posterior mean; the prior's weight is fitted to the
spread between the units of that level by moments. A host is blocked when the lower posterior bound of
its bad rate is above a threshold, so a few bad pages on a little-known host do not condemn it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import require, weighted_join, written

#: (action, host, path prefix)
CONTRACT_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Public suffixes beyond the last label, in the notation of the public suffix list: plain, ``*.`` wildcards and
#: ``!`` exceptions. A few only; a caller passes the lines of the whole list.
SUFFIX_RULES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.za")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def site_of(host: Column) -> Column:
    """A host without user and port."""
    return F.regexp_replace(F.substring_index(host, "@", -1), r":[0-9]*$", "")


def domain_and_suffix(host: Column, rules: Sequence[str] = SUFFIX_RULES) -> Column:
    """struct(domain, suffix): registered domain and public suffix of a host.

    The longest fitting rule tells the suffix, an exception before all, and without one it is the last label. The
    domain has one label more; a host that is a suffix itself, or an address in numbers, is its own domain, the
    latter with an empty suffix. Lines of the list that are comments or blank are left out.
    """
    lines = [r.strip().lower() for r in rules]
    table = F.array(*(F.lit(r) for r in lines if r and not r.startswith("//"))).cast("array<string>")
    site = site_of(host)
    labels = F.split(site, r"\.")
    size = F.size(labels)
    tail = lambda k: F.array_join(F.slice(labels, size - k + 1, k), ".")
    lengths = F.sequence(F.lit(1), size)
    exception = F.filter(lengths, lambda k: F.array_contains(table, F.concat(F.lit("!"), tail(k))))
    fits = lambda k: F.array_contains(table, tail(k)) | ((k > 1) & F.array_contains(table, F.concat(F.lit("*."), tail(F.greatest(k - 1, F.lit(1))))))
    found = F.coalesce(F.array_max(exception) - 1, F.array_max(F.filter(lengths, fits)), F.lit(1))
    number = site.rlike(r"^([0-9]+\.){3}[0-9]+$|^\[.*\]$|^$")
    domain = F.when(number, site).otherwise(tail(F.least(found + 1, size)))
    suffix = F.when(number, "").otherwise(F.when(found < size, tail(F.least(found, size))).otherwise(F.regexp_extract(site, r"(?s)^[^.]*\.?(.*)$", 1)))
    return F.struct(domain.alias("domain"), suffix.alias("suffix"))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, action) of the longest rule that fits the host or a parent of it and begins the path.

    Length is that of host plus path prefix, ties go to the rule named first. Null if none fits.
    """
    ranked = sorted(range(len(rules)), key=lambda k: (-len(rules[k][1] + rules[k][2]), k))
    out = F
    for action, h, p in (rules[k] for k in ranked):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = out.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("action")))
    return F.lit(None).cast("struct<rule:string,action:string>") if out is F else out


def matched_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """place, rule, action: of every place (host, path) that a rule fits, the longest rule; for rules by the million.

    rules: host, path, action. A place looks only for the hosts above it, and only for prefixes as long as a rule of that
    host has: by equality, with counts, so that a host with half of all pages is no task of its own. Of rules of one
    length the smallest (host, path, action) holds. Rules with a null are left out.
    """
    rules = rules.select("host", "path", "action").dropna().distinct()
    lengths = rules.groupBy("host").agg(F.collect_set(F.char_length("path")).alias("lengths"))
    dots = F.split("place.host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(dots)), lambda k: F.array_join(F.slice(dots, k, F.size(dots)), "."))
    asked = places.select("place", F.explode(above).alias("host"))
    asked = written(asked.join(F.broadcast(lengths.select("host")), "host", "left_semi") if rules.count() <= 50_000 else asked, "asked_hosts")
    known = asked.groupBy("host").agg(F.count("*").alias("asked")).join(lengths, "host")
    probes = weighted_join(asked, known, "host", "asked", "inner").select("place", "host", F.explode("lengths").alias("n")).filter(F.col("n") <= F.char_length("place.path"))
    probes = written(probes.select("place", F.struct("host", F.substr(F.col("place.path"), F.lit(1), F.col("n")).alias("path")).alias("rule")), "asked_rules")
    held = rules.groupBy(F.struct("host", "path").alias("rule")).agg(F.min("action").alias("action"))
    held = probes.groupBy("rule").agg(F.count("*").alias("asked")).join(held, "rule")
    fits = weighted_join(probes, held, "rule", "asked", "inner")
    named = F.struct((-F.char_length(F.concat("rule.host", "rule.path"))).alias("n"), "rule", "action")
    best = fits.groupBy("place").agg(F.min(named).alias("best"))
    return best.select("place", F.struct(F.concat("best.rule.host", "best.rule.path").alias("rule"), "best.action").alias("__r"))


def _prior_weight(level: DataFrame, n: str, bad: str, mean: str) -> DataFrame:
    """One row: the beta prior's weight by moments over units with at least two outcomes, within 1 and 10000."""
    p, w = F.col(bad) / F.col(n), F.col(n)
    spread = F.sum(w * (p - F.col(mean)) * (p - F.col(mean))) / F.sum(w)
    noise = F.avg(F.col(mean) * (1 - F.col(mean)))
    size = F.sum(w) / F.count("*")
    # Var(p) = noise / size + noise / (weight + 1) * (1 - 1 / size), solved for weight.
    between = F.greatest(spread - noise / size, F.lit(1e-9))
    weight = F.least(F.greatest(noise * (1 - 1 / size) / between - 1, F.lit(1.0)), F.lit(10000.0))
    return level.filter(w >= 2).agg(F.coalesce(F.when(size > 1, weight), F.lit(10.0)).alias("weight"))


def reputation(outcomes: DataFrame, z: float = 1.645, suffix_rules: Sequence[str] = SUFFIX_RULES) -> DataFrame:
    """outcomes: host, bad (0 or 1) -> host, n, bad, rate (posterior mean), lower (posterior bound).

    Rows with a null host or outcome are left out. Outcomes are summed by host before anything is joined, so a
    host with a third of all pages costs as much as any other; the sums are written once, and a suffix or domain
    with a third of all hosts does not gather them in one task. The bound is mean minus ``z`` standard deviations
    of the beta posterior. Without outcomes there are no rows.
    """
    hosts = outcomes.filter("host IS NOT NULL AND bad IS NOT NULL").groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").cast("long").alias("b"))
    hosts = written(hosts.withColumn("__d", domain_and_suffix(F.col("host"), suffix_rules)).select("host", "n", "b", "__d.domain", "__d.suffix"), "hosts")
    domains = written(hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("dn"), F.sum("b").alias("db"), F.count("*").alias("hosts")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("db").alias("sb"), F.count("*").alias("domains"))
    total = suffixes.agg((F.sum("sb") / F.sum("sn")).alias("mean"))
    # Each of these has one row: the broadcast is bounded.
    suffixes = suffixes.join(F.broadcast(total))
    suffixes = suffixes.join(F.broadcast(_prior_weight(suffixes, "sn", "sb", "mean")))
    suffixes = written(suffixes.select("suffix", "domains", ((F.col("sb") + F.col("weight") * F.col("mean")) / (F.col("sn") + F.col("weight"))).alias("mean")), "suffix_rates")
    domains = written(weighted_join(domains, suffixes, "suffix", "domains", "inner").drop("domains"), "domains")
    domains = domains.join(F.broadcast(_prior_weight(domains, "dn", "db", "mean")))
    # A domain under two suffixes cannot be: the suffix is part of it.
    domains = written(domains.select("domain", "hosts", ((F.col("db") + F.col("weight") * F.col("mean")) / (F.col("dn") + F.col("weight"))).alias("mean")), "domain_rates")
    hosts = written(weighted_join(hosts, domains, "domain", "hosts", "inner").select("host", "n", "b", "mean"), "hosts")
    hosts = hosts.join(F.broadcast(_prior_weight(hosts, "n", "b", "mean")))
    a, b = F.col("weight") * F.col("mean") + F.col("b"), F.col("weight") * (1 - F.col("mean")) + F.col("n") - F.col("b")
    rate = a / (a + b)
    return hosts.select("host", "n", F.col("b").alias("bad"), rate.alias("rate"), (rate - z * F.sqrt(rate * (1 - rate) / (a + b + 1))).alias("lower"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = CONTRACT_RULES, threshold: float = 0.5, z: float = 1.645, suffix_rules: Sequence[str] = SUFFIX_RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, lower for every page.

    pages: page_id, url; outcomes: page_id, bad; other columns are left aside. ``rules`` are a few triples (action,
    host, path prefix), or any number as a table with host, path and action. The longest fitting rule decides; without one a page is blocked if its host's lower bound exceeds ``threshold``. A null or odd
    url has empty host and path, no reputation, and is allowed; so is a host without outcomes. Repeated
    pages are judged alike; several outcomes of a page all count.
    """
    pages = require(pages, ["page_id", "url"], "judge_urls")
    outcomes = require(outcomes, ["page_id", "bad"], "judge_urls")
    url = F.col("url")
    placed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    labelled = placed.select("page_id", "host").distinct().join(outcomes, "page_id").filter("host <> ''")
    known = reputation(labelled.select("host", "bad"), z, suffix_rules).select("host", "lower")
    pages_of = placed.groupBy("host").agg(F.count("*").alias("__pages"))
    known = written(known.join(pages_of, "host"), "reputation")
    if isinstance(rules, DataFrame):
        placed = placed.withColumn("place", F.struct("host", "path"))
        places = placed.groupBy("place").agg(F.count("*").alias("__pages"))
        found = matched_rules(places, rules).join(places, "place")
        ruled = weighted_join(placed, written(found, "place_rules"), "place", "__pages").drop("__pages")
    else:
        ruled = placed.withColumn("__r", longest_rule(F.col("host"), F.col("path"), rules))
    judged = weighted_join(ruled, known, "host", "__pages")
    by_host = F.when(F.coalesce(F.col("lower") > threshold, F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", F.col("__r.rule").alias("rule"), F.coalesce(F.col("__r.action"), by_host).alias("verdict"), "lower")
