"""URL filter: fixed rules, and empirical-Bayes reputations of hosts.

Labelled outcomes of pages are counted per host. A host's rate of bad pages has a beta prior whose mean is the posterior mean
of its registered domain; that one's prior comes from its suffix, and that one's from all pages. How strong a prior is, is
estimated from the spread of the rates one level down (method of moments). A host is blocked if the lower bound of its posterior
lies above the rate that is accepted. For reputations a host is its name without user and port. The suffix is its last label, or the last two
where a country's label follows one of SECOND; the registered domain has one label more. Numeric addresses are domains of the suffix "".

Null urls, and urls without ://, have an empty host and path, match no rule and are judged as the host "". Labels without doc_id count for no
page; of several labels of a page the worst counts. Pages with the same or no page_id get a row each, those without have no outcome.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import checkpointed

#: (verdict, host, path): a rule fits its host and all subdomains, if the path starts with the rule's; the longest wins.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
#: Labels under which countries register names.
SECOND = ("ac", "asn", "co", "com", "edu", "gen", "go", "gob", "gouv", "gov", "govt", "ltd", "me", "mil", "ne", "net", "nhs", "nom", "or", "org", "plc", "sch")
ACCEPTED = 0.3
UNLABELLED = 0.05  # the rate of bad pages that is assumed, with the weight of one page, before any label
DEVIATIONS = 1.645
STRENGTH = (2.0, 1000.0)  # bounds of a prior's weight, in pages


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def name_of(host: Column) -> Column:
    """A host without user name and port."""
    return F.regexp_replace(F.regexp_replace(host, r"(?s)\A.*@", ""), r":[0-9]*\z", "")


def with_parents(hosts: DataFrame) -> DataFrame:
    """hosts (name) -> with its registered domain and suffix."""
    second = ", ".join(f"'{x}'" for x in SECOND)
    out = hosts.withColumn("labels", F.split("name", r"\.", -1))
    out = out.withColumn("parts", F.expr(f"if(name RLIKE '^[0-9.]+$', 0, if(size(labels) >= 3 AND length(element_at(labels, -1)) = 2 AND element_at(labels, -2) IN ({second}), 2, 1))"))
    out = out.withColumn("domain", F.expr("if(parts = 0, name, array_join(slice(labels, greatest(1, size(labels) - parts), parts + 1), '.'))"))
    return out.withColumn("suffix", F.expr("if(parts = 0, '', array_join(slice(labels, greatest(1, size(labels) - parts + 1), parts), '.'))")).drop("labels", "parts")


def _strength(row) -> float:
    """The prior's weight that the spread of the groups' rates calls for, by the method of moments."""
    if row is None or not row.n or row.k < 2:
        return STRENGTH[1]
    mean = row.bad / row.n
    between = (row.q - row.n * mean * mean - (row.k - 1) * mean * (1 - mean)) / (row.n - row.n2 / row.n) if row.n > row.n2 / row.n else 0.0
    if between <= 0:
        return STRENGTH[1]
    return min(max(mean * (1 - mean) / between - 1, STRENGTH[0]), STRENGTH[1])


def reputations(outcomes: DataFrame) -> DataFrame:
    """(name, n labelled pages, bad of them), one row per name of a host -> name, n, bad, mean, low, the lower bound of its rate of bad pages."""
    hosts = checkpointed(with_parents(outcomes.select("name", "n", "bad")))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    levels = [x.select(F.lit(level).alias("level"), "n", "bad") for level, x in (("host", hosts), ("domain", domains), ("suffix", suffixes))]
    sums = levels[0].union(levels[1]).union(levels[2]).filter("n > 0").groupBy("level")
    sums = sums.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(F.col("n") * F.col("n")).alias("n2"), F.count("*").alias("k"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("q"))
    found = {row.level: row for row in sums.collect()}
    total = found.get("suffix")
    overall = ((total.bad if total else 0) + UNLABELLED) / ((total.n if total else 0) + 1.0)
    by_suffix, by_domain, by_host = (_strength(found.get(level)) for level in ("suffix", "domain", "host"))
    s = suffixes.select("suffix", ((F.col("bad") + by_suffix * overall) / (F.col("n") + by_suffix)).alias("suffix_mean"))
    d = domains.join(s, "suffix").select("domain", "suffix", ((F.col("bad") + by_domain * F.col("suffix_mean")) / (F.col("n") + by_domain)).alias("domain_mean"))
    a, b = F.col("bad") + by_host * F.col("domain_mean"), F.col("n") - F.col("bad") + by_host * (1 - F.col("domain_mean"))
    mean = a / (a + b)
    return hosts.join(d, ["domain", "suffix"]).select("name", "n", "bad", mean.alias("mean"), (mean - DEVIATIONS * F.sqrt(mean * (1 - mean) / (a + b + 1))).alias("low"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """pages -> page_id, host, path, rule, verdict. A page's outcome is bad if the label of its page_id is toxic or of low quality."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumn("name", name_of(F.col("host")))
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("page_id")).agg(F.max(F.expr("if(toxic = 1 OR quality = 0, 1, 0)")).alias("bad"))
    outcomes = parts.select("page_id", "name").join(known, "page_id", "left").groupBy("name").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    blocked = reputations(outcomes).filter(F.col("low") > ACCEPTED).select("name", F.lit("block").alias("judged"))
    ruled = parts.withColumn("r", rule_for(F.col("host"), F.col("path"), rules)).join(blocked, "name", "left")
    return ruled.select("page_id", "host", "path", "r.rule", F.coalesce("r.verdict", "judged", F.lit("allow")).alias("verdict"))
