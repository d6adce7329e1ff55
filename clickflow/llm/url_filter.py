"""URL filtering by rules, and by empirical-Bayes host reputation where no rule fits.

A rule (host, path) fits its host and all subdomains where the url's path starts with the rule's; the
longest host, then the longest path, wins. The rules also give the labelled outcomes from which
reputations are learnt (any table of outcomes can be given instead): a page that a rule covers has its
verdict, and a page of a block rule's host outside the rule's path is one that the rule found no fault with,
so blocking a path speaks against the rest of its host only as far as the path is most of it.

Reputation. Labelled outcomes are counted per host, registered domain and suffix. Each level's counts
are beta-binomial with a mean from the level above: a host's prior mean is its domain's posterior mean,
a domain's its suffix's, a suffix's the overall one; the prior's strength of each level is estimated
from how much the rates at that level scatter around their parents' (method of moments). A host's
posterior is a beta distribution; the host is blocked where the lower bound of its rate of blocked
pages, Z standard deviations below the mean, is over BLOCK_RATE. Hosts without any outcome inherit
their domain's, domains their suffix's.

Counting combines on the map side; what is joined to the pages is one row per host of the pages that
no rule covers, and AQE splits a host that holds much of them. Only four sums per level reach the
driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import columns_but, written

#: (host, path, verdict): fixed values of the query's contract.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
BLOCK_RATE, Z = 0.5, 1.0
LEVELS = ("suffix", "domain", "host")
#: Public suffixes of two labels; a registered domain is one label more than its suffix.
SUFFIXES = ["ac.jp", "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br",
            "com.cn", "com.mx", "com.sg", "com.tr", "com.tw", "gov.au", "gov.uk", "net.au", "or.jp", "org.au", "org.uk"]
LEAST_STRENGTH, MOST_STRENGTH = 0.5, 1000.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (host and path of the winning rule, joined; else null) and
    rule_verdict. Columns named like these or like ``judged``'s results are replaced."""
    out = pages.select(*columns_but(pages, "host", "path", "rule", "rule_verdict", "verdict", "reputation",
                                    "__host", "__mean", "__verdict"),
                       host_of(F.col(f"`{url_col}`")).alias("host"), path_of(F.col(f"`{url_col}`")).alias("path"))
    rule = verdict = None
    for host, path, kind in sorted(rules, key=lambda r: (-len(r[0]), -len(r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name = F.lit(host + path)
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return out.withColumns({"rule": none if rule is None else rule, "rule_verdict": none if verdict is None else verdict})


def _levels(host: Column) -> dict[str, Column]:
    """Suffix: the last label, or one of SUFFIXES; registered domain: one label more."""
    two = F.substring_index(host, ".", -2)
    return {"suffix": F.when(two.isin(SUFFIXES), two).otherwise(F.substring_index(host, ".", -1)),
            "domain": F.when(two.isin(SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two), "host": host}


def reputations(outcomes: DataFrame) -> tuple[dict[str, DataFrame], float]:
    """Per level a table (its key, mean, strength) of posteriors from ``outcomes`` (host, bad: 0 or 1;
    nulls do not count), and the overall mean: 0.5 without outcomes."""
    counts = outcomes.where("host IS NOT NULL AND bad IS NOT NULL").groupBy("host").agg(
        F.sum(F.col("bad").cast("double")).alias("k"), F.count("*").cast("double").alias("n"))
    counts = written(counts.withColumns({k: v for k, v in _levels(F.col("host")).items() if k != "host"}), "outcomes")
    total = counts.agg(F.sum("k"), F.sum("n")).first()
    overall = (total[0] + 0.5) / (total[1] + 1) if total[1] else 0.5
    found: dict[str, DataFrame] = {}
    above = None
    for i, level in enumerate(LEVELS):
        keys = LEVELS[:i + 1]
        here = counts.groupBy(*keys).agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
        if above is None:
            here = here.withColumn("prior", F.lit(overall))
        else:
            here = here.join(above.select(LEVELS[i - 1], F.col("mean").alias("prior")), LEVELS[i - 1])
        strength = _strength(here)
        above = found[level] = written(here.select(
            level, ((F.col("k") + F.col("prior") * strength) / (F.col("n") + strength)).alias("mean"),
            (F.col("n") + strength).alias("strength")), f"reputation-{level}")
    return found, overall


def _strength(counts: DataFrame) -> float:
    """Prior strength s such that the scatter of k around n * prior is that of beta-binomial counts:
    variance n p (1 - p) (n + s) / (1 + s)."""
    p, n = F.col("prior"), F.col("n")
    row = counts.agg(F.sum((F.col("k") - n * p) ** 2), F.sum(n * p * (1 - p)), F.sum(n * n * p * (1 - p))).first()
    if not row[1]:
        return LEAST_STRENGTH
    scatter, binomial, most = row
    s = (most - scatter) / (scatter - binomial) if scatter > binomial else MOST_STRENGTH
    return float(min(max(s, LEAST_STRENGTH), MOST_STRENGTH))


def judged(pages: DataFrame, outcomes: DataFrame | None = None, rules: list[tuple[str, str, str]] = RULES,
           url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict (allow or block) and reputation (the posterior rate of
    blocked pages behind a verdict that no rule gave; null where one did). ``outcomes`` (host, bad);
    by default what the rules say of ``pages`` (their verdicts, and pages beside a block rule's path as good). A null url, or one without ``://``, has the empty
    host, judged like any other; repeated rows are judged alike; an empty table stays empty."""
    ruled = with_rule(pages, rules, url_col)
    if outcomes is None:
        beside = F.lit(False)
        for host, _, kind in rules:
            if kind == "block":
                beside |= (F.col("host") == host) | F.col("host").endswith("." + host)
        outcomes = ruled.where(F.col("rule_verdict").isNotNull() | beside).select(
            "host", F.coalesce(F.col("rule_verdict") == "block", F.lit(False)).cast("int").alias("bad"))
    tables, overall = reputations(outcomes)
    hosts = ruled.where("rule IS NULL").select("host").distinct()
    hosts = hosts.withColumns({f"__{k}": v for k, v in _levels(F.col("host")).items()})
    for level in LEVELS:
        t = tables[level].select(F.col(level).alias(f"__{level}"), F.struct("mean", "strength").alias(f"__{level}_p"))
        hosts = hosts.join(t, f"__{level}", "left")
    none = F.struct(F.lit(overall).alias("mean"), F.lit(LEAST_STRENGTH).alias("strength"))
    best = F.coalesce("__host_p", "__domain_p", "__suffix_p", none)
    bound = best["mean"] - Z * F.sqrt(best["mean"] * (1 - best["mean"]) / (best["strength"] + 1))
    verdicts = written(hosts.select(F.col("host").alias("__host"), best["mean"].alias("__mean"),
                                    F.when(bound > BLOCK_RATE, "block").otherwise("allow").alias("__verdict")), "hosts")
    joined = ruled.join(verdicts, F.col("rule").isNull() & (F.col("host") == F.col("__host")), "left")
    return joined.withColumns({
        "verdict": F.coalesce("rule_verdict", "__verdict", F.lit("allow")), "reputation": F.col("__mean"),
    }).drop("rule_verdict", "__host", "__mean", "__verdict")


def digest(pages: DataFrame) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict."""
    return judged(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")
