"""URL filters: rules by host and path, and an empirical-Bayes reputation of hosts for the rest.

Labelled pages are good or bad. The bad rate of a host is shrunk towards that of its registered domain, that
towards its suffix, and that towards the rate of all: each level is a beta-binomial whose prior mean is
the level above and whose prior strength is estimated from the spread of all groups of the level
(method of moments). The uncertainty of the level above is passed on. A page is blocked if even the lower bound of its
host's posterior bad rate exceeds ``block_above``. A host without labels inherits the prior.

A NULL url, or one without ``://``, has empty host and path; it fits no rule and is judged by the overall rate.
Repeated pages get equal verdicts; an empty table gives none. Without labels everything is allowed that no rule blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules, as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BLOCK_ABOVE = 0.5
Z = 1.6448536269514722  # of a one-sided bound of 95 %
STRENGTHS = (1.0, 1000.0)  # a prior counts as at least and at most so many labelled pages
PAIRED_SUFFIX = r"(?:^|\.)((?:co|com|org|net|gov|ac|edu)\.[a-z]{2})$"  # suffixes of two labels
LEVELS = ("suffix", "domain", "host")


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add host and path, by plain search for the signs that end them."""
    rest = F.when(F.locate("://", F.col(url)) > 0, F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract("_rest", r"^([^/?#]*)", 1)
    path = F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.withColumn("_rest", F.coalesce(rest, F.lit(""))).withColumns({"host": lowered, "path": path}).drop("_rest")


def hierarchy(host: Column) -> dict[str, Column]:
    """The suffix and the registered domain of a host, port and user name left out."""
    plain = F.regexp_replace(host, r"^[^@]*@|:[0-9]*$", "")
    paired = F.regexp_extract(plain, PAIRED_SUFFIX, 1)
    suffix = F.when(paired != "", paired).otherwise(F.substring_index(plain, ".", -1))
    domain = F.when(paired != "", F.substring_index(plain, ".", -3)).otherwise(F.substring_index(plain, ".", -2))
    return {"suffix": suffix, "domain": domain}


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both NULL without one."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in reversed(ordered):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _strength(groups: DataFrame, mean: Column) -> Column:
    """The prior strength of a level from the spread of its groups (n, bad) around their prior means: with
    correlation rho of pages of a group, n * (rate - mean)^2 / (mean * (1 - mean)) is 1 + (n - 1) * rho on average."""
    spread = F.col("n") * F.pow(F.col("bad") / F.col("n") - mean, 2) / (mean * (1 - mean))
    inside = (mean > 0) & (mean < 1)
    rho = F.try_divide(F.sum(F.when(inside, spread - 1)), F.sum(F.when(inside, F.col("n") - 1)))
    rho = F.coalesce(F.least(F.greatest(rho, F.lit(1 / (STRENGTHS[1] + 1))), F.lit(1 / (STRENGTHS[0] + 1))), F.lit(1 / (STRENGTHS[1] + 1)))
    return 1 / rho - 1


def host_reputation(labelled: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, float]:
    """Posteriors by host, domain and suffix, each with (key, mean, variance, bound), and the overall bad rate.

    ``labelled`` has host and bad (0 or 1). Only one row of figures per level reaches the driver.
    """
    hosts = labelled.withColumns(hierarchy(F.col("host"))).groupBy(*LEVELS).agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = float(total["bad"]) / total["n"] if total["n"] else 0.0
    found = []
    parent: DataFrame | None = None
    for i, level in enumerate(LEVELS):
        groups = hosts.groupBy(*LEVELS[: i + 1]).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        if parent is None:
            doubt = overall * (1 - overall) / ((total["n"] or 0) + 1)
            groups = groups.withColumns({"prior": F.lit(overall), "doubt": F.lit(doubt)})
        else:
            above = parent.select(LEVELS[i - 1], F.col("mean").alias("prior"), F.col("variance").alias("doubt"))
            groups = groups.join(above, LEVELS[i - 1])
        strength = groups.agg(_strength(groups, F.col("prior")).alias("k")).first()["k"]
        a = F.lit(strength) * F.col("prior") + F.col("bad")
        size = F.lit(strength) + F.col("n")
        mean = a / size
        variance = mean * (1 - mean) / (size + 1) + F.pow(F.lit(strength) / size, 2) * F.col("doubt")
        bound = mean - F.lit(Z) * F.sqrt(variance)
        parent = groups.select(level, mean.alias("mean"), variance.alias("variance"), bound.alias("bound"))
        found.append(parent)
    suffixes, domains, by_host = found
    return by_host, domains, suffixes, overall


def judge(
    pages: DataFrame,
    labelled: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    block_above: float = BLOCK_ABOVE,
) -> DataFrame:
    """Add host, path, rule, bad_rate, bad_bound and verdict to every row of ``pages``, in place of columns of these names.

    ``labelled`` has (host, bad). A page takes the posterior of the nearest level that has labels. A host's pages need not meet in
    one task: Spark splits the large side of these joins.
    """
    by_host, domains, suffixes, overall = host_reputation(labelled)
    parts = with_parts(pages, url)
    rows = parts.withColumns({f"_{k}": v for k, v in (hierarchy(F.col("host")) | {"host": F.col("host")}).items()})
    for level, table in zip(reversed(LEVELS), (by_host, domains, suffixes)):
        lookup = table.select(*(F.col(c).alias(f"_{level}_{c}") for c in (level, "mean", "bound")))
        rows = rows.join(lookup, F.col(f"_{level}") == F.col(f"_{level}_{level}"), "left")
    nearest = lambda c: F.coalesce(*(F.col(f"_{level}_{c}") for level in reversed(LEVELS)), F.lit(overall))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    by_method = F.when(nearest("bound") > block_above, F.lit("block")).otherwise(F.lit("allow"))
    added = {"bad_rate": nearest("mean"), "bad_bound": nearest("bound"), "rule": rule, "verdict": F.coalesce(verdict, by_method)}
    kept = [c for c in pages.columns if c.lower() not in {"host", "path", *added}]
    return rows.withColumns(added).select(*kept, "host", "path", *added)


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) of the pages whose document is labelled. The number in a page's path is that of its document; a document
    is bad if any of its labels says low quality or toxic."""
    bad = ((F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)).cast("int")
    outcome = labels.groupBy(F.col("doc_id").cast("string").alias("_doc")).agg(F.max(bad).alias("bad"))
    number = F.regexp_extract("path", r"/([0-9]+)", 1)
    return with_parts(pages.select("url")).withColumn("_doc", number).join(outcome, "_doc").select("host", "bad")


def page_verdicts(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The verdict on every row of ``pages``."""
    judged = judge(pages.select("page_id", "url"), page_outcomes(pages, labels))
    figures = (F.round(c, 6).alias(c) for c in ("bad_rate", "bad_bound"))
    return judged.select("page_id", "host", "path", "rule", "verdict", *figures)
