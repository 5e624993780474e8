"""URL filter: rules first, then an empirical-Bayes reputation of the host.

A page with a labelled outcome (bad or not) is evidence on its host.  Hosts with few
outcomes borrow from their registered domain, domains from their suffix, suffixes from the
whole table: each level has a beta prior whose mean is its parent's posterior mean and
whose weight is estimated from the spread of all groups of that level (beta-binomial
moments).  A host is blocked when the lower bound of its posterior bad rate is above a
threshold.  A host without outcomes has its domain's mean under the prior's own spread, so
it is judged by its relatives, and passes where they say nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import stored

RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.expr("substring(__url, instr(__url, '://') + 3)")
    return _with(url, F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER))


def path_of(url: Column) -> Column:
    rest = F.expr("substring(__url, instr(__url, '://') + 3)")
    return _with(url, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def _with(url: Column, value: Column) -> Column:
    """``value`` over the column __url; empty for null and for urls without ``://``."""
    return F.when(F.coalesce(F.instr(F.col("__url"), "://"), F.lit(0)) > 0, value).otherwise("")


def located(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with columns host and path."""
    named = pages.withColumn("__url", F.col(url))
    here = F.col("__url")
    return named.withColumns({"__host": host_of(here), "__path": path_of(here)}).drop(
        "host", "path", "__url"
    ).withColumnsRenamed({"__host": "host", "__path": "path"})


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits (of equal ones the first), or null."""
    fits = []
    for _, rule in sorted(rules, key=lambda r: -len(r[1])):
        domain, slash, rest = rule.partition("/")
        on_host = (host == domain) | host.endswith("." + domain)
        fits.append(F.when(on_host & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def verdict_of(rule: Column, rules: Sequence[tuple[str, str]]) -> Column:
    first = {}
    for verdict, text in rules:
        first.setdefault(text, verdict)
    out = F.lit(None).cast("string")
    for text, verdict in first.items():
        out = F.when(rule == text, verdict).otherwise(out)
    return out


def site_of(host: Column, suffixes: Sequence[str]) -> dict[str, Column]:
    """Registered domain and suffix of a host, without port and user part.  ``suffixes``
    names those of more than one label, like co.uk."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    labels = F.split(bare, r"\.", -1)
    two = F.element_at(F.reverse(F.slice(F.reverse(labels), 1, 2)), 1)
    last_two = F.concat_ws(".", F.reverse(F.slice(F.reverse(labels), 1, 2)))
    last_three = F.concat_ws(".", F.reverse(F.slice(F.reverse(labels), 1, 3)))
    long = last_two.isin(*suffixes) if suffixes else F.lit(False)
    suffix = F.when(long, last_two).otherwise(F.element_at(labels, -1))
    return {
        "domain": F.when(two.isNull(), bare).when(long, last_three).otherwise(last_two),
        "suffix": suffix,
    }


def prior_weight(groups: DataFrame) -> float:
    """Weight of the beta prior of a level from its groups (n, bad, parent mean m): the
    spread beyond the binomial one gives the correlation r of outcomes in a group, and
    the weight is 1 / r - 1, kept between 0.01 and 10,000."""
    row = groups.select(
        F.sum(F.pow(F.col("bad") - F.col("n") * F.col("m"), 2)).alias("seen"),
        F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("plain"),
        F.sum(F.col("n") * (F.col("n") - 1) * F.col("m") * (1 - F.col("m"))).alias("extra"),
    ).first()
    if not row.extra:
        return 1.0
    r = (row.seen - row.plain) / row.extra
    return min(1e4, max(1e-2, 1 / r - 1)) if r > 0 else 1e4


def reputations(outcomes: DataFrame, *, z: float = 1.64, suffixes: Sequence[str] = ()) -> DataFrame:
    """One row per host of ``outcomes`` (host, bad 0/1, null for a page without a label): n,
    bad, mean and lower bound of the posterior bad rate.  Outcomes are combined per host before anything else; only
    single rows of sums reach the driver."""
    hosts = stored(
        outcomes.groupBy("host").agg(
            F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
        ).withColumns(site_of(F.col("host"), suffixes))
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = ((total.bad or 0) + 0.5) / ((total.n or 0) + 1.0)

    def sums(*by: str) -> DataFrame:
        return hosts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def posterior(groups: DataFrame) -> tuple[Column, float]:
        weight = prior_weight(groups)
        return (F.col("bad") + weight * F.col("m")) / (F.col("n") + weight), weight

    suffix = sums("suffix").withColumn("m", F.lit(mean))
    suffix = suffix.select("suffix", posterior(suffix)[0].alias("m"))
    domain = sums("suffix", "domain").join(suffix, "suffix")
    domain = domain.select("suffix", "domain", posterior(domain)[0].alias("m"))
    host = hosts.join(domain, ["suffix", "domain"])
    mean_of, weight = posterior(host)
    host = host.withColumn("mean", mean_of)
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + weight + 1))
    return host.select("host", "n", "bad", "mean", (F.col("mean") - z * spread).alias("bound"))


def filter_urls(
    pages: DataFrame,
    *,
    rules: Sequence[tuple[str, str]] = RULES,
    outcomes: DataFrame | None = None,
    max_bad: float = 0.5,
    z: float = 1.64,
    suffixes: Sequence[str] = (),
) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule and verdict.

    ``outcomes`` has host and bad (0/1); without it, the pages that a rule judges are the
    labelled ones.  Verdict: the rule's; else block where the lower posterior bound of the
    host's bad rate is above ``max_bad``, else allow.

    Null urls and urls without ``://`` have an empty host and path, fit no rule, and share
    the reputation of the empty host.  Repeated rows each get a row.  Other columns of
    ``pages`` are dropped.  An empty table gives an empty result.
    """
    here = located(pages.select("page_id", "url"))
    judged = here.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn(
        "verdict", verdict_of(F.col("rule"), rules)
    ).select("page_id", "host", "path", "rule", "verdict")
    by_rule = judged.where("rule is not null")
    if outcomes is None:
        outcomes = judged.select("host", (F.col("verdict") == "block").cast("int").alias("bad"))
    else:
        unlabelled = judged.select("host", F.lit(None).cast("int").alias("bad"))
        outcomes = outcomes.select("host", F.col("bad").cast("int").alias("bad")).unionByName(unlabelled)
    known = reputations(outcomes, z=z, suffixes=suffixes).where(F.col("bound") > max_bad)
    rest = judged.where("rule is null").drop("verdict").join(
        known.select("host", F.lit("block").alias("verdict")), "host", "left"
    )
    return by_rule.unionByName(
        rest.withColumn("verdict", F.coalesce("verdict", F.lit("allow"))).select(judged.columns)
    )
