"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes are counted for hosts and summed for their registered
domains and suffixes.  Each level's posterior mean is the prior mean of the
level below: suffix, registered domain, host.  The prior's strength, in
outcomes, is fitted by moments: how much more the children's shares of good
pages vary than binomial draws would, for each parent with ``MIN_CHILDREN``
labelled children or more, and over all parents of the level for the others.
Where no variance can be told (one child, one outcome a child, all outcomes
alike) the strength is ``strength``; a variance at or under the binomial one
gives the greatest strength.  A host is blocked when a lower bound of its
posterior share of good pages (mean less ``z`` standard deviations) stays
under ``floor``.  Explicit rules come first; the longest that fits wins.

Everything is DataFrame work: labels are joined by page id, counts are
combined before they are shuffled, and the one wide join (pages by host) is a
plain equi-join that adaptive execution can split where one host holds a
large share of all pages.

Defined results: a null url or one without ``://`` has empty host and path and
fits no rule; such pages share the empty host.  Repeated pages stay and count
as often.  Outcomes without a page count only in the overall share, null
outcomes nowhere, and repeated outcomes of a page all count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pseudo-outcomes a parent lends its children where the counts cannot tell.
STRENGTH = 20.0

#: Labelled children from which a parent's strength is fitted to them alone.
MIN_CHILDREN = 10

#: The fitted correlation of a parent's outcomes stays between these.
LEAST_RHO, MOST_RHO = 1e-4, 0.5

#: Common public suffixes of two labels (the default of a parameter).
SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp",
            "co.in", "co.za", "com.br", "com.cn", "com.mx", "com.tr", "github.io", "blogspot.com")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule ``host/path`` that fits (struct rule, verdict), or null."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, _, rest = rule.partition("/")
        fits = (((host == rule_host) | host.endswith("." + rule_host))
                & path.startswith("/" + rest))
        best = F.when(fits, F.struct(F.lit(rule).alias("rule"),
                                     F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def registered_domain(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> tuple[Column, Column]:
    """A host's registered domain and suffix: one label before the suffix, of
    two labels where ``suffixes`` holds it.  Ports are left out; an address in
    numbers or brackets is its own domain and suffix."""
    name = F.regexp_replace(host, r":[0-9]*$", "")
    address = name.rlike(r"^[0-9.]+$") | name.startswith("[")
    two = F.substring_index(name, ".", -2).isin(*suffixes)
    domain = F.when(two, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))
    suffix = F.when(two, F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1))
    return F.when(address, name).otherwise(domain), F.when(address, name).otherwise(suffix)


def fitted_strength(s: Column, w: Column, v: Column, strength: Column) -> Column:
    """The strength from the weighted squares ``s`` of the children's shares
    about their parent's, what binomial draws would give (``w``) and what one
    share for all outcomes of a child would (``v``)."""
    rho = F.least(F.greatest((s - w) / (v - w), F.lit(LEAST_RHO)), F.lit(MOST_RHO))
    return F.when(v - w > 1e-9, 1 / rho - 1).otherwise(strength)


def with_strength(children: DataFrame, parent: list[str], g: str, n: str, strength: float) -> DataFrame:
    """``(*parent, pg, pn, strength)``: the sums of each parent's outcomes and
    the strength of its prior, from the children's good and all outcomes."""
    good, count = F.col(g), F.col(n)
    squares = F.when(count > 0, good * good / count).otherwise(0.0)
    per = children.groupBy(*parent).agg(
        F.sum(good).alias("pg"), F.sum(count).alias("pn"), F.sum(squares).alias("q"),
        F.sum(count * count).alias("n2"), F.count_if(count > 0).alias("k"))
    spread = F.col("pg") * (F.col("pn") - F.col("pg")) / (F.col("pn") * F.col("pn"))
    labelled = F.col("pn") > 0
    per = per.select(*parent, "pg", "pn", "k",
                     F.when(labelled, F.col("q") - F.col("pg") * F.col("pg") / F.col("pn")).otherwise(0.0).alias("s"),
                     F.when(labelled, spread * (F.col("k") - 1)).otherwise(0.0).alias("w"),
                     F.when(labelled, spread * (F.col("pn") - F.col("n2") / F.col("pn"))).otherwise(0.0).alias("v"))
    level = per.agg(fitted_strength(F.sum("s"), F.sum("w"), F.sum("v"), F.lit(strength)))
    own = fitted_strength(F.col("s"), F.col("w"), F.col("v"), F.lit(None).cast("double"))
    return per.select(*parent, "pg", "pn", F.coalesce(F.when(F.col("k") >= MIN_CHILDREN, own),
                                                      level.scalar()).alias("strength"))


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float, strength: float = STRENGTH,
                    suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """``(host, a, b, bound)`` for every host of ``pages(page_id, host)``.

    ``outcomes(page_id, good)`` holds 1 or 0; ``a`` and ``b`` are the
    parameters of the host's Beta posterior.  A host without outcomes has its
    domain's posterior mean, and so on up to the overall share.
    """
    domain, suffix = registered_domain(F.col("host"), suffixes)
    hosts = (pages.join(outcomes, "page_id", "left").groupBy("host")
             .agg(F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("g"),
                  F.count("good").cast("double").alias("n"))
             .withColumn("domain", domain).withColumn("suffix", suffix))
    domains = with_strength(hosts, ["domain", "suffix"], "g", "n", strength).select(
        "domain", "suffix", F.col("pg").alias("dg"), F.col("pn").alias("dn"), F.col("strength").alias("ds"))
    tops = with_strength(domains, ["suffix"], "dg", "dn", strength).select(
        "suffix", F.col("pg").alias("sg"), F.col("pn").alias("sn"), F.col("strength").alias("ss"))
    whole = with_strength(tops, [], "sg", "sn", strength).select("strength")
    overall = outcomes.agg(((F.coalesce(F.sum("good"), F.lit(0)) + 1) / (F.count("good") + 2)))

    def child(mean: Column, s: Column, g: str, n: str) -> Column:
        return (mean * s + F.col(g)) / (F.col(n) + s)

    tops = tops.select("suffix", "ss", child(overall.scalar(), whole.scalar(), "sg", "sn").alias("sm"))
    domains = domains.join(tops, "suffix").select(
        "domain", "suffix", "ds", child(F.col("sm"), F.col("ss"), "dg", "dn").alias("dm"))
    a = F.col("dm") * F.col("ds") + F.col("g")
    b = (1 - F.col("dm")) * F.col("ds") + F.col("n") - F.col("g")
    return (hosts.join(domains, ["domain", "suffix"])
            .select("host", a.alias("a"), b.alias("b"), posterior_bound(a, b, z).alias("bound")))


def posterior_bound(a: Column, b: Column, z: float) -> Column:
    """Mean less ``z`` standard deviations of Beta(a, b)."""
    return a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]],
                floor: float, z: float, strength: float = STRENGTH, id_col: str = "page_id",
                url_col: str = "url") -> DataFrame:
    """``(id, host, path, rule, verdict, bound)`` of every page.

    ``rules`` are ``(verdict, host/path)``; ``outcomes(page_id, good)``.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"),
                        url_path(F.col(url_col)).alias("path"))
    good = outcomes.select("page_id", F.col("good").cast("long").alias("good"))
    bounds = host_reputation(rows.select("page_id", "host"), good, z, strength)
    by_method = F.when(F.col("bound") < floor, "block").otherwise("allow")
    return (rows.join(bounds.select("host", "bound"), "host")
            .withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
            .select(F.col("page_id").alias(id_col), "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce(F.col("fit.verdict"), by_method).alias("verdict"), "bound"))
