"""URL filter by empirical-Bayes host reputation (operator 2).

Method.  Labelled page outcomes (bad or not) are counted per host, registered
domain and suffix.  At each level a beta-binomial prior takes its mean from
the level above, without the child's own outcomes, and its strength from the
overdispersion between the children of that level (Kleinman's moment
estimate): corpus -> suffix -> registered domain -> host.  A host without
labels thus gets its domain's reputation, and so on.  A host is blocked when
the lower bound of its posterior bad rate, ``mean - z * sd``, exceeds
``cutoff``.  Explicit rules come first: a rule ``host/path`` fits its host and
all subdomains if the url's path starts with the rule's path; the longest rule
that fits wins (of equally long ones, a blocking one).

The registered domain is the host's last two labels (three where the last two
are in ``SECOND_LEVEL``), after user info and port are taken off; the suffix
is what follows its first label.  IPv4 hosts and single labels are their own
domain and suffix.

Scale.  Pages are aggregated to hosts before any join; host, domain and
suffix tables join back through ``attach`` (broadcast if counted small, else
salted), so a host with a third of all pages is spread over tasks.  The rule
list is a parameter held in the plan, for lists of up to thousands of rules.

Cases.  Null url or no ``://``: host and path empty, the empty host is judged
like any other.  Outcomes with null ``bad`` or null page are ignored; several
outcomes of a page all count; an outcome counts for every page row with its
page_id.  No outcomes at all: mean 0.5 and wide bounds, nothing is blocked.
Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetline.llm.common import attach, materialize, packed, unpacked

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
#: Two-label public suffixes; extend by parameter.
SECOND_LEVEL = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")
CUTOFF = 0.5
Z = 1.645
#: Prior strengths are kept within these numbers of pseudo-outcomes.
STRENGTH = (1.0, 1000.0)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
                       UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column, second_level: Sequence[str]) -> Column:
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    registered = F.when(two.isin(*second_level), F.substring_index(name, ".", -3)).otherwise(two)
    return F.when(name.rlike(r"^[0-9]+(\.[0-9]+){3}$"), name).otherwise(registered)


def suffix_of(domain: Column) -> Column:
    return F.when(domain.rlike(r"^[0-9]+(\.[0-9]+){3}$"), domain).when(
        F.instr(domain, ".") > 0, F.regexp_replace(domain, r"^[^.]*\.", "")).otherwise(domain)


def strength(level: DataFrame) -> float:
    """Moment estimate of a beta-binomial prior's strength from (n, k) rows."""
    row = level.filter("n > 0").agg(
        F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"), F.sum("k").alias("k"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk")).first()
    if not row["m"] or row["m"] < 2 or row["k"] in (0, row["n"]):
        return STRENGTH[1]
    n, m, p = float(row["n"]), row["m"], row["k"] / row["n"]
    between = row["kk"] - n * p * p
    free = p * (1 - p) * (n - row["nn"] / n - (m - 1))
    rho = (between - p * (1 - p) * (m - 1)) / free if free > 0 else 0.0
    return min(max((1 - rho) / rho, STRENGTH[0]), STRENGTH[1]) if rho > 0 else STRENGTH[1]


def shrunk(k: Column, n: Column, mean: Column, weight: float) -> Column:
    return (mean * F.lit(weight) + k) / (n + F.lit(weight))


def reputations(counts: DataFrame, second_level: Sequence[str] = SECOND_LEVEL,
                z: float = Z) -> DataFrame:
    """(host, bad_mean, bad_lower) from materialised (host, n, k) rows."""
    hosts = materialize(counts.withColumn("domain", domain_of(F.col("host"), second_level))
                        .withColumn("suffix", suffix_of(F.col("domain"))), "hosts")
    domains = materialize(hosts.groupBy("domain", "suffix").agg(
        F.sum("n").alias("n_d"), F.sum("k").alias("k_d")), "domains")
    suffixes = materialize(domains.groupBy("suffix").agg(
        F.sum("n_d").alias("n_s"), F.sum("k_d").alias("k_s")), "suffixes")
    w_host = strength(hosts)
    w_domain = strength(domains.select(F.col("n_d").alias("n"), F.col("k_d").alias("k")))
    w_suffix = strength(suffixes.select(F.col("n_s").alias("n"), F.col("k_s").alias("k")))
    all_n, all_k = suffixes.agg(F.sum("n_s"), F.sum("k_s")).first()
    corpus = (F.lit(float(all_k or 0)) - F.col("k_s") + 1.0) / (
        F.lit(float(all_n or 0)) - F.col("n_s") + 2.0)
    by_domain = attach(domains, suffixes, ["suffix"], F.xxhash64("domain")).select(
        "domain", "n_d", "k_d",
        shrunk(F.col("k_s") - F.col("k_d"), F.col("n_s") - F.col("n_d"), corpus, w_suffix).alias("m_s"))
    by_domain = materialize(by_domain, "domain-priors")
    rows = attach(hosts, by_domain, ["domain"], F.xxhash64("host"))
    prior = shrunk(F.col("k_d") - F.col("k"), F.col("n_d") - F.col("n"), F.col("m_s"), w_domain)
    mean = shrunk(F.col("k"), F.col("n"), F.col("_prior"), w_host)
    rows = rows.withColumn("_prior", prior).withColumn("bad_mean", mean)
    sd = F.sqrt(F.col("bad_mean") * (1 - F.col("bad_mean")) / (F.col("n") + F.lit(w_host + 1.0)))
    return rows.select("host", "bad_mean", (F.col("bad_mean") - F.lit(z) * sd).alias("bad_lower"))


def url_reputation(pages: DataFrame, outcomes: DataFrame,
                   rules: Sequence[tuple[str, str]] = RULES, cutoff: float = CUTOFF,
                   second_level: Sequence[str] = SECOND_LEVEL, z: float = Z) -> DataFrame:
    """All rows of ``pages`` with host, path, rule, verdict and the host's
    posterior.  ``outcomes``: (page_id, bad boolean)."""
    rows = packed(pages).select(
        "*", host_of(F.col("in_url")).alias("host"), path_of(F.col("in_url")).alias("path"))
    per_page = (outcomes.filter("page_id is not null and bad is not null").groupBy("page_id")
                .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("k")))
    counts = (rows.select(F.col("in_page_id").alias("page_id"), "host")
              .join(per_page, "page_id", "left").groupBy("host")
              .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                   F.coalesce(F.sum("k"), F.lit(0)).alias("k")))
    known = reputations(counts, second_level, z)
    known = known.select("*", fitting_hosts(F.col("host"), rules).alias("_rules"))
    judged = attach(rows, materialize(known, "reputations"), ["host"],
                    F.xxhash64("in_page_id", "path"))
    fits = F.array_max(F.filter("_rules", lambda r: F.startswith(F.col("path"), r["path"])))
    judged = judged.withColumn("_rule", fits)
    verdict = F.coalesce(F.when(F.col("_rule.blocks"), "block").when(~F.col("_rule.blocks"), "allow"),
                         F.when(F.col("bad_lower") > cutoff, "block").otherwise("allow"))
    judged = judged.withColumn("rule", F.col("_rule.rule")).withColumn("verdict", verdict)
    return judged.select(*unpacked(pages.columns, [
        "host", "path", "rule", "verdict", "bad_mean", "bad_lower"]))


def fitting_hosts(host: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The rules whose host part fits ``host``, in a form whose maximum by
    order is the rule that wins."""
    kind = "array<struct<length:int,blocks:boolean,rule:string,path:string>>"
    parts = []
    for verdict, rule in rules:
        name, slash, path = rule.partition("/")
        fits = (host == name) | F.endswith(host, F.lit("." + name))
        parts.append(F.when(fits, F.struct(
            F.lit(len(rule)).alias("length"), F.lit(verdict == "block").alias("blocks"),
            F.lit(rule).alias("rule"), F.lit(slash + path).alias("path"))))
    return F.array_compact(F.array(*parts)).cast(kind) if parts else F.array().cast(kind)
