"""URL filter by empirical-Bayes host reputation (DataFrame functions only).

Labelled pages give each host k good outcomes of n. Rates are shrunk down a tree: all pages,
public suffix, registered domain, host. On every level a group's mean is
(k + K * parent mean) / (n + K), a beta-binomial posterior whose prior strength K is estimated from
that level's own over-dispersion by moments: with E (k - n m)^2 = n m (1 - m) (1 + (n - 1) rho),
rho = sum((k - n m)^2 - n m (1 - m)) / sum(n (n - 1) m (1 - m)), K = 1 / rho - 1. A host without labels
inherits its domain's mean, one with many speaks for itself.

A host is blocked when even the upper bound of its posterior, mean + Z * standard deviation of
Beta(k + K m, n - k + K (1 - m)), stays below `MIN_GOOD`; hosts without evidence pass. Rules (host suffix and path prefix, longest wins)
overrule the reputation.

Scale: pages are reduced to (host, pages, n, k) with map-side sums; the tree above is smaller
still, and per-level strengths are one number each. Verdicts go back to the pages by a join on
host. Hosts with more than a `HOT`-th of all pages, fewer than `HOT` by arithmetic, are joined by a
broadcast of that proven size, the rest by a shuffle join, so no task holds a hot host's pages.

Defined results: a null url, or one without "://", has an empty host and path and is judged as the
host "". Labels with a null quality say nothing; several labels of a page count as one, bad if any
is bad; without labels every host has the prior mean. A rule needs its path as prefix, so an empty path
fits no rule that begins with "/". Repeated page rows are judged each and count each. An empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inferframe.llm.shared import written

#: (host, path prefix, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: second-level labels under which country suffixes register names
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
MIN_GOOD, Z = 0.7, 1.645
RHO_MIN, RHO_MAX, RHO_NONE = 1e-4, 0.95, 0.01
HOT = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The last label, or the last two where the second-last is a registry's and the last has two letters."""
    name = F.regexp_replace(host, r"\.?(:[0-9]*)?$", "")
    two = F.regexp_extract(name, r"(?:^|\.)((?:" + "|".join(SECOND_LEVEL) + r")\.[a-z]{2})$", 1)
    return F.when(two != "", two).otherwise(F.regexp_extract(name, r"([^.]*)$", 1))


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix with one more label, or the host itself where there is none."""
    name = F.regexp_replace(host, r"\.?(:[0-9]*)?$", "")
    rest = F.substr(name, F.lit(1), F.greatest(F.length(name) - F.length(suffix) - 1, F.lit(0)))
    label = F.regexp_extract(rest, r"([^.]*)$", 1)
    return F.when(label == "", name).otherwise(F.concat(label, F.lit("."), suffix))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct(size, rule, verdict), or null."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for h, p, v in rules]
    none = F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    return F.greatest(none, none, *fits)


def _strength(groups: DataFrame) -> float:
    """K of a level from rows n, k, m (parent mean): two sums, one row to the driver."""
    n, k, m = F.col("n"), F.col("k"), F.col("m")
    row = groups.agg(F.sum((k - n * m) * (k - n * m) - n * m * (1 - m)).alias("a"),
                     F.sum(n * (n - 1) * m * (1 - m)).alias("b")).first()
    rho = RHO_NONE if not row.b or row.b <= 0 else min(max(row.a / row.b, RHO_MIN), RHO_MAX)
    return 1 / rho - 1


def reputations(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host, pages, n, k, alpha, beta, upper (posterior bound), good of every host of pages."""
    outcome = labels.where("quality is not null").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0)).alias("good"))
    seen = pages.select("page_id", host_of(F.col("url")).alias("host"))
    hosts = seen.join(outcome, "page_id", "left").groupBy("host").agg(
        F.count("*").alias("pages"), F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"))
    hosts = written(hosts.withColumn("suffix", suffix_of(F.col("host")))
                    .withColumn("domain", domain_of(F.col("host"), F.col("suffix"))), "hosts")
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    mean = (total.k + 1) / (total.n + 2)
    level = F.lit(mean)

    def shrunk(groups: DataFrame, m: Column) -> DataFrame:
        strength = _strength(groups.withColumn("m", m))
        return groups.withColumn("mean", (F.col("k") + strength * m) / (F.col("n") + strength))

    suffixes = shrunk(hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), level)
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k")) \
        .join(suffixes.select("suffix", F.col("mean").alias("above")), "suffix")
    domains = written(shrunk(domains, F.col("above")).select("suffix", "domain", F.col("mean").alias("above")), "domains")
    full = hosts.join(domains, ["suffix", "domain"])
    strength = _strength(full.withColumn("m", F.col("above")))
    a, b = F.col("alpha"), F.col("beta")
    return full.withColumn("alpha", F.col("k") + strength * F.col("above")) \
        .withColumn("beta", F.col("n") - F.col("k") + strength * (1 - F.col("above"))) \
        .withColumn("upper", a / (a + b) + Z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))) \
        .select("host", "pages", "n", "k", "alpha", "beta", "upper", (F.col("upper") >= MIN_GOOD).alias("good"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages."""
    known = written(reputations(pages, labels), "reputations")
    total = known.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]
    hot = known.where(F.col("pages") * HOT > total).select("host", F.col("good").alias("hot_good"))
    rest = known.where(F.col("pages") * HOT <= total).select(F.col("host").alias("key"), "good")
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")) \
        .join(F.broadcast(hot), "host", "left") \
        .withColumn("key", F.when(F.col("hot_good").isNotNull(), F.concat(F.lit("\u0001"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))).otherwise(F.col("host"))) \
        .join(rest, "key", "left")
    rule = rule_for(F.col("host"), F.col("path"), rules)
    good = F.coalesce("hot_good", "good")
    return rows.withColumn("r", rule).select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce(F.col("r.verdict"), F.when(good, "allow").otherwise("block")).alias("verdict"))


def keep_allowed(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """The rows of pages whose url is allowed, columns unchanged; rows of one page_id stay or go together."""
    allowed = judge(pages, labels, rules).where("verdict = 'allow'").select(F.col("page_id").alias("__id")).distinct()
    return pages.join(allowed, pages["page_id"].eqNullSafe(F.col("__id")), "left_semi")
