"""URL filter: rules first, else empirical-Bayes host reputation. DataFrame functions only.

Labelled page outcomes (bad or not) are counted per host and rolled up to registered domain and
suffix. At each level the rate of a member is shrunk to its parent's by a beta-binomial prior,
whose strength is estimated by the method of moments over the members of that level. A host is
blocked when the lower posterior bound of its bad rate, mean - z * sd, is above ``max_bad``; a
host without labels has the rate of its domain.

For reputation only, a host is its site: without user and port. An address (IPv4 or IPv6) is a domain of its
own, and all addresses share one suffix. Suffixes follow ``suffixes``, a table of rules in the form of the public
list of registries: ``co.uk``, ``*.ck`` (any one label more), ``!www.ck`` (not that one); the longest rule counts and an
exception before all. Without a table, a suffix is the last label, or a common second-level label before a country.

* null url, or one without ``://``: host and path empty, no rule; judged by the rate of all pages
* null page_id: counts as not labelled; rows that repeat count as often as they are there
* several outcomes of a page: bad if one is; null outcome: not labelled
* no outcomes or no pages: everything is allowed
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import stored

#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: A suffix is the last label, or one of these labels before a country.
SUFFIX = r"((?:ac|co|com|edu|gov|net|org)\.[a-z]{2}|[^.]+)$"
DOMAIN = r"((?:[^.]+\.)?(?:(?:ac|co|com|edu|gov|net|org)\.[a-z]{2}|[^.]+))$"
#: What a site lacks of a host, and a site that is an address.
SITE = r"^.*@|\.?(:[0-9]*)?\z"
ADDRESS = r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[.*\])\z"
ADDRESSES = "[]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Z, MAX_BAD = 1.645, 0.3
#: Outcomes that the rate of all pages starts from: bad ones, all.
ROOT = (0.1, 1)
#: Bounds of the correlation of outcomes within a member; prior strength is 1 / correlation - 1.
RHO = (0.0001, 0.9999)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def site_of(host: Column) -> Column:
    """A host without user, port and the dot at its end."""
    return F.regexp_replace(host, SITE, "")


def _by_rules(sites: DataFrame, suffixes: DataFrame) -> DataFrame:
    """``sites`` (site, address) with ``labels`` of their suffix by a table with column ``rule``; 1 where none fits."""
    labels = F.split("site", r"\.")
    tails = sites.where("NOT address").select("site", labels.alias("labels"))
    tails = tails.select("site", "labels", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("n"))
    tail = lambda n: F.array_join(F.slice("labels", -n, n), ".")
    plain, wild = tail(F.col("n")), F.when(F.col("n") > 1, F.concat(F.lit("*."), tail(F.greatest(F.col("n") - 1, F.lit(1)))))
    forms = F.array_compact(F.array(plain, wild, F.concat(F.lit("!"), plain)))
    asked = tails.select("site", "n", F.explode(forms).alias("rule"))
    given = suffixes.select(F.lower(F.trim("rule")).alias("rule")).where("rule <> ''").distinct()
    found = asked.join(given, "rule").select(
        "site", F.col("rule").startswith("!").alias("not_one"), "n"
    )
    best = found.groupBy("site").agg(F.max(F.struct("not_one", "n")).alias("best"))
    return best.select("site", (F.col("best.n") - F.col("best.not_one").cast("int")).alias("labels"))


def levels(sites: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """``sites`` (site, one row each, and other columns) with their registered domain and suffix."""
    marked = sites.withColumn("address", F.col("site").rlike(ADDRESS))
    if suffixes is None:
        domain, suffix = F.regexp_extract("site", DOMAIN, 1), F.regexp_extract("site", SUFFIX, 1)
    else:
        marked = marked.join(_by_rules(marked.select("site", "address"), suffixes), "site", "left")
        n = F.coalesce("labels", F.lit(1))
        domain, suffix = F.call_function("substring_index", "site", F.lit("."), -n - 1), F.call_function("substring_index", "site", F.lit("."), -n)
    return marked.select(
        *sites.columns,
        F.when(F.col("address"), F.col("site")).otherwise(domain).alias("domain"),
        F.when(F.col("address"), F.lit(ADDRESSES)).otherwise(suffix).alias("suffix"),
    )


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does."""
    name = verdict = F.lit(None).cast("string")
    for kind, on, below in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == on) | host.endswith(f".{on}")) & path.startswith(below)
        name = F.when(fits, F.lit(on + below)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _strength(members: DataFrame) -> float:
    """Prior strength over members with ``n``, ``bad`` and their parent's ``rate``."""
    spread, at_most = F.col("rate") * (1 - F.col("rate")), F.col("n") * (F.col("n") - 1)
    found = members.select(
        F.sum(F.pow(F.col("bad") - F.col("n") * F.col("rate"), 2) - F.col("n") * spread).alias("over"),
        F.sum(at_most * spread).alias("room"),
    ).first()
    rho = found["over"] / found["room"] if found["room"] else RHO[0]
    return 1 / min(RHO[1], max(RHO[0], rho)) - 1


def reputations(pages: DataFrame, outcomes: DataFrame, suffixes: DataFrame | None = None) -> tuple[DataFrame, float]:
    """Posterior of every site: site, n, bad, mean and sd of its bad rate; and the rate of all pages.

    ``outcomes`` has page_id and bad (0 or 1), ``suffixes`` rule.
    """
    known = outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    hosts = stored(
        pages.select("page_id", site_of(host_of(F.col("url"))).alias("site"))
        .join(known, "page_id", "left")
        .groupBy("site")
        .agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad")),
        "site-outcomes",
    )
    hosts = levels(hosts, suffixes)
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    root = ((total["bad"] or 0.0) + ROOT[0]) / ((total["n"] or 0.0) + ROOT[1])

    def shrunk(members: DataFrame) -> tuple[DataFrame, float]:
        k = _strength(members)
        return members.withColumn("rate", (k * F.col("rate") + F.col("bad")) / (k + F.col("n"))), k

    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    suffixes, _ = shrunk(hosts.groupBy("suffix").agg(*counts).withColumn("rate", F.lit(root)))
    domains, _ = shrunk(hosts.groupBy("domain", "suffix").agg(*counts).join(suffixes.select("suffix", "rate"), "suffix"))
    members = hosts.join(domains.select("domain", "suffix", "rate"), ["domain", "suffix"])
    members, k = shrunk(members)
    sd = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (k + F.col("n") + 1))
    return members.select("site", "n", "bad", F.col("rate").alias("mean"), sd.alias("sd")), root


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules=RULES,
    z: float = Z,
    max_bad: float = MAX_BAD,
    suffixes: DataFrame | None = None,
) -> DataFrame:
    """page_id, host, path, the rule that decides or null, and the verdict of every page."""
    found, _ = reputations(pages, outcomes, suffixes)
    found = found.select(F.col("site").alias("of"), (F.col("mean") - z * F.col("sd") > max_bad).alias("bad_host"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad_host"), F.lit("block")).otherwise(F.lit("allow"))
    return urls.join(found, site_of(F.col("host")) == F.col("of"), "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict")
    )
