"""URL filters (native): rules, then empirical-Bayes host reputation.

A page's outcome is its label: bad if quality is 0 or it is toxic. Bad rates
are shrunk down the tree all -> suffix -> registered domain -> host: at each
level the prior of a node is a beta distribution around its parent's posterior
mean, whose strength is fitted to the spread of that level's rates (method of
moments for the beta-binomial). A host is blocked if the lower bound of its
posterior, mean - ``Z`` standard deviations, is above ``BAD_RATE``; hosts without
labels have their domain's prior. In the tree a host stands without user and
port. Its suffix is the longest of ``suffixes`` (of two labels; by default
``SUFFIXES``, a caller can pass a whole public list) or else the last label; its
registered domain is the suffix and one label more. An IPv4 address is a domain of
its own.

Counts come from partial aggregates, so a host with a third of all pages is a
row per task; each level is written before the next one reads it, and only the
fitted strength, one number per level, passes through the driver. The way back
is a join on the host that AQE can split.

Defined results: a null url or one without ``://`` has empty host and path; null
page ids and null labels give no outcome; repeated labels of an id count once,
bad if any is; repeated pages are judged alike; without labels every host is
allowed; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import ascii_lower, scratch

# The rules (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# Common public suffixes of two labels.
SUFFIXES = (
    "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx",
    "com.tr", "com.tw", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk",
)
ADDRESS = r"^[0-9]+([.][0-9]+){3}$"
BAD_RATE = 0.5
Z = 1.645


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls."""
    name = verdict = None
    for action, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, action) if verdict is None else verdict.when(fits, action)
    return name, verdict


def tree(host: Column, suffixes=SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host without user and port."""
    parts = F.split(host, r"\.", -1)
    last = lambda k: F.array_join(F.slice(parts, F.greatest(F.size(parts) - (k - 1), F.lit(1)), F.lit(k)), ".")
    address, long = host.rlike(ADDRESS), last(2).isin(*suffixes)
    return (
        F.when(address, host).when(long, last(3)).otherwise(last(2)),
        F.when(address, F.lit("(address)")).when(long, last(2)).otherwise(last(1)),
    )


def bare(host: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def _shrunk(nodes: DataFrame, label: str) -> DataFrame:
    """nodes: n, bad and m, the parent's posterior mean, per node. Adds the
    posterior mean and standard deviation of the bad rate."""
    stored = scratch(nodes.withColumn("m", F.greatest(F.least("m", F.lit(1 - 1e-6)), F.lit(1e-6))), label)
    seen = F.col("n") > 0
    # E[n (p - m)^2 / (m (1 - m))] = 1 + (n - 1) rho, rho = 1 / (strength + 1)
    spread = F.when(seen, F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("m"), 2) / (F.col("m") * (1 - F.col("m"))))
    rho = stored.agg(
        F.sum(spread).alias("s"), F.sum(F.when(seen, 1)).alias("k"), F.sum(F.when(seen, F.col("n") - 1)).alias("d")
    ).select(F.greatest(F.least(F.coalesce(F.try_divide(F.col("s") - F.col("k"), F.col("d")), F.lit(0.01)), F.lit(0.99)), F.lit(0.0001)))
    strength = F.lit(1 / rho.first()[0] - 1)
    a, b = F.col("m") * strength + F.col("bad"), (1 - F.col("m")) * strength + F.col("n") - F.col("bad")
    total = F.col("a") + F.col("b")
    return (
        stored.withColumns({"a": a, "b": b})
        .withColumns({"mean": F.col("a") / total, "sd": F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1)))})
        .drop("m", "a", "b")
    )


def host_reputation(pages: DataFrame, labels: DataFrame, suffixes=SUFFIXES) -> DataFrame:
    """pages: (page_id, host). One row per host: n, bad, mean, sd, lower."""
    outcomes = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("is_bad"))
    )
    counted = (
        pages.select("page_id", "host")
        .join(outcomes, F.col("page_id") == F.col("doc_id"), "left")
        .groupBy("host")
        .agg(F.count("is_bad").alias("n"), F.coalesce(F.sum("is_bad"), F.lit(0)).alias("bad"))
    )
    domain, suffix = tree(F.col("host"), suffixes)
    hosts = scratch(counted.withColumns({"domain": domain, "suffix": suffix}), "url-hosts")
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    mean = hosts.agg(F.coalesce(F.try_divide(F.sum("bad"), F.sum("n")), F.lit(0.0))).first()[0]
    of = lambda level, key: level.select(key, F.col("mean").alias("m"))
    tops = _shrunk(hosts.groupBy("suffix").agg(*sums).withColumn("m", F.lit(mean)), "url-suffixes")
    domains = _shrunk(hosts.groupBy("domain", "suffix").agg(*sums).join(of(tops, "suffix"), "suffix"), "url-domains")
    return _shrunk(hosts.drop("suffix").join(of(domains, "domain"), "domain"), "url-posteriors").withColumn(
        "lower", F.col("mean") - Z * F.col("sd")
    )


def judge(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES, suffixes=SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's reputation (n labels,
    posterior mean and lower bound of the bad rate)."""
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    known = host_reputation(rows.select("page_id", bare(F.col("host")).alias("host")), labels, suffixes)
    known = known.select(F.col("host").alias("k_host"), "n", "mean", "lower")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("lower") > BAD_RATE, "block").otherwise("allow")
    return rows.join(known, bare(F.col("host")) == F.col("k_host"), "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n_labels"), F.col("mean").alias("bad_rate"), F.col("lower").alias("bad_rate_low"),
    )


def digest(pages: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(pages, labels).select("page_id", "host", "path", "rule", "verdict")


def _sql_level(node: str, parent: str, source: str, parents: str) -> str:
    return f"""
j_{node} AS (SELECT s.*, greatest(least(p.mean, 1 - 1e-6), 1e-6) AS m FROM {source} s JOIN {parents} p USING ({parent})),
r_{node} AS (SELECT greatest(least(coalesce((sum(CASE WHEN n > 0 THEN n * (bad / n - m) ^ 2 / (m * (1 - m)) END)
    - sum(CASE WHEN n > 0 THEN 1 END)) / nullif(sum(CASE WHEN n > 0 THEN n - 1 END), 0), 0.01), 0.99), 0.0001) AS rho FROM j_{node}),
p_{node} AS (SELECT *, m * (1 / rho - 1) + bad AS a, (1 - m) * (1 / rho - 1) + n - bad AS b FROM j_{node}, r_{node}),
q_{node} AS (SELECT {node}, a / (a + b) AS mean, sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS sd FROM p_{node})"""


# DuckDB form of digest(pages, labels).
DIGEST_SQL = (
    r"""
WITH u AS (SELECT row_number() OVER () AS rid, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
o AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS is_bad FROM labels
      WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id),
b AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare FROM h),
counted AS (SELECT bare AS host, regexp_extract(bare, '[^.]*[.]?[^.]*$') AS two, regexp_matches(bare, '^[0-9]+([.][0-9]+){3}$') AS address,
                   count(is_bad) AS n, coalesce(sum(is_bad), 0) AS bad
            FROM b LEFT JOIN o ON page_id = doc_id GROUP BY bare),
hosts AS (SELECT host, n, bad, CASE WHEN address THEN host WHEN two IN (SUFFIX_LIST) THEN regexp_extract(host, '([^.]*[.])?[^.]*[.][^.]*$') ELSE two END AS domain,
                 CASE WHEN address THEN '(address)' WHEN two IN (SUFFIX_LIST) THEN two ELSE regexp_extract(host, '[^.]*$') END AS suffix FROM counted),
root AS (SELECT 0 AS root, coalesce(sum(bad) / nullif(sum(n), 0), 0) AS mean FROM hosts),
suf AS (SELECT suffix, 0 AS root, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix),
dom AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),"""
    + _sql_level("suffix", "root", "suf", "root") + ","
    + _sql_level("domain", "suffix", "dom", "q_suffix") + ","
    + _sql_level("host", "domain", "hosts", "q_domain")
    + r""",
f AS (SELECT rid, page_id, host, bare, path, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM b)
SELECT page_id, f.host AS host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN mean - 1.645 * sd > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM f JOIN q_host ON f.bare = q_host.host
"""
).replace("SUFFIX_LIST", ", ".join(f"'{x}'" for x in SUFFIXES))
