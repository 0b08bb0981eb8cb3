"""URL filter: rules first, then empirical-Bayes host reputation.

Pages that a rule decides are labelled outcomes (1 for block). Where no rule
fits, the host's reputation decides. Its block rate has a beta posterior: the
prior mean of a host is the posterior mean of its registered domain, that of a
domain the posterior mean of its suffix, that of a suffix the overall rate. The
prior strength of each level is fitted to the data by the method of moments
(between-group variance of the outcome rates against their binomial variance).
A page is blocked if the lower posterior bound, mean - z * sd, of its host's
block rate lies above ``cutoff``; otherwise it is allowed, so an unknown host
is never blocked for lack of evidence.

Everything is grouping and joining on hosts, in built-in functions. Outcomes
are summed by host before any shuffle, so a host with a third of all pages is
one row in each task; the pages themselves join their host's verdict by key,
which adaptive execution splits when one key is hot.

The suffix of a host is its last label, or its last two where the second last
is a usual registry name and the last has two letters (co.uk); the registered
domain is the suffix with one label more. User names and ports are left aside
for this. An address in digits is its own domain and suffix.

Defined results: null url, or one without ``://``: empty host and path, no
rule; the empty host has no outcomes, so the overall rate decides as for any
unseen host. Without any labelled page everything is allowed. Repeated rows
each get a row. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower
from tidemark.session import configure

# The rules of the contract, (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Usual second-level registry names.
REGISTRIES = ("ac", "co", "com", "edu", "gov", "ne", "net", "or", "org")
Z = 1.645
CUTOFF = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does. For rule lists short enough for one expression."""
    out = None
    for verdict, of, prefix in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(prefix)
        value = F.struct(F.lit(of + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    labels = F.split(name, r"\.")
    n = F.size(labels)
    numeric = name.rlike(r"^[0-9.]*$")
    double = (n >= 2) & F.element_at(labels, -1).rlike("^[a-z]{2}$") & F.coalesce(F.get(labels, n - 2), F.lit("")).isin(*REGISTRIES)
    suffix = F.when(numeric, name).when(double, F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1))
    domain = F.when(numeric, name).when(double, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))
    return domain, suffix


def strength(groups: DataFrame, name: str) -> DataFrame:
    """One row: how many outcomes the prior of these groups (n, bad) is worth.

    Method of moments: the variance of the group rates beyond the binomial one, floored, against the overall rate.
    """
    sums = groups.where("n > 0").agg(
        F.count("*").cast("double").alias("g"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n"),
        F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad"),
        F.coalesce(F.sum(F.col("n").cast("double") * F.col("n")), F.lit(0.0)).alias("nn"),
        F.coalesce(F.sum(F.col("bad").cast("double") * F.col("bad") / F.col("n")), F.lit(0.0)).alias("bb"),
    )
    p = (F.col("bad") + 0.5) / (F.col("n") + 1.0)
    spread = F.col("n") - F.col("nn") / F.greatest(F.col("n"), F.lit(1.0))
    between = (F.col("bb") - 2.0 * p * F.col("bad") + p * p * F.col("n") - (F.col("g") - 1.0) * p * (1.0 - p)) / F.greatest(spread, F.lit(1.0))
    worth = p * (1.0 - p) / F.greatest(between, F.lit(1e-6)) - 1.0
    return sums.select(p.alias("rate"), F.least(F.greatest(worth, F.lit(1.0)), F.lit(1000.0)).alias(name))


def reputations(outcomes: DataFrame, hosts: DataFrame, z: float = Z, cutoff: float = CUTOFF) -> DataFrame:
    """host, blocked for each host of ``hosts`` (distinct hosts), from ``outcomes`` (host, bad 0 or 1)."""
    seen = outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").cast("long").alias("bad"))
    domain, suffix = domain_and_suffix(F.col("host"))
    table = hosts.join(seen, "host", "left").select("host", domain.alias("domain"), suffix.alias("suffix"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0)).alias("bad"))
    domains = table.groupBy("domain").agg(F.first("suffix").alias("suffix"), F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # Three one-row tables: overall rate and prior strengths.
    k1, k2, k3 = strength(suffixes, "k1"), strength(domains, "k2").select("k2"), strength(table, "k3").select("k3")
    prior = k1.crossJoin(k2).crossJoin(k3)

    of_suffix = suffixes.crossJoin(F.broadcast(prior)).select(
        "suffix", "k2", "k3", ((F.col("bad") + F.col("k1") * F.col("rate")) / (F.col("n") + F.col("k1"))).alias("m1")
    )
    of_domain = domains.join(of_suffix, "suffix").select(
        "domain", "k3", ((F.col("bad") + F.col("k2") * F.col("m1")) / (F.col("n") + F.col("k2"))).alias("m2")
    )
    total = F.col("n") + F.col("k3")
    mean = (F.col("bad") + F.col("k3") * F.col("m2")) / total
    return table.join(of_domain, "domain").select("host", (mean - z * F.sqrt(mean * (1.0 - mean) / (total + 1.0)) > cutoff).alias("blocked"))


def url_filter(pages: DataFrame, rules=RULES, z: float = Z, cutoff: float = CUTOFF) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``."""
    configure(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    judged = parsed.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)).select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("verdict"))
    outcomes = judged.where("rule is not null").select("host", (F.col("verdict") == "block").cast("int").alias("bad"))
    known = reputations(outcomes, judged.select("host").distinct(), z, cutoff)
    return judged.join(known, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict")
    )


ORACLE_SQL = """
WITH parsed AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parsed
), rules(verdict, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), judged AS (
  SELECT c.page_id, c.host, c.path,
    (SELECT max_by(h || p, length(h || p)) FROM rules WHERE (c.host = h OR ends_with(c.host, '.' || h)) AND starts_with(c.path, p)) AS rule,
    (SELECT max_by(verdict, length(h || p)) FROM rules WHERE (c.host = h OR ends_with(c.host, '.' || h)) AND starts_with(c.path, p)) AS verdict
  FROM cut c
), named AS (
  SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name,
         count(rule) AS n, coalesce(sum(CASE WHEN verdict = 'block' THEN 1 ELSE 0 END), 0) AS bad
  FROM judged GROUP BY host
), labelled AS (
  SELECT *, string_split(name, '.') AS l FROM named
), table1 AS (
  SELECT host, n, bad,
    CASE WHEN regexp_matches(name, '^[0-9.]*$') THEN name
         WHEN len(l) >= 2 AND regexp_matches(l[-1], '^[a-z]{2}$') AND list_contains(['ac','co','com','edu','gov','ne','net','or','org'], l[-2]) THEN array_to_string(l[-3:], '.')
         ELSE array_to_string(l[-2:], '.') END AS domain,
    CASE WHEN regexp_matches(name, '^[0-9.]*$') THEN name
         WHEN len(l) >= 2 AND regexp_matches(l[-1], '^[a-z]{2}$') AND list_contains(['ac','co','com','edu','gov','ne','net','or','org'], l[-2]) THEN array_to_string(l[-2:], '.')
         ELSE l[-1] END AS suffix
  FROM labelled
), domains AS (
  SELECT domain, any_value(suffix) AS suffix, sum(n) AS n, sum(bad) AS bad FROM table1 GROUP BY domain
), suffixes AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix
), groups AS (
  SELECT 1 AS lev, n, bad FROM suffixes UNION ALL SELECT 2, n, bad FROM domains UNION ALL SELECT 3, n, bad FROM table1
), sums AS (
  SELECT lev, count(*)::DOUBLE AS g, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, sum(n::DOUBLE * n) AS nn, sum(bad::DOUBLE * bad / n) AS bb,
         (sum(bad)::DOUBLE + 0.5) / (sum(n)::DOUBLE + 1.0) AS p
  FROM groups WHERE n > 0 GROUP BY lev
), prior AS (
  SELECT lev, p, least(greatest(p * (1 - p) / greatest((bb - 2 * p * bad + p * p * n - (g - 1) * p * (1 - p)) / greatest(n - nn / greatest(n, 1), 1), 1e-6) - 1, 1.0), 1000.0) AS k FROM sums
), ks AS (
  SELECT coalesce(max(p) FILTER (lev = 1), 0.5) AS rate, max(k) FILTER (lev = 1) AS k1, max(k) FILTER (lev = 2) AS k2, max(k) FILTER (lev = 3) AS k3 FROM prior
), known AS (
  SELECT host, (t.bad + k3 * m2) / (t.n + k3) AS mean, t.n + k3 AS total
  FROM table1 t JOIN (
    SELECT domain, (d.bad + k2 * m1) / (d.n + k2) AS m2 FROM domains d JOIN (
      SELECT suffix, (s.bad + k1 * rate) / (s.n + k1) AS m1 FROM suffixes s, ks) USING (suffix), ks) USING (domain), ks
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN mean - 1.645 * sqrt(mean * (1 - mean) / (total + 1)) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM judged JOIN known USING (host)
"""
