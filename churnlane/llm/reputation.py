"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are counted by host.  Rates are shrunk
down a chain of beta-binomial priors: all pages -> public suffix -> registered
domain -> host.  At each level the prior's mean is the parent's posterior mean
and its strength comes from the spread of the children's rates (a moment
estimate), so a host with few labels leans on its domain and an unlabelled
host is its domain.  A host is blocked if the lower bound of its posterior bad
rate exceeds ``MAX_BAD``.  Explicit rules go before the method.

Defined results: a null url, or one without ``://``, has host and path '' and
is judged like any host of that name; pages without a label count in no rate;
several labels of one page all count; addresses (four numbers, or in brackets) are
domains of their own, ports and trailing dots don't count; with no label at all every rate is the
prior 1/2 with no weight and nothing is blocked; empty tables give empty
tables; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlane.llm.common import lower_ascii, stage

#: (verdict, host, path prefix); the longest that fits decides.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MAX_BAD, Z = 0.25, 1.645
MIN_SPREAD, MAX_SPREAD = 0.001, 0.5     # of the correlation within a parent
#: Suffixes of several labels, below which hosts belong to different owners; a deployment passes a full list of public suffixes.
SUFFIXES = ("appspot.com", "blogspot.com", "github.io", "gitlab.io", "herokuapp.com", "netlify.app", "pages.dev", "s3.amazonaws.com",
            "web.app", "wordpress.com")
#: Second-level labels that belong to the public suffix under a two-letter country code.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


def url_host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_column(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


ADDRESS = "^([0-9]+([.][0-9]+){3}|\\[.*\\])$"


def _families(hosts: DataFrame, suffixes=SUFFIXES) -> DataFrame:
    """Adds suffix and domain to ``host`` (without port and trailing dots); an address is its own suffix and domain.

    The suffix is the longest of ``suffixes`` that the host ends in, else two labels under a country's second level, else the last label.
    """
    plain = F.regexp_replace(F.regexp_replace("host", ":[0-9]*$", ""), "[.]+$", "")
    labels = F.when(plain.rlike(ADDRESS), F.array(plain)).otherwise(F.split(plain, "\\."))
    n = F.size("labels")
    two = (n > 2) & (F.length(F.get("labels", n - 1)) == 2) & F.get("labels", n - 2).isin(*SECOND_LEVEL)
    last = lambda c: F.array_join(F.slice("labels", F.greatest(F.lit(1), n - c + 1), n), ".")
    by_size = {size: sorted(s for s in suffixes if s.count(".") + 1 == size) for size in {s.count(".") + 1 for s in suffixes}}
    k = F.when(two, 2).otherwise(1)
    for size in sorted(by_size):                                 # the longest is asked first
        k = F.when((n > size) & last(F.lit(size)).isin(by_size[size]), size).otherwise(k)
    return hosts.withColumn("labels", labels).withColumn("suffix", last(k)).withColumn("domain", last(k + 1)).drop("labels")


def _level(children: DataFrame, parents: DataFrame, parent: str, child: str) -> DataFrame:
    """Posterior of each child (n, bad) given its parent's mean: (child, mean, strength, n, bad).  One scalar row is shared."""
    c = children.join(parents.select(parent, F.col("mean").alias("prior")), parent)
    v = F.col("prior") * (1 - F.col("prior"))
    spread = c.filter("n > 0").agg(
        ((F.sum(F.pow(F.col("bad") - F.col("n") * F.col("prior"), 2) / F.col("n")) - F.sum(v))
         / F.nullif(F.sum((F.col("n") - 1) * v), F.lit(0.0))).alias("r"))
    spread = spread.select(F.lit(0).alias("all"), F.greatest(F.lit(MIN_SPREAD), F.least(
        F.lit(MAX_SPREAD), F.coalesce("r", F.lit(MAX_SPREAD)))).alias("r"))
    s = 1 / F.col("r") - 1
    return (c.withColumn("all", F.lit(0)).join(F.broadcast(spread), "all")
            .withColumn("strength", s).withColumn("mean", (F.col("bad") + F.col("strength") * F.col("prior")) / (F.col("n") + F.col("strength")))
            .drop("all", "r", "prior"))


def host_reputation(outcomes: DataFrame, public=SUFFIXES) -> DataFrame:
    """(host, n: labels or null, bad: their sum) of pages -> one row per host: n, bad, mean, low (lower posterior bound)."""
    hosts = stage(_families(outcomes.groupBy("host").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), public), "rep-hosts")
    total = F.sum("n"), F.sum("bad")
    everything = hosts.agg(((F.coalesce(total[1], F.lit(0)) + 0.5) / (F.coalesce(total[0], F.lit(0)) + 1.0)).alias("mean"))
    everything = everything.select(F.lit(0).alias("root"), "mean")
    suffixes = hosts.groupBy("suffix").agg(total[0].alias("n"), total[1].alias("bad")).withColumn("root", F.lit(0))
    suffixes = stage(_level(suffixes, everything, "root", "suffix"), "rep-suffixes")
    domains = hosts.groupBy("suffix", "domain").agg(total[0].alias("n"), total[1].alias("bad"))
    domains = stage(_level(domains, suffixes, "suffix", "domain"), "rep-domains")
    judged = _level(hosts.drop("suffix"), domains, "domain", "host")
    weight = F.col("n") + F.col("strength")
    return judged.select("host", "n", "bad", "mean", (
        F.col("mean") - Z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (weight + 1))).alias("low"))


def judge_urls(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
               label_id: str = "doc_id", bad_col: str = "toxic", rules=RULES, max_bad: float = MAX_BAD, suffixes=SUFFIXES) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, low.  ``labels`` has outcomes (1: bad) by page id."""
    known = labels.select(F.col(label_id).alias("id"), F.col(bad_col).cast("long").alias("bad")).filter(
        "id is not null and bad is not null").groupBy("id").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    urls = pages.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    outcomes = urls.select("id", "host").join(known, "id", "left").select("host", "n", "bad")
    hosts = stage(host_reputation(outcomes, suffixes), "rep-judged")
    rule = rule_column(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("low") > max_bad, F.lit("block")).otherwise(F.lit("allow"))
    return (urls.join(hosts.select("host", "low"), "host").withColumn("fit", rule)
            .select("id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce(F.col("fit.verdict"), method).alias("verdict"), "low"))


def oracle() -> str:
    """DuckDB SQL for page_id, host, path, rule, verdict of the query."""
    fits = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{}}'".replace("{}", f"{h}{p}|{v}")
                    for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])))

    sizes = sorted({s.count(".") + 1 for s in SUFFIXES}, reverse=True)
    known = "".join(f"WHEN len(l) > {z} AND array_to_string(l[-{z}:], '.') IN ({', '.join(repr(s) for s in SUFFIXES if s.count('.') + 1 == z)}) THEN {z} "
                    for z in sizes)

    def level(name: str, children: str, parents: str, parent: str, child: str) -> str:
        return f"""{name}_p AS (SELECT c.*, p.mean AS prior FROM {children} c JOIN {parents} p USING ({parent})),
{name}_r AS (SELECT greatest({MIN_SPREAD}, least({MAX_SPREAD}, coalesce((sum(pow(bad - n * prior, 2) / n) - sum(prior * (1 - prior)))
    / nullif(sum((n - 1) * prior * (1 - prior)), 0), {MAX_SPREAD}))) AS r FROM {name}_p WHERE n > 0),
{name} AS (SELECT * EXCLUDE (prior), 1 / r - 1 AS strength, (bad + (1 / r - 1) * prior) / (n + (1 / r - 1)) AS mean FROM {name}_p, {name}_r)"""
    return f"""
WITH urls AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
h0 AS (SELECT host, count(toxic) AS n, coalesce(sum(toxic), 0)::BIGINT AS bad, regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '[.]+$', '') AS plain,
    CASE WHEN regexp_matches(plain, '{ADDRESS}') THEN [plain] ELSE string_split(plain, '.') END AS l
    FROM urls LEFT JOIN labels ON doc_id = page_id GROUP BY host),
h1 AS (SELECT *, CASE {known}WHEN len(l) > 2 AND length(l[-1]) = 2 AND l[-2] IN {SECOND_LEVEL} THEN 2 ELSE 1 END AS k FROM h0),
hosts AS (SELECT host, n, bad, array_to_string(l[greatest(1, len(l) - k + 1):], '.') AS suffix,
    array_to_string(l[greatest(1, len(l) - k):], '.') AS domain FROM h1),
every AS (SELECT 0 AS root, (sum(bad) + 0.5) / (sum(n) + 1.0) AS mean FROM hosts),
s0 AS (SELECT 0 AS root, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix),
{level('s', 's0', 'every', 'root', 'suffix')},
d0 AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix, domain),
{level('d', 'd0', 's', 'suffix', 'domain')},
e0 AS (SELECT host, domain, n, bad FROM hosts),
{level('e', 'e0', 'd', 'domain', 'host')},
judged AS (SELECT page_id, host, path, CASE {fits} END AS fit, mean - {Z} * sqrt(mean * (1 - mean) / (n + strength + 1)) AS low
    FROM urls JOIN e USING (host))
SELECT page_id, host, path, split_part(fit, '|', 1) AS rule, coalesce(split_part(fit, '|', 2), CASE WHEN low > {MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged"""
