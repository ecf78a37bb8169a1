"""URL filters by empirical-Bayes host reputation, in DataFrame functions only.

Labelled page outcomes (bad or not) are counted per host, registered domain and suffix. The rate of a suffix is shrunk
towards the rate of all pages, that of a domain towards its suffix and that of a host towards its domain, each through a
beta-binomial prior whose strength is estimated from the spread of that level (method of moments). A host is blocked
when the lower bound of its posterior bad rate reaches ``max_bad``, or ``factor`` times the rate of all pages if that is
less; explicit rules come before that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.llm.common import join_facts, stash

#: (host, path, verdict); the longest rule that fits wins.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Suffixes of two labels under which names are registered; all others are taken to have one.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx",
                      "com.tr", "gov.uk", "net.au", "or.jp", "org.au", "org.uk")
MAX_BAD, FACTOR = 0.5, 1.5
Z = 1.645
#: The path segment that names a document: digits, up to the segment's end or a file's ending.
NUMBER = r"/(\d{1,18})(?:[/.]|$)"
#: Bounds of the share of variance between the members of a level; 1 / share - 1 is the prior's weight in pages.
LEAST_SPREAD, MOST_SPREAD = 0.001, 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    part = lambda n: F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", n), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def page_number(path: Column) -> Column:
    """The first path segment of digits alone, but for a file's ending, as a number: it names the document that the page was
    made of."""
    return F.regexp_extract(path, NUMBER, 1).try_cast("bigint")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, or nulls. Rules are a parameter, tried in one expression."""
    rule = verdict = F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host without its port; an address in numbers is its own domain, its suffix empty."""
    bare = F.regexp_replace(host, r"^[^@]*@|:\d*$", "")
    last = lambda n: F.substring_index(bare, ".", -n)
    two = last(2).isin(*TWO_LABEL_SUFFIXES)
    number = bare.rlike(r"^[0-9.]+$|^\[")
    return (F.when(number, bare).when(two, last(3)).otherwise(last(2)),
            F.when(number, F.lit("")).when(two, last(2)).otherwise(last(1)))


def spread(level: DataFrame) -> float:
    """Intra-class correlation of (labelled, bad, mean), clipped; mean is the parent's rate. One row to the driver."""
    v = F.col("mean") * (1 - F.col("mean"))
    got = level.where("labelled > 0").agg(
        F.sum(F.col("labelled") * F.pow(F.col("bad") / F.col("labelled") - F.col("mean"), 2)).alias("q"),
        F.sum(v).alias("v"), F.sum(v * (F.col("labelled") - 1)).alias("d")).first()
    return min(MOST_SPREAD, max(LEAST_SPREAD, (got["q"] - got["v"]) / got["d"])) if got["d"] else MOST_SPREAD


def shrunk(level: DataFrame) -> DataFrame:
    """Adds the prior's ``weight`` and the posterior mean ``rate``."""
    weight = 1 / spread(level) - 1
    return level.withColumn("weight", F.lit(weight)).withColumn(
        "rate", (F.col("bad") + F.lit(weight) * F.col("mean")) / (F.col("labelled") + F.lit(weight)))


def host_rates(hosts: DataFrame, z: float = Z) -> DataFrame:
    """Adds rate, lower ``bound`` of the bad rate and the rate of ``all`` pages to stored (host, domain, suffix, pages, labelled, bad)."""
    sums = [F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"), F.count("*").alias("members")]
    domains = stash(hosts.groupBy("domain", "suffix").agg(*sums), "domains")
    suffixes = stash(domains.groupBy("suffix").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"), F.count("*").alias("members")), "suffixes")
    every = suffixes.agg(F.sum("labelled").alias("n"), F.sum("bad").alias("k")).first()
    mean = ((every["k"] or 0) + 0.5) / ((every["n"] or 0) + 1.0)
    top = shrunk(suffixes.withColumn("mean", F.lit(mean)))
    facts = stash(top.select("suffix", F.col("rate").alias("mean"), F.col("members").alias("children")), "suffix-rates")
    middle = shrunk(stash(join_facts(domains, facts, "suffix", "children").drop("children"), "domain-means"))
    facts = stash(middle.select("domain", F.col("rate").alias("mean"), F.col("members").alias("children")), "domain-rates")
    low = shrunk(stash(join_facts(hosts, facts, "domain", "children").drop("children"), "host-means"))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("labelled") + F.col("weight") + 1))
    return low.withColumn("bound", F.greatest(F.lit(0.0), F.col("rate") - F.lit(z) * deviation)).withColumn("all", F.lit(mean))


def judge_urls(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules: Sequence[tuple[str, str, str]] = RULES, max_bad: float = MAX_BAD, factor: float = FACTOR, z: float = Z) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, labelled, bad, bad_bound.

    A page's outcome is the label of the document whose number its path holds: bad if of low quality or toxic. Null urls
    and urls without ``://`` have an empty host and path, a host like any other; a host without labels has its domain's
    rate; without any label all rates are one half with a weak prior, so nothing is blocked. Repeated pages are judged
    and counted each; an empty table gives no rows; other columns are not read."""
    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    bad = F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0))
    known = labels.withColumn("number", F.col("doc_id").try_cast("long")).where("number is not null").groupBy("number").agg(bad.cast("long").alias("was_bad"))
    rows = stash(parts.withColumn("number", page_number(F.col("path"))), "urls")
    numbered = rows.where("number IS NOT NULL").groupBy("host", "number").agg(F.count("*").alias("pages")).join(known.where("was_bad IS NOT NULL"), "number")
    found = numbered.select("host", F.lit(0).cast("long").alias("pages"), F.col("pages").alias("labelled"), (F.col("was_bad") * F.col("pages")).alias("bad"))
    every = rows.groupBy("host").agg(F.count("*").alias("pages")).select("host", "pages", *[F.lit(0).cast("long").alias(c) for c in ("labelled", "bad")])
    counted = found.unionByName(every).groupBy("host").agg(*[F.sum(c).alias(c) for c in ("pages", "labelled", "bad")])
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = stash(counted.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    rated = stash(host_rates(hosts, z).select("host", "pages", "labelled", "bad", "bound", "all"), "host-rates")
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") >= F.least(F.lit(max_bad), factor * F.col("all")), "block").otherwise("allow")
    return join_facts(rows.drop("number"), rated, "host", "pages").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(says, own).alias("verdict"), "labelled", "bad",
        F.round("bound", 6).alias("bad_bound"))


def _sql() -> str:
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    longest = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    case = lambda n: " ".join(f"WHEN {fits(h, p)} THEN '{(h + p, v)[n]}'" for h, p, v in longest)
    two = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    rho = lambda t: f"""(SELECT coalesce(least({MOST_SPREAD}, greatest({LEAST_SPREAD}, (sum(n * (k / n - mean) ** 2) - sum(mean * (1 - mean)))
      / nullif(sum(mean * (1 - mean) * (n - 1)), 0))), {MOST_SPREAD}) AS rho FROM {t} WHERE n > 0)"""  # noqa: E731
    level = lambda t: f"SELECT *, (k + (1 / rho - 1) * mean) / (n + 1 / rho - 1) AS rate FROM {t}, {rho(t)}"
    return rf"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
known AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END) AS bad
          FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
c AS (SELECT host, count(known.bad) AS n, coalesce(sum(known.bad), 0) AS k, regexp_replace(host, '^[^@]*@|:[0-9]*$', '', 'g') AS bare
      FROM p LEFT JOIN known ON known.doc_id = TRY_CAST(regexp_extract(path, '{NUMBER}', 1) AS BIGINT) GROUP BY host),
s AS (SELECT *, string_split(bare, '.') AS ls, regexp_matches(bare, '^[0-9.]+$|^\[') AS num FROM c),
t AS (SELECT *, array_to_string(ls[-2:], '.') IN ({two}) AS two FROM s),
h AS (SELECT host, n, k, CASE WHEN num THEN bare WHEN two THEN array_to_string(ls[-3:], '.') ELSE array_to_string(ls[-2:], '.') END AS domain,
        CASE WHEN num THEN '' WHEN two THEN array_to_string(ls[-2:], '.') ELSE ls[-1] END AS suffix FROM t),
m AS (SELECT (coalesce(sum(k), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) AS mean FROM h),
s0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(mean) AS mean FROM h, m GROUP BY suffix), s1 AS ({level("s0")}),
d0 AS (SELECT h.domain, suffix, sum(h.n) AS n, sum(h.k) AS k, any_value(s1.rate) AS mean FROM h JOIN s1 USING (suffix) GROUP BY h.domain, suffix),
d1 AS ({level("d0")}),
h0 AS (SELECT host, h.n, h.k, d1.rate AS mean FROM h JOIN d1 USING (domain)), h1 AS ({level("h0")}),
b AS (SELECT host, n, k, greatest(0, rate - {Z} * sqrt(rate * (1 - rate) / (n + 1 / rho))) AS bound FROM h1)
SELECT page_id, host, path, CASE {case(0)} END AS rule, coalesce(CASE {case(1)} END, CASE WHEN bound >= least({MAX_BAD}, {FACTOR} * (SELECT mean FROM m)) THEN 'block' ELSE 'allow' END) AS verdict,
  CAST(n AS BIGINT) AS labelled, CAST(k AS BIGINT) AS bad, round(bound, 6) AS bad_bound FROM p JOIN b USING (host)"""


JUDGED_SQL = _sql()
