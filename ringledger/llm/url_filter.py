"""URL filter: host rules first, then host reputation by empirical Bayes; built-ins only.

Pages that a rule decides are labelled outcomes (or those that ``outcome`` gives). They are
counted per host, and shares are shrunk top-down through beta-binomial priors: all pages to
suffix, suffix to registered domain, domain to host. How strongly a level is shrunk comes from
the data: the moment estimate of the beta-binomial overdispersion of its members around their
parents. A page that no rule fits is blocked if even the upper bound of its host's posterior
share of good pages is below ``min_good``.

Counting happens per host before anything is joined, so a host with a third of all pages costs
a row per task; the join back to the pages is an ordinary one, which Spark broadcasts while the
host table is small and splits by its skew handling when it is not.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule
and is judged as the empty host. Without labelled pages the posterior is 1/2 with a wide bound,
and all pages are allowed. Repeated rows are judged one by one.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.frames import lower_ascii, packed
from ringledger.operators.staging import staged

# Rules as (host and path, verdict); a rule fits its host and all subdomains.
Rule = tuple[str, str]
MIN_GOOD = 0.5
DEVIATIONS = 1.645
# Bounds on the overdispersion of a level, so that a prior is neither absent nor absolute.
LEAST_SPREAD, MOST_SPREAD = 0.001, 0.999
# Suffixes of two labels under which names are registered.
DOUBLE_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.nz", "co.in")


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _choice(rules: Sequence[Rule], value: int) -> Column:
    """What the longest fitting rule says; a rule list is configuration, so it is bounded."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: len(rule[0])):
        host, path = rule[0].split("/", 1)
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col(
            "path"
        ).startswith(f"/{path}")
        chosen = F.when(fits, F.lit(rule[value])).otherwise(chosen)
    return chosen


def _names(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix."""
    two, three = F.substring_index(host, ".", -2), F.substring_index(host, ".", -3)
    double = two.isin(*DOUBLE_SUFFIXES)
    return (F.when(double, three).otherwise(two),
            F.when(double, two).otherwise(F.substring_index(host, ".", -1)))


def _shrunk(members: DataFrame) -> DataFrame:
    """Adds the prior strength ``weight`` to ``n, good, parent`` (the parent's mean)."""
    expected = F.col("n") * F.col("parent")
    excess = (F.col("good") - expected) ** 2 / (expected * (1 - F.col("parent"))) - 1
    spread = members.where("n > 0").agg(
        F.coalesce(F.try_divide(F.sum(excess), F.sum(F.col("n") - 1)), F.lit(LEAST_SPREAD))
        .alias("rho")
    )
    rho = F.greatest(F.lit(LEAST_SPREAD), F.least(F.lit(MOST_SPREAD), spread.scalar()))
    return members.withColumn("weight", 1 / rho - 1)


def _level(counts: DataFrame, key: str, parents: DataFrame | None, parent_key: str) -> DataFrame:
    if parents is None:
        whole = counts.agg((F.sum("good") + 0.5) / (F.sum("n") + 1.0))
        members = counts.withColumn("parent", F.coalesce(whole.scalar(), F.lit(0.5)))
    else:
        above = parents.select(parent_key, F.col("mean").alias("parent"))
        members = counts.join(above, parent_key)
    shrunk = _shrunk(members).withColumn(
        "mean", (F.col("good") + F.col("weight") * F.col("parent")) / (F.col("n") + F.col("weight"))
    )
    return staged(shrunk, f"reputation-{key}")


def reputations(pages: DataFrame) -> DataFrame:
    """``host, upper`` over columns ``host, good`` (true, false, or null where unlabelled)."""
    domain, suffix = _names(F.col("host"))
    counts = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    hosts = staged(pages.groupBy("host").agg(
        F.count("good").alias("n"), F.count_if("good").alias("good")
    ).select("*", domain.alias("domain"), suffix.alias("suffix")), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(*counts)
    suffixes = _level(domains.groupBy("suffix").agg(*counts), "suffix", None, "")
    middle = _level(domains, "domain", suffixes, "suffix")
    judged = _level(hosts, "host", middle.select("domain", "mean"), "domain")
    size = F.col("n") + F.col("weight")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (size + 1))
    return judged.select("host", (F.col("mean") + DEVIATIONS * deviation).alias("upper"))


def url_filter(pages: DataFrame, rules: Sequence[Rule], outcome: Column | None = None,
               min_good: float = MIN_GOOD) -> DataFrame:
    """``row`` (all columns of ``pages``), ``host, path, rule, verdict``.

    ``outcome`` is a boolean over the columns of ``pages`` (good, bad, null: unlabelled).
    Without it, the rules' verdicts are the outcomes.
    """
    split = packed(pages, host=host_of(F.col("url")), path=path_of(F.col("url")),
                   given=F.lit(None).cast("boolean") if outcome is None else outcome)
    ruled = split.select("row", "host", "path", "given", _choice(rules, 0).alias("rule"),
                         _choice(rules, 1).alias("ruled"))
    good = F.col("given") if outcome is not None else F.col("ruled") == "allow"
    known = reputations(ruled.select("host", good.alias("good")))
    verdict = F.coalesce(
        "ruled", F.when(F.col("upper") < min_good, F.lit("block")).otherwise("allow")
    )
    return ruled.join(known, "host").select("row", "host", "path", "rule", verdict.alias("verdict"))


def oracle(rules: Sequence[Rule]) -> str:
    """The same verdicts in SQL over ``pages``."""
    ordered = sorted(rules, key=lambda rule: -len(rule[0]))

    def choice(value: int) -> str:
        tests = []
        for rule in ordered:
            host, path = rule[0].split("/", 1)
            tests.append(
                f"WHEN (host = '{host}' OR ends_with(host, '.{host}'))"
                f" AND starts_with(path, '/{path}') THEN '{rule[value]}'"
            )
        return f"CASE {' '.join(tests)} END"

    def last(labels: int) -> str:
        return f"array_to_string(list_slice(string_split(host, '.'), -{labels}, -1), '.')"

    def level(name: str, key: str, members: str) -> str:
        expected = "(n * parent)"
        return f"""
{name}_members AS ({members}),
{name}_spread AS (
  SELECT greatest({LEAST_SPREAD}::DOUBLE, least({MOST_SPREAD}::DOUBLE, coalesce(
    sum(pow(good - {expected}, 2) / ({expected} * (1 - parent)) - 1) / nullif(sum(n - 1), 0),
    {LEAST_SPREAD}::DOUBLE))) AS rho FROM {name}_members WHERE n > 0
),
{name} AS MATERIALIZED (
  SELECT *, (good + weight * parent) / (n + weight) AS mean
  FROM (SELECT m.*, 1 / rho - 1 AS weight FROM {name}_members m, {name}_spread)
)"""

    doubles = ", ".join(f"'{name}'" for name in DOUBLE_SUFFIXES)
    return f"""
WITH split AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS MATERIALIZED (
  SELECT *, {choice(0)} AS rule, {choice(1)} AS ruled FROM split
), hosts AS MATERIALIZED (
  SELECT host, CASE WHEN {last(2)} IN ({doubles}) THEN {last(3)} ELSE {last(2)} END AS domain,
         CASE WHEN {last(2)} IN ({doubles}) THEN {last(2)} ELSE {last(1)} END AS suffix,
         count(ruled)::DOUBLE AS n, count(*) FILTER (ruled = 'allow')::DOUBLE AS good
  FROM ruled GROUP BY host
),
{level("s", "suffix", "SELECT *, (sum(good) OVER () + 0.5) / (sum(n) OVER () + 1.0) AS parent"
       " FROM (SELECT suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY suffix)")},
{level("d", "domain", "SELECT c.*, s.mean AS parent FROM (SELECT domain, suffix, sum(n) AS n,"
       " sum(good) AS good FROM hosts GROUP BY domain, suffix) c JOIN s USING (suffix)")},
{level("h", "host", "SELECT c.*, d.mean AS parent FROM hosts c JOIN d USING (domain)")}
SELECT page_id, host, path, rule, coalesce(ruled, CASE
         WHEN mean + {DEVIATIONS} * sqrt(mean * (1 - mean) / (n + weight + 1)) < {MIN_GOOD}
         THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN h USING (host)
"""
