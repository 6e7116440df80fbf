"""URL filter by host reputation: beta-binomial shrinkage from host to registered domain to suffix, and fixed rules.

Outcomes are labelled pages (good or not).  Each level's rate is shrunk towards the level above; how strongly is
estimated from the data (moments of the overdispersion between the groups of that level).  A host is blocked if even the
upper bound of its posterior rate of good pages lies below ``threshold``.  Built-in functions only; counts are combined
before each shuffle, and only hosts, never pages, meet their domain and suffix.

Defined results: a null url, or one without ``://``, has an empty host and path; a host
whose pages have no label takes the rate of its domain, suffix or the whole table, one that ``outcomes`` does not name is
allowed; without any label the prior is one half; repeated rows are judged each for itself; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.llm.support import shared_folder, stored

#: Standard normal quantile of the posterior bound, and the rate of good pages that a host must be able to reach.
BOUND = 1.645
THRESHOLD = 0.5
#: Limits of the estimated overdispersion: groups that differ almost not at all, and groups that tell nothing of one another.
DISPERSION = (0.001, 0.5)


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The text of the longest rule that fits, else null.  The list is a parameter, so it is small."""
    fitting = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        here = (host == rule.host) | host.endswith(f".{rule.host}")
        fitting = F.when(here & path.startswith(rule.path), rule.text).otherwise(fitting)
    return fitting


def dispersion(groups: DataFrame) -> DataFrame:
    """One row: the prior strength of a level from its groups' ``n`` and ``k``, and the overall rate.

    Groups without an outcome say nothing of how much groups differ, so they are left out.
    """
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    groups = groups.where(F.col("n") > 0).select(n.alias("n"), k.alias("k"))
    n, k = F.col("n"), F.col("k")
    sums = groups.agg(
        F.count("*").alias("g"),
        F.coalesce(F.sum("n"), F.lit(0.0)).alias("n"),
        F.coalesce(F.sum("k"), F.lit(0.0)).alias("k"),
        F.coalesce(F.sum(n * n), F.lit(0.0)).alias("nn"),
        F.coalesce(F.sum(k * k / n), F.lit(0.0)).alias("kk"),
    )
    rate = (F.col("k") + 1) / (F.col("n") + 2)
    spread = F.col("kk") - 2 * rate * F.col("k") + rate * rate * F.col("n")
    room = F.col("n") - F.when(F.col("n") > 0, F.col("nn") / F.col("n")).otherwise(0) - (F.col("g") - 1)
    excess = spread / (rate * (1 - rate)) - (F.col("g") - 1)
    rho = F.greatest(F.lit(DISPERSION[0]), F.least(F.lit(DISPERSION[1]), F.when(room > 0, excess / room).otherwise(DISPERSION[0])))
    return sums.select((1 / rho - 1).alias("strength"), rate.alias("rate"))


def levels(host: Column, suffixes: tuple[str, ...] = ()) -> tuple[Column, Column]:
    """Registered domain and suffix: the last label is the suffix, unless the host ends in one of ``suffixes`` (longest wins)."""
    domain, suffix = F.substring_index(host, ".", -2), F.element_at(F.split(host, "\\."), -1)
    for known in sorted(suffixes, key=lambda s: (len(s), s)):
        here = (host == known) | host.endswith(f".{known}")
        domain = F.when(here, F.substring_index(host, ".", -(known.count(".") + 2))).otherwise(domain)
        suffix = F.when(here, known).otherwise(suffix)
    return domain, suffix


def shrunk(k: Column, n: Column, towards: Column, strength: Column) -> Column:
    return (k + strength * towards) / (n + strength)


def host_bounds(outcomes: DataFrame, bound: float = BOUND, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """``host`` and the upper bound ``good_bound`` of its posterior rate, from outcomes ``host``, ``good`` (null: not labelled).

    The counts per host are stored, so that all levels and their strengths come from one reading of the outcomes.
    """
    hosts = outcomes.groupBy("host").agg(
        F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("k")
    )
    domain, suffix = levels(F.col("host"), suffixes)
    hosts = hosts.withColumns({"suffix": suffix, "domain": domain})
    hosts = stored(hosts, shared_folder(outcomes.sparkSession), "hosts")
    total = lambda by, df: df.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    domains = total(["domain", "suffix"], hosts)
    suffixes = total(["suffix"], domains)
    value = lambda df, name: df.select(name).scalar()
    tops, middles, leaves = dispersion(suffixes), dispersion(domains), dispersion(hosts)
    rate = shrunk(F.col("k"), F.col("n"), value(tops, "rate"), value(tops, "strength"))
    suffixes = suffixes.select("suffix", rate.alias("suffix_rate"))
    rate = shrunk(F.col("k"), F.col("n"), F.col("suffix_rate"), value(middles, "strength"))
    domains = domains.join(suffixes, "suffix").select("domain", rate.alias("domain_rate"))
    strength = value(leaves, "strength")
    hosts = hosts.join(domains, "domain").withColumn("weight", F.col("n") + strength)
    mean = shrunk(F.col("k"), F.col("n"), F.col("domain_rate"), strength)
    deviation = F.sqrt(mean * (1 - mean) / (F.col("weight") + 1))
    return hosts.select("host", (mean + bound * deviation).alias("good_bound"))


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[Rule],
    bound: float = BOUND,
    threshold: float = THRESHOLD,
    suffixes: tuple[str, ...] = (),
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` for each row of ``page_id``, ``url``.

    ``outcomes`` holds ``host`` and ``good`` (1, 0 or null).  ``suffixes`` names the suffixes of several labels, such as
    ``co.uk``, lower case; without them the last label is the suffix and the last two are the domain.
    """
    host, path = host_and_path(pages["url"].cast("string"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.join(host_bounds(outcomes, bound, suffixes), "host", "left")
    rule = longest_rule(rules, F.col("host"), F.col("path"))
    actions = {r.text: r.action for r in rules}
    by_rule = reduce(lambda so_far, t: F.when(F.col("rule") == t, actions[t]).otherwise(so_far), actions, F.lit(None))
    by_host = F.when(F.col("good_bound") < threshold, "block").otherwise("allow")
    return rows.withColumn("rule", rule).select(
        "page_id", "host", "path", "rule", F.coalesce(by_rule, by_host).alias("verdict")
    )


def judge_sql(rules: list[Rule], bound: float = BOUND, threshold: float = THRESHOLD) -> str:
    """The same judgement in standard SQL over ``pages`` and ``labels``."""
    fits = "\n".join(
        f"WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') THEN '{r.text}'"
        for r in sorted(rules, key=lambda r: (-len(r.text), r.text))
    )
    actions = "\n".join(f"WHEN rule = '{r.text}' THEN '{r.action}'" for r in rules)
    low, high = DISPERSION

    def level(name: str, source: str) -> str:
        return f"""{name} AS (
  SELECT 1 / greatest({low}, least({high}, CASE WHEN room > 0 THEN excess / room ELSE {low} END)) - 1 AS strength, rate
  FROM (SELECT rate, n - CASE WHEN n > 0 THEN nn / n ELSE 0 END - (g - 1) AS room,
          (kk - 2 * rate * k + rate * rate * n) / (rate * (1 - rate)) - (g - 1) AS excess
        FROM (SELECT *, (k + 1) / (n + 2) AS rate FROM
          (SELECT count(*) AS g, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(k), 0)::DOUBLE AS k, coalesce(sum(n * n), 0)::DOUBLE AS nn,
             coalesce(sum(k * k / n::DOUBLE), 0) AS kk FROM {source} WHERE n > 0))))"""

    return f"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{ascii_uppercase}', '{ascii_lowercase}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
judged AS (
  SELECT host, CASE WHEN quality IS NULL THEN NULL WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END AS good
  FROM parts LEFT JOIN labels ON doc_id = try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})(/|[.]html)?$', 1), '') AS BIGINT)),
hosts AS (
  SELECT *, string_split(host, '.')[-1] AS suffix, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain
  FROM (SELECT host, count(good) AS n, coalesce(sum(good), 0) AS k FROM judged GROUP BY host)),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix),
{level("tops", "suffixes")},
{level("middles", "domains")},
{level("leaves", "hosts")},
suffix_rates AS (SELECT suffix, (k + strength * rate) / (n + strength) AS suffix_rate FROM suffixes, tops),
domain_rates AS (
  SELECT domain, (k + strength * suffix_rate) / (n + strength) AS domain_rate FROM domains JOIN suffix_rates USING (suffix), middles),
means AS (
  SELECT host, n + strength AS weight, (k + strength * domain_rate) / (n + strength) AS mean
  FROM hosts JOIN domain_rates USING (domain), leaves),
ruled AS (SELECT page_id, host, path, CASE {fits} END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE {actions}
  WHEN mean + {bound} * sqrt(mean * (1 - mean) / (weight + 1)) < {threshold} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN means USING (host)
"""
