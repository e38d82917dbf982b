"""URL verdicts from written rules and an empirical-Bayes reputation of hosts.

Labelled pages give each host counts of good and bad outcomes. Beta-binomial priors run from the whole table to the public
suffix, to the registered domain and to the host: each level's bad rate is shrunk to the posterior mean of the level above,
and the weight of that prior (its pseudo-count) is estimated from the spread of the level's own rates by moments. The limit
comes from the data: a host is blocked where its posterior, a beta distribution, puts a probability of SURE or more on bad
rates above MAX_RATIO times the rate of the whole table, that is, where the (1 - SURE) quantile lies above the limit. The
probability is summed over GRID points. Unlabelled hosts inherit their domain's posterior, so a bad domain blocks hosts that
were never labelled; hosts whose labels don't differ from the table's are never blocked, however many they are.

Public suffixes follow a rule: the last label, or two where a country's label stands behind a general one (WIDE). User names
and ports are no part of a name; an address of numbers is a domain and a suffix of its own.

The label of a page is the row of `labels` with doc_id = page_id; bad means quality 0 or toxic 1. Nulls: a null url, or one
without `://`, has an empty host and path and fits no rule; such rows share the empty host's posterior. Null label columns
count as not bad; labels without a page and repeated labels (the worst one counts) do no harm; repeated pages count as often
as they occur. Empty tables give an empty result, and no labels at all block nothing. Of rules of one length the later one
holds. Urls of any length are one row of work; other columns are ignored. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import join_skewed, let_in
from corvid.session import settle

#: (action, host, path prefix): the rules of the query.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: General labels that stand before a country's label in a public suffix.
WIDE = r"^(?:ac|co|com|edu|gob|gov|go|ne|net|or|org)\.[a-z][a-z]$"
ADDRESS = r"^(?:[0-9.]+|\[.*)$"
MAX_RATIO = 1.05
SURE = 0.8
GRID = 500


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as written, and its action; both null if none fits. Rules are a short declared list."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        action = F.when(fits, F.lit(act)).otherwise(action)
    return text, action


def name_of(host: Column) -> Column:
    """A host without user name and port."""
    return F.regexp_replace(host, r"^.*@|:[0-9]*$", "")


def suffix_of(host: Column) -> Column:
    name = name_of(host)
    two = F.substring_index(name, ".", -2)
    return F.when(name.rlike(ADDRESS), name).when(two.rlike(WIDE), two).otherwise(F.substring_index(name, ".", -1))


def domain_of(host: Column) -> Column:
    name = name_of(host)
    two = F.substring_index(name, ".", -2)
    return F.when(name.rlike(ADDRESS), name).when(two.rlike(WIDE), F.substring_index(name, ".", -3)).otherwise(two)


def probability_above(a: Column, b: Column, limit: Column) -> Column:
    """The share of a beta distribution's mass above a limit, over GRID midpoints."""

    def shares(logs: Column) -> Column:
        def add(acc: Column, x: Column) -> Column:
            return F.struct((acc["at"] + 1).alias("at"), (acc["up"] + F.when((acc["at"] + 0.5) / GRID > limit, x).otherwise(0.0)).alias("up"), (acc["all"] + x).alias("all"))

        zero = F.struct(F.lit(0).alias("at"), F.lit(0.0).alias("up"), F.lit(0.0).alias("all"))
        return let_in(F.array_max(logs), lambda top: F.aggregate(F.transform(logs, lambda x: F.exp(x - top)), zero, add, lambda acc: acc["up"] / acc["all"]))

    places = F.transform(F.sequence(F.lit(0), F.lit(GRID - 1)), lambda i: (i + 0.5) / GRID)
    return let_in(F.transform(places, lambda x: (a - 1) * F.ln(x) + (b - 1) * F.ln(1 - x)), shares)


def _level(stats: DataFrame, key: str, above: str | None) -> DataFrame:
    """Sums of stats (n, bad) by key, keeping the key above."""
    keys = [key] + ([above] if above else [])
    return stats.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def _weight(level: DataFrame, name: str) -> DataFrame:
    """One row: the pseudo-count of the level's prior by the method of moments, within [2, 1000]. With p the pooled rate,
    the variance of rates beyond the binomial one is p(1-p)/(weight+1)."""
    seen = level.where("n > 0")
    one = seen.agg(
        F.sum("n").alias("sn"), F.sum("bad").alias("sb"), F.count("*").alias("k"),
        F.sum(F.pow(F.col("bad"), 2) / F.col("n")).alias("sq"),
    )
    p = (F.col("sb") + 0.5) / (F.col("sn") + 1.0)
    # the chi-square of the rates about p over its degrees of freedom: 1 if binomial
    spread = (F.col("sq") - 2 * p * F.col("sb") + p * p * F.col("sn")) / F.greatest(F.col("k") - 1, F.lit(1)) / (p * (1 - p))
    mean_n = F.col("sn") / F.greatest(F.col("k"), F.lit(1))
    rho = F.least(F.greatest((spread - 1) / F.greatest(mean_n - 1, F.lit(1.0)), F.lit(0.001)), F.lit(1 / 3))
    return one.select(F.coalesce(1 / rho - 1, F.lit(2.0)).alias(f"{name}_weight"), F.coalesce(p, F.lit(0.0)).alias(f"{name}_pooled"))


def host_posteriors(pages: DataFrame, labels: DataFrame, max_ratio: float = MAX_RATIO) -> DataFrame:
    """host, domain, suffix, n_labelled, n_bad, bad_mean, sure_bad (the probability of a rate above the limit) of each host in
    pages(page_id, host)."""
    outcome = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad")
    )
    seen = pages.select("page_id", "host").join(outcome, "page_id", "left")
    hosts = settle(
        seen.groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "bad")
    )
    domains = settle(_level(hosts, "domain", "suffix"))
    suffixes = _level(domains, "suffix", None)
    weights = _weight(hosts, "host").crossJoin(_weight(domains, "domain")).crossJoin(_weight(suffixes, "suffix"))  # one row each
    top = suffixes.crossJoin(F.broadcast(weights)).select(
        "suffix",
        ((F.col("bad") + F.col("suffix_weight") * F.col("suffix_pooled")) / (F.col("n") + F.col("suffix_weight"))).alias("suffix_mean"),
        "domain_weight",
        "host_weight",
        (max_ratio * F.col("host_pooled")).alias("limit"),
    )
    middle = join_skewed(domains, top, "suffix").select(
        "domain",
        ((F.col("bad") + F.col("domain_weight") * F.col("suffix_mean")) / (F.col("n") + F.col("domain_weight"))).alias("domain_mean"),
        "host_weight",
        "limit",
    )
    joined = join_skewed(hosts, middle, "domain")
    a = F.col("bad") + F.col("host_weight") * F.col("domain_mean")
    total = F.col("n") + F.col("host_weight")
    mean = a / total
    return joined.select(
        "host", "domain", "suffix", F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad"), mean.alias("bad_mean"),
        F.when((a > 0) & (total > a), probability_above(a, total - a, F.col("limit"))).otherwise(F.lit(0.0)).alias("sure_bad"),
    )


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, max_ratio: float = MAX_RATIO, sure: float = SURE) -> DataFrame:
    """page_id, url, host, path, rule, verdict, decided_by, bad_mean, sure_bad of each row of pages(page_id, url)."""
    placed = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = settle(host_posteriors(placed, labels, max_ratio))
    text, action = rule_of(F.col("host"), F.col("path"), rules)
    fallback = F.when(F.col("sure_bad") >= sure, "block").otherwise("allow")
    return join_skewed(placed, known, "host").select(
        "page_id", "url", "host", "path", text.alias("rule"), F.coalesce(action, fallback).alias("verdict"),
        F.when(action.isNotNull(), "rule").otherwise("reputation").alias("decided_by"), "bad_mean", "sure_bad",
    )


def op4_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return judge_urls(pages, labels).select("page_id", "host", "path", "rule", "verdict", "decided_by", F.round("bad_mean", 6).alias("bad_mean"), F.round("sure_bad", 6).alias("sure_bad"))


QUERIES = {"op4_host_reputation": op4_host_reputation}


def _weight_sql(level: str) -> str:
    """The SQL of _weight for one level."""
    return f"""SELECT coalesce(1 / least(greatest(((sq - 2 * p * sb + p * p * sn) / greatest(k - 1, 1) / (p * (1 - p)) - 1) / greatest(sn / greatest(k, 1)::DOUBLE - 1, 1.0::DOUBLE),
            0.001::DOUBLE), 1 / 3::DOUBLE) - 1, 2) AS weight, coalesce(p, 0) AS pooled
        FROM (SELECT sum(n)::DOUBLE AS sn, sum(bad)::DOUBLE AS sb, count(*) AS k, sum(bad * bad / n::DOUBLE) AS sq, (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1) AS p FROM {level} WHERE n > 0)"""


ORACLES = {
    "op4_host_reputation": f"""
        WITH o AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
        p AS (SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
            coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        names AS (SELECT DISTINCT host, regexp_replace(host, '^.*@|:[0-9]*$', '', 'g') AS name FROM p),
        parts AS (SELECT host, name, string_split(name, '.') AS l, regexp_matches(name, '{ADDRESS}') AS address, regexp_matches(array_to_string(string_split(name, '.')[-2:], '.'), '{WIDE}') AS wide FROM names),
        h AS (SELECT host, CASE WHEN address THEN name WHEN wide THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain,
            CASE WHEN address THEN name WHEN wide THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix, count(bad) AS n, coalesce(sum(bad), 0) AS bad
            FROM p JOIN parts USING (host) LEFT JOIN o USING (page_id) GROUP BY 1, 2, 3),
        d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY 1, 2), s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY 1),
        hw AS ({_weight_sql("h")}), dw AS ({_weight_sql("d")}), sw AS ({_weight_sql("s")}),
        sm AS (SELECT suffix, (bad + weight * pooled) / (n + weight) AS m FROM s, sw),
        dm AS (SELECT domain, (bad + weight * m) / (n + weight) AS m FROM d JOIN sm USING (suffix), dw),
        hm AS (SELECT host, (bad + weight * m) / (n + weight) AS mean, bad + weight * m AS a, n + weight - bad - weight * m AS b, {MAX_RATIO}::DOUBLE * pooled AS most FROM h JOIN dm USING (domain), hw),
        grid AS (SELECT host, x > most AS above, (a - 1) * ln(x) + (b - 1) * ln(1 - x) AS lw FROM hm, (SELECT (range + 0.5::DOUBLE) / {GRID} AS x FROM range({GRID})) WHERE a > 0 AND b > 0),
        tops AS (SELECT host, max(lw) AS top FROM grid GROUP BY host),
        tails AS (SELECT host, coalesce(sum(exp(lw - top)) FILTER (WHERE above), 0) / sum(exp(lw - top)) AS sure FROM grid JOIN tops USING (host) GROUP BY host),
        r AS (SELECT page_id, host, path, mean, coalesce(sure, 0) AS sure, coalesce(sure, 0) >= {SURE}::DOUBLE AS bad,
            host = 'example.com' OR host LIKE '%.example.com' AS example, host = 'com' OR host LIKE '%.com' AS com, host = 'net' OR host LIKE '%.net' AS net FROM p JOIN hm USING (host) LEFT JOIN tails USING (host)),
        v AS (SELECT *, CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
            WHEN example AND starts_with(path, '/en/') THEN 'example.com/en/' WHEN net AND starts_with(path, '/es/') THEN 'net/es/'
            WHEN net AND starts_with(path, '/fr/') THEN 'net/fr/' WHEN com AND starts_with(path, '/') THEN 'com/' END AS rule FROM r)
        SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL OR bad THEN 'block' ELSE 'allow' END AS verdict,
            CASE WHEN rule IS NULL THEN 'reputation' ELSE 'rule' END AS decided_by, round(mean, 6) AS bad_mean, round(sure, 6) AS sure_bad FROM v
    """
}
