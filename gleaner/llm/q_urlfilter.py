"""Query op1_url_filter."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import table
from gleaner.llm.urlfilter import host_and_path, judge_urls

# The rules of the contract.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
# The sample block list's sites, every one under every one of the domains.
LISTED_SITES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
LISTED_UNDER = ["example.com", "example.net", "example.org"]
#: Sites of the list by number, and the pages of it: those whose MD5 begins below this.
LISTED_NUMBERS, LISTED_MD5 = 50_000, "2"


def block_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list by rule, as a table of keys: sites, numbered sites, and pages of the crawl by a hash."""
    names = F.array(*[F.lit(f"{a}.{b}") for a in LISTED_SITES for b in LISTED_UNDER])
    host, path = host_and_path(F.col("url"))
    pages = table(spark, sf_dir, "pages").select(host.alias("h"), path.alias("p")).where("p <> ''").select(F.concat("h", "p").alias("key"))
    numbered = spark.range(LISTED_NUMBERS).select(F.concat(F.lit("spam-"), "id", F.lit(".example.net")).alias("key"))
    return spark.range(1).select(F.explode(names).alias("key")).union(numbered).union(pages.where(F.md5(F.col("key").cast("binary")) < LISTED_MD5))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url under the rules, and under the block list where no rule fits."""
    return judge_urls(table(spark, sf_dir, "pages"), block_list(spark, sf_dir), RULES)


def _sql() -> str:
    rules = ", ".join("('%s', '%s', '%s', %d, '%s')" % (say, own, slash + tail, len(rule), rule) for say, rule in RULES for own, slash, tail in [rule.partition("/")])
    names = ", ".join(f"'{a}.{b}'" for a in LISTED_SITES for b in LISTED_UNDER)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(say, own, start, n, name) AS (VALUES {rules}),
sites(site) AS (SELECT unnest([{names}]) UNION ALL SELECT 'spam-' || i || '.example.net' FROM range({LISTED_NUMBERS}) t(i)),
listed_pages AS (SELECT DISTINCT host, path FROM parts WHERE path <> '' AND md5(host || path) < '{LISTED_MD5}'),
domains AS (SELECT host, array_to_string(d[i:], '.') AS name FROM (SELECT host, d, unnest(range(1, len(d) + 1)) AS i FROM (SELECT DISTINCT host, string_split(host, '.') AS d FROM parts))),
listed_hosts AS (
  SELECT DISTINCT host FROM domains JOIN sites ON name = site
), fit AS (
  SELECT p.page_id, p.host, p.path,
         arg_max(r.name, r.n) AS rule, arg_max(r.say, r.n) AS say
  FROM parts p LEFT JOIN rules r ON (p.host = r.own OR ends_with(p.host, '.' || r.own)) AND starts_with(p.path, r.start)
  GROUP BY p.page_id, p.host, p.path
)
SELECT f.page_id, f.host, f.path, f.rule, coalesce(f.say, CASE WHEN l.host IS NULL AND p.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict, l.host IS NOT NULL OR p.host IS NOT NULL AS listed
FROM fit f LEFT JOIN listed_hosts l ON f.host = l.host LEFT JOIN listed_pages p ON f.host = p.host AND f.path = p.path
"""


QUERIES = {"op1_url_filter": op1_url_filter}
ORACLES = {"op1_url_filter": _sql()}
