"""URL rules by hash prefix: expressions of each URL equi-join the rules' short digests, full digests confirm.

A rule is (host, path, verdict). It fits its host and every subdomain where the URL's path starts with the rule's;
of several the longest wins, then block before allow. Only expressions that some rule could equal are made: host
suffixes with as many labels, and path prefixes with as many characters, as a rule has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import cut, hundreds, maybe_broadcast, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX = 8  # hex digits of the digest that the join uses

#: Fixed values of the query's contract: (host, path, verdict).
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and where there is no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (host and path, or null) and verdict of each row of pages(page_id, url).

    Null urls and urls without ``://`` have an empty host and path and the default verdict. Repeated rows and null
    page_ids keep their rows; an empty table gives none. Other columns are not read. Rules with a null or empty
    host, or a null path or verdict, fit nothing. URLs are judged once each however often they occur.
    """
    rules = rules.where("host <> '' and path is not null and verdict is not null").select("host", "path", "verdict").distinct()
    rules = cut(rules.select(F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")))
    shape = rules.agg(F.collect_set(F.size(F.split("r_host", "\\."))).alias("labels"), F.collect_set(F.length("r_path")).alias("lengths")).first()
    digests = rules.withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path"))).withColumn("r_prefix", F.substring("r_digest", 1, PREFIX))

    host, path = split_url(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    suffixes = F.array(*[F.substring_index("host", ".", -k) for k in shape["labels"]]) if shape["labels"] else F.array().cast("array<string>")
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= k, F.substring("path", 1, k)) for k in shape["lengths"]]), lambda p: p.isNotNull()) if shape["lengths"] else F.array().cast("array<string>")
    urls = pages.where("host <> ''").select("host", "path").distinct()
    made = urls.withColumn("suffix", F.explode(F.array_distinct(suffixes))).withColumn("start", F.explode(F.array_distinct(prefixes)))
    made = made.withColumn("digest", _digest(F.col("suffix"), F.col("start"))).withColumn("prefix", F.substring("digest", 1, PREFIX))
    hits = made.join(maybe_broadcast(digests, hundreds(rules, "r_host", "r_path", "r_verdict")), (F.col("prefix") == F.col("r_prefix")) & (F.col("digest") == F.col("r_digest")))
    order = F.struct(F.length("r_host") + F.length("r_path"), F.when(F.col("r_verdict") == "block", 1).otherwise(0), F.concat("r_host", "r_path"))
    best = hits.groupBy(F.col("host").alias("b_host"), F.col("path").alias("b_path")).agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict")), order).alias("b"))
    best = cut(best)
    joined = pages.join(maybe_broadcast(best, hundreds(best, "b_host", "b_path")), (F.col("host") == F.col("b_host")) & (F.col("path") == F.col("b_path")), "left")
    return joined.select("page_id", "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.verdict", F.lit(default)).alias("verdict"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


OP9_SQL = """
with u as (
  select page_id, case when url is null or strpos(url, '://') = 0 then '' else substr(url, strpos(url, '://') + 3) end as rest from pages
), s as (
  select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, row_number() over () as n from u
), r(r_host, r_path, v) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), m as (
  select s.n, r.*, row_number() over (partition by s.n order by length(r_host) + length(r_path) desc, v desc, r_host || r_path desc) as k
  from s join r on (s.host = r_host or s.host like '%.' || r_host) and starts_with(s.path, r_path)
)
select s.page_id, s.host, s.path, m.r_host || m.r_path as rule, coalesce(m.v, 'allow') as verdict
from s left join m on s.n = m.n and m.k = 1
"""
