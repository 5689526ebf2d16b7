"""URL rules by host-suffix and path-prefix expressions.

Each url is expanded into every (host suffix, path prefix) string that a rule of
the given rule set could equal: suffixes with as many labels, and prefixes as
long, as some rule has.  The expressions meet the rules in an equi-join on the
first bytes of their SHA-256 digest; the full digests are then compared, and of
the rules that fit the longest wins (block wins between equally long ones).

Defined cases: a null url, or one without ``://``, has an empty host and path and
fits only a rule for the empty host; urls that fit no rule get ``default``;
repeated rows each get a row; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import ascii_lower

#: Digest characters (hex) that the equi-join compares first.
PREFIX_HEX = 8

# The rules of the query (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def rule_frame(spark: SparkSession, rules=None) -> DataFrame:
    return spark.createDataFrame(rules or RULES, "verdict string, host string, path string")


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3, F.length(url))), F.lit(""))


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def url_verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict; one row per row of ``pages``."""
    rules = rules.select(
        F.col("verdict"), ascii_lower(F.col("host")).alias("host"), F.col("path"),
        F.concat(ascii_lower(F.col("host")), "path").alias("rule"))
    # The distinct shapes of the rules: bounded by the longest host and path a rule has.
    shapes = rules.agg(
        F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
        F.collect_set(F.length("path")).alias("lengths")).first()
    labels, lengths = sorted(shapes["labels"]) or [1], sorted(shapes["lengths"]) or [0]
    keyed = (pages.select("page_id", "url").groupBy("page_id", "url").agg(F.count("*").alias("copies"))
             .select("page_id", "copies", "url", url_host(F.col("url")).alias("host"),
                     url_path(F.col("url")).alias("path")))
    parts = F.split("host", r"\.")
    suffixes = F.array(*[F.when(F.size(parts) >= k, F.array_join(F.slice(parts, -k, k), "."))
                         for k in labels])
    prefixes = F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path")),
                           lambda n: F.substr(F.col("path"), F.lit(1), n))
    exprs = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    expanded = (keyed.withColumn("expr", F.explode_outer(F.filter(exprs, lambda e: e.isNotNull())))
                .withColumn("digest", F.sha2("expr", 256)))
    digests = rules.select("rule", "verdict", F.sha2("rule", 256).alias("rule_digest"))
    hits = expanded.join(
        digests, F.substring(expanded["digest"], 1, PREFIX_HEX)
        == F.substring(digests["rule_digest"], 1, PREFIX_HEX), "left")
    fits = F.col("digest") == F.col("rule_digest")
    best = hits.groupBy("page_id", "url", "host", "path", "copies").agg(
        F.max(F.when(fits, F.struct(F.length("rule").alias("n"), (F.col("verdict") == "block").alias("b"),
                                    F.col("rule"), F.col("verdict")))).alias("best"))
    return (best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict")))


ORACLE = """
with u as (
  select page_id, url, coalesce(strpos(url, '://'), 0) as sep from pages),
s as (
  select page_id, case when sep > 0 then substr(url, sep + 3) else '' end as rest from u),
p as (
  select page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from s),
r(verdict, host, path) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
         ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m as (
  select p.*, r.host || r.path as rule, r.verdict,
         row_number() over (partition by p.page_id, p.host, p.path order by length(r.host || r.path) desc nulls last, r.verdict desc) as k
  from p left join r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from m where k = 1
"""
