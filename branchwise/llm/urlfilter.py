"""URL rules by hashed host-suffix and path-prefix expressions.

Every distinct (host, path) is expanded to the expressions a rule could have:
each suffix of the host that starts at a label, with each prefix of the path
whose length some rule's path has. Expressions meet rules in an equi-join on
the first 4 bytes of their SHA-256; the full digest confirms a hit, and of a
url's hits the longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from branchwise.llm.common import need, table, written

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
PREFIX_HEX = 8
_SEP = "\x00"


def rules_frame(spark: SparkSession, rules) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, action string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(part(1), upper, upper.lower()), part(2)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit(_SEP), path), 256)


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of urls.

    A null url, or one without ://, has an empty host and path and gets the
    default. Rows with equal urls are judged once; rows with null or repeated
    ids are kept as they are. Of rules with equal host and path, block wins; of
    fitting rules of equal length, the last in byte order.
    Without rules all get the default. Other columns are ignored.
    """
    host, path = host_and_path(F.col("u"))
    pages = need(urls, id_col, url_col).toDF("page_id", "u").select("page_id", host.alias("host"), path.alias("path"))

    rules = (
        need(rules, "host", "path", "action").na.drop()
        .groupBy("host", "path").agg(F.max("action").alias("action"))  # "block" > "allow"
        .select(F.length("path").alias("path_len"), F.concat("host", "path").alias("rule"), "action", _digest(F.col("host"), F.col("path")).alias("full"))
        .withColumn("short", F.substring("full", 1, PREFIX_HEX))
    )
    # One row: as many numbers as there are different lengths of rule paths, bounded by the longest path.
    lengths = rules.agg(F.collect_set("path_len").alias("lengths"))

    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size("labels")), lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))
    prefixes = F.transform(F.filter("lengths", lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    expanded = (
        pages.select("host", "path").distinct()
        .withColumns({"lengths": lengths.scalar(), "labels": labels})
        .select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", "suffix", F.explode("prefixes").alias("prefix"))
        .select("host", "path", _digest(F.col("suffix"), F.col("prefix")).alias("own"))
        .withColumn("short", F.substring("own", 1, PREFIX_HEX))
    )
    verdicts = (
        expanded.join(rules, "short").where("own = full")
        .groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "action")).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.action").alias("action"))
    )
    # A table of its own, so that AQE can split a hot url (the empty one of all invalid urls) and broadcast few verdicts.
    return pages.join(written(verdicts, "verdicts"), ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rules_frame(spark, RULES))


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(h, p, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT p.page_id, p.host, p.path, r.h || r.p AS rule, r.action,
         row_number() OVER (PARTITION BY p.page_id, p.host, p.path ORDER BY length(r.h || r.p) DESC) AS k
  FROM p LEFT JOIN r ON (p.host = r.h OR suffix(p.host, '.' || r.h)) AND starts_with(p.path, r.p))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM m WHERE k = 1
"""
