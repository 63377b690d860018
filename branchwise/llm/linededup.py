"""Cross-site boilerplate: lines that stand on many sites.

A line is trimmed of ASCII white space and known by two 64-bit hashes. Lines
that occur often enough to matter get a HyperLogLog sketch of their sites,
merged by aggregation; an estimate well above or below the limit decides, one
near it is replaced by the exact distinct count. Both decide on all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from branchwise.llm.common import SPACES, need, table, text_key, written

MIN_SITES = 10
LG_K = 12
SALTS = 16
#: Four standard errors of a sketch of 2^12 registers.
MARGIN = 0.065


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _hashed(line: Column) -> list[Column]:
    bare = F.regexp_replace(line, rf"\A[{SPACES}]+|[{SPACES}]+\z", "")
    return [F.xxhash64(bare).alias("h1"), F.xxhash64(F.lit("2"), bare).alias("h2"), (bare != "").alias("full")]


def hashed_lines(docs: DataFrame) -> DataFrame:
    """(text_key, at, source, h1, h2) of each line that is more than white space; written, so that texts are split and hashed once."""
    lines = need(docs, "source", "text").select("source", text_key(F.col("text")).alias("text_key"), F.posexplode(_lines(F.col("text"))).alias("at", "line"))
    return written(lines.select("text_key", "at", "source", *_hashed(F.col("line"))).where("full").drop("full"), "lines")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(h1, h2) of each of hashed_lines that stands on at least min_sites different sources; null sources are no site."""
    lines = lines.select("source", "h1", "h2")
    often = written(lines.groupBy("h1", "h2").agg(F.count("source").alias("n")).where(F.col("n") >= min_sites).drop("n"), "often")
    # A very common line is dealt over salts: sketches merge in two steps.
    salted = often.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = lines.withColumn("salt", F.pmod(F.xxhash64(F.rand(7)), F.lit(SALTS)).cast("int")).join(salted, ["h1", "h2", "salt"])
    partial = dealt.groupBy("h1", "h2", "salt").agg(F.hll_sketch_agg("source", F.lit(LG_K)).alias("sketch"))
    estimates = written(partial.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("sites")), "estimates")
    width = max(1.0, MARGIN * min_sites)
    near = estimates.where(F.abs(F.col("sites") - min_sites) <= width).drop("sites")
    exact = lines.join(near, ["h1", "h2"]).groupBy("h1", "h2").agg(F.countDistinct("source").alias("sites")).where(F.col("sites") >= min_sites)
    return estimates.where(F.col("sites") > min_sites + width).unionByName(exact).drop("sites")


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """docs with text less its boilerplate lines, and n_lines, n_removed (long).

    Every occurrence goes. Lines of white space alone are never boilerplate. A
    null text stays null, with n_lines 0. An empty table gives an empty one. Equal
    rows are treated alike; other
    columns stay, but for columns named n_lines or n_removed, which are replaced.
    """
    docs = docs.drop("n_lines", "n_removed").withColumn("_bw_key", text_key(F.col("text")))
    lines = hashed_lines(docs)
    boiler = written(boilerplate(lines, min_sites), "boilerplate")
    hits = lines.join(boiler, ["h1", "h2"], "left_semi").groupBy(F.col("text_key").alias("_bw_key")).agg(F.collect_set("at").alias("_bw_gone"))
    out = docs.join(hits, "_bw_key", "left").withColumn("_bw_lines", _lines(F.col("text")))
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size("_bw_lines") - 1), F.col("_bw_gone")))
    kept = F.array_join(F.transform(stay, lambda i: F.get("_bw_lines", i)), "\n")
    return out.withColumns({
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size("_bw_lines")).cast("long"),
        "n_removed": F.coalesce(F.size("_bw_gone"), F.lit(0)).cast("long"),
        "text": F.when(F.col("_bw_gone").isNull(), F.col("text")).otherwise(kept),
    }).drop("_bw_key", "_bw_gone", "_bw_lines")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = need(table(spark, sf_dir, "documents"), "doc_id", "source", "text")
    return remove_boilerplate(docs).select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, source, k, line, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM (SELECT doc_id, source, unnest(range(len(ls))) AS k, unnest(ls) AS line
        FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents))),
b AS (SELECT bare FROM l WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= 10),
m AS (SELECT l.*, b.bare IS NOT NULL AS gone FROM l LEFT JOIN b ON l.bare = b.bare),
t AS (
  SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS kept
  FROM m GROUP BY doc_id)
SELECT doc_id, n_lines, n_removed, length(kept)::BIGINT AS kept_chars, sha256(kept) AS kept_sha256 FROM t
"""
