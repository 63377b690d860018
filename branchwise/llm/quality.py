"""Quality rules: fixed base rules, then adaptive fences from quantile sketches.

Everything is computed inside the row with array functions: no shuffle of
words. Repeated five-word windows are found by sorting (hash, position) pairs,
and only in texts whose windows are not all different.

Fences: for each (lang, source), KLL sketches of two ratios (symbols a word,
repeated lines a word-bearing line) of the texts with at least MIN_WORDS words
merge by aggregation, as in ORACLE_SQL: those that fail the repeat rule count
too. A text above q75 + reach * max(q75 - q25, least spread) of its group is
rejected. The sketches see every such text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from branchwise.llm.common import SPACES, need, table, written

#: Fixed by the contract.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Of the fences: KLL's k, how many spreads above q75, the least spread of each ratio.
SKETCH_K, REACH = 4096, 3.0
SPREADS = {"symbol_ratio": 0.05, "dup_line_ratio": 0.2}


def with_metrics(docs: DataFrame, repeats: bool = True) -> DataFrame:
    """docs with the columns of the base rules. A null text has no words and no lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumn("_bw_words", F.regexp_extract_all(text, F.lit(f"[^{SPACES}]+"), 0)).withColumn(
        "_bw_lines", F.filter(F.split(text, "\n"), lambda x: F.regexp(x, F.lit(f"[^{SPACES}]")))
    )
    out = out.withColumns({
        "n_words": F.size("_bw_words").cast("long"),
        "word_chars": F.length(F.array_join("_bw_words", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size("_bw_lines").cast("long"),
        "n_dup_lines": (F.size("_bw_lines") - F.size(F.array_distinct("_bw_lines"))).cast("long"),
        **({"n_repeat_words": repeat_words(F.col("_bw_words")).cast("long")} if repeats else {}),
    })
    return out.drop("_bw_words", "_bw_lines")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is computed once and stands once in the plan, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Number of words in windows that stand twice or more; one expression, so that a filter above it copies it once."""

    def runs(h: Column) -> Column:
        n = F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))
        return F.transform(F.arrays_zip(*[F.slice(h, k + 1, n).alias(f"w{k}") for k in range(WINDOW)]), lambda x: F.xxhash64(x))

    def places(p: Column) -> Column:
        same = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p)), lambda a, b: F.when(a["h"] == b["h"], F.struct(a["i"].alias("a"), b["i"].alias("b"))))
        return _let(F.filter(same, lambda x: x.isNotNull()), lambda b: F.array_sort(F.array_union(b["a"], b["b"])))

    def covered(at: Column) -> Column:
        gaps = F.zip_with(at, F.slice(at, 2, F.size(at)), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0), lambda s, x: s + x)

    def repeated(r: Column) -> Column:
        pairs = F.array_sort(F.transform(r, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(r) > F.size(F.array_distinct(r)), _let(_let(pairs, places), covered)).otherwise(F.lit(0))

    return _let(_let(F.transform(words, lambda w: F.xxhash64(w)), runs), repeated)


def _ratios() -> dict:
    return {"symbol_ratio": F.col("n_symbols") / F.greatest("n_words", F.lit(1)), "dup_line_ratio": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))}


def _fences(rated: DataFrame) -> DataFrame:
    """Fences of rows with lang, source, n_words, n_symbols, n_lines, n_dup_lines."""
    rated = rated.withColumn("_bw_row", F.monotonically_increasing_id()).where((F.col("n_words") >= MIN_WORDS) & (F.col("_bw_row") >= 0))  # as in _verdicts
    rated = rated.select("lang", "source", *[x.alias(k) for k, x in _ratios().items()])
    sketched = rated.groupBy("lang", "source").agg(*[F.kll_sketch_agg_double(k, F.lit(SKETCH_K)).alias(k) for k in SPREADS])
    q = lambda k, at: F.kll_sketch_get_quantile_double(F.col(k), F.lit(at))
    return sketched.select("lang", "source", *[(q(k, 0.75) + F.lit(REACH) * F.greatest(q(k, 0.75) - q(k, 0.25), F.lit(least))).alias(f"{k}_max") for k, least in SPREADS.items()])


def fences(docs: DataFrame) -> DataFrame:
    """(lang, source, symbol_ratio_max, dup_line_ratio_max); a null lang or source is a group of its own."""
    return _fences(with_metrics(need(docs, "text", "lang", "source"), repeats=False))


def _verdicts(measured: DataFrame, limits: DataFrame) -> DataFrame:
    limits = limits.withColumnRenamed("lang", "_bw_l").withColumnRenamed("source", "_bw_s")
    # A filter on `kept` must not sink to where words are made, or it copies how they are made: it cannot pass a row number.
    judged = measured.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")), "_bw_row": F.monotonically_increasing_id()
    })
    # Few groups, in a table of known size: it is broadcast where that allows, and no text is shuffled; else AQE splits skewed sources.
    judged = judged.join(limits, F.col("lang").eqNullSafe(F.col("_bw_l")) & F.col("source").eqNullSafe(F.col("_bw_s")), "left")
    ratios = _ratios()
    within = [ratios[k] <= F.coalesce(F.col(f"{k}_max"), F.lit(float("inf"))) for k in SPREADS]
    return judged.withColumn("kept", (F.col("_bw_row") >= 0) & ~F.col("base_failed") & within[0] & within[1]).drop("_bw_l", "_bw_s", "_bw_row", "n_lines", *[f"{k}_max" for k in SPREADS])


def judge(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    Nulls: a null text has no words and fails. Repeated rows are judged alike,
    and ties at a fence are kept. A group without a text of MIN_WORDS words has
    no fences: its texts failed already. An empty table gives an empty one.
    Columns of these names in docs are replaced. Texts are read twice, for the
    fences and for the verdicts, and never shuffled.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *SPREADS, *[f"{k}_max" for k in SPREADS]]
    return _verdicts(with_metrics(docs.drop(*own)), written(fences(docs), "fences"))


def verdicts(docs: DataFrame, *keep: str) -> DataFrame:
    """What judge says of each row, with the columns `keep` alone: texts are read once, their metrics written."""
    measured = written(with_metrics(need(docs, *dict.fromkeys([*keep, "lang", "source", "text"]))).drop(*{"text"} - {*keep}), "metrics")
    return _verdicts(measured, _fences(measured)).drop(*{"lang", "source"} - {*keep})


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, lang, source, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols
  FROM d),
g AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 4), ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c >= 2),
rep AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM hit, range(0, 5) r(k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         n_symbols::BIGINT AS n_symbols, len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
r AS (
  SELECT *, n_symbols / greatest(n_words, 1) AS sr, n_dup_lines / greatest(n_lines, 1) AS dr,
         (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed
  FROM m),
f AS (
  SELECT lang, source,
         quantile_disc(sr, 0.75) + 3.0 * greatest(quantile_disc(sr, 0.75) - quantile_disc(sr, 0.25), 0.05) AS smax,
         quantile_disc(dr, 0.75) + 3.0 * greatest(quantile_disc(dr, 0.75) - quantile_disc(dr, 0.25), 0.2) AS dmax
  FROM r WHERE n_words >= 10 GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND sr <= coalesce(smax, 'infinity'::DOUBLE) AND dr <= coalesce(dmax, 'infinity'::DOUBLE)) AS kept
FROM r LEFT JOIN f ON r.lang IS NOT DISTINCT FROM f.lang AND r.source IS NOT DISTINCT FROM f.source
"""
