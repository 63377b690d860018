from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from branchwise.llm import decontam, mixing, neardup, quality

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda i: (i is not None, i or 0))


def test_stages_take_odd_rows_and_empty_tables(spark, odd_docs):
    """Rows 1 (twice) and 2 are equal, a row without an id is near them; 3, 4, 5 and one without an id have no words, 7 is one word, 6 is long."""
    docs, empty = odd_docs.withColumnRenamed("shard", "place"), odd_docs.withColumnRenamed("shard", "place").limit(0)
    want = {
        "quality_rules": [None, 1, 1, 2, 6], "minhash_near_dedup": [None, None, 1, 3, 4, 5, 6, 7], "decontamination": [None, None, 1, 1, 2, 3, 4, 5, 6, 7],
        "sharding": [None, None, 1, 1, 2, 3, 4, 5, 6, 7],
    }
    for k, (name, stage) in enumerate(cp.STAGES):
        got, none = stage(spark, docs, SF), stage(spark, empty, SF)
        if k < len(cp.STAGES) - 1:
            assert got.columns == none.columns == docs.columns, name
        assert none.count() == 0, name
        if name == "mixing":  # rows without words stay once, others as their rates say
            assert {3, 4, 5} <= set(ids(got)) and Counter(ids(got))[3] == 1
        else:
            assert ids(got) == want[name], name


def test_decisions_take_effect(spark):
    item = " ".join(f"item{i}" for i in range(20))
    base = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(6)]
    texts = [base[0], base[0], base[0] + " one more", base[1], f"{base[2]} {item} {base[3]}", "too short", "again and again it says " * 20]
    docs = spark.createDataFrame([(k, t, "en", "a", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = cp.quality_rules(spark, docs, "")
    assert ids(docs) == [0, 1, 2, 3, 4]
    docs = cp.near_dedup(spark, docs, "")
    assert ids(docs) == [0, 3, 4]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert ids(decontam.decontaminate(docs, benchmark)) == [0, 3]


def test_sharding_stage_keeps_every_row(spark, odd_docs):
    docs = odd_docs.withColumnRenamed("shard", "place")
    out = cp.shards(spark, docs, SF)
    listed = lambda df: Counter(map(str, df.select(docs.columns).collect()))
    assert listed(out) == listed(docs) and out.where("shard IS NULL OR tier IS NULL OR version IS NULL").isEmpty()


@pytest.fixture(scope="module")
def ran(spark):
    return cp.run(spark, SF)


def test_run_is_each_operator_upon_what_the_one_before_kept(spark, ran, tmp_path):
    """From the operators' own verdicts, not from the stages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in quality.verdicts(docs, "doc_id").where("kept").collect()}
    assert 0 < len(kept) < len(texts)
    left = docs.where(F.col("doc_id").isin(sorted(kept)))
    classes = {r.doc_id: r.class_id for r in neardup.near_duplicates(left).collect()}
    heads = {i for i, c in classes.items() if i == c}
    assert 0 < len(heads) < len(kept)
    left = docs.where(F.col("doc_id").isin(sorted(heads)))
    leaked = {r.doc_id for r in decontam.contaminated(left, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    clean = heads - leaked
    left = docs.where(F.col("doc_id").isin(sorted(clean)))
    drawn = Counter(ids(mixing.mix(left, spark.read.parquet(f"{SF}/labels.parquet"))))
    assert Counter(ids(ran)) == drawn and set(drawn) <= clean
    assert all(texts[r.doc_id] == r.text for r in ran.collect())
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 AND toxic = 0").collect()}
    assert good & clean <= set(drawn)  # clean documents stay
