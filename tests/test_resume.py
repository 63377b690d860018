"""Resuming over texts: what is reused, and what stays on disk."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from branchwise.operators import scoring, staging, traversal as tv
from branchwise.plans import catalog
from branchwise.plans.catalog import fixture


def documents(spark, folder, texts):
    rows = [(k, t, "test") for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{folder}/in/documents.parquet")
    return f"{folder}/in"


def key(rows):
    return sorted(map(str, rows.select(*catalog.RESULT).collect()))


def size(folder):
    return sum(p.stat().st_size for p in Path(folder).rglob("*") if p.is_file())


def test_articles_that_differ_past_the_cut_keep_their_own_rows(spark, tmp_path):
    """They share input_text and so prediction keys, but their ids, of which the stand-in makes its scores, differ."""
    begun = "headline\n" + "word " * 2500
    d = documents(spark, tmp_path, [f"{begun}{k}" for k in range(8)] + [f"short {k}" for k in range(4)] + ["short 1"])
    made = catalog.resume_union(spark, d)
    assert key(made) == key(catalog.result_rows(spark, d))
    want = tv.traverse(made.select("article_id").distinct(), fixture(), tv.hash_scorer, **catalog.HIERARCHY)
    columns = ["article_id", "child_id", "score", "path_score"]
    assert sorted(map(str, made.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    assert made.select("article_id").distinct().count() == 12 and made.where("truncated").select("prediction_key", "article_id").distinct().groupBy("prediction_key").count().where("count > 1").count() > 0


def test_texts_lie_on_disk_once_and_go(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    d = documents(spark, tmp_path, ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=9000)) for _ in range(200)])
    root, most = tmp_path / "shared", []
    monkeypatch.setattr(staging, "shared_folder", lambda s, k=iter(range(99)): f"file://{root}/{next(k)}")
    stager = staging.stager

    def watched(s, root_of=None):
        stage = stager(s, root_of)

        def staged(level, depth):
            out = stage(level, depth)
            most.append(size(root))
            return out

        staged.root = stage.root
        return staged

    monkeypatch.setattr(staging, "stager", watched)
    made, texts = catalog.resume_union(spark, d), 200 * 9000
    assert made.count() > 200 and len(most) > 2
    assert max(most) < 1.5 * texts  # before, both walks kept a copy
    assert size(root) < 0.5 * texts  # levels and known calls
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("keyed_")]


def test_a_join_leaves_bucketed_texts_where_they_are(spark):
    texts = spark.range(100).select(F.col("id").cast("string").alias("article_id"), F.lit("x").alias("input_text"))
    front = texts.select("article_id").repartition(3)
    with staging.keyed(texts, "article_id") as held:
        joined = front.hint("merge").join(held, "article_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100 and plan.count("Exchange hashpartitioning") == 1 and "input_text" not in next(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)


def test_a_call_that_stands_in_two_places_is_known_once(spark):
    """Journal and results hold the same rows; a call that lacks a child is not known."""
    nodes = [n for n in fixture().nodes if n.children][:2]
    rows = [("a", n.id, c, 0.5, "SUCCESS") for n in nodes for c in n.children]
    cut = [("b", *r[1:]) for r in rows if r[2] != nodes[0].children[0]]
    prior = spark.createDataFrame(rows + rows + cut, "article_id string, node_id string, child_id string, score double, status string")
    prior = prior.select("*", F.concat("article_id", "node_id").alias("prediction_key"), *[F.lit(None).cast(t).alias(k) for k, t in scoring.TELEMETRY.items()])
    found = {(r.article_id, r.prediction_key): r.scores for r in scoring.known(prior, fixture()).collect()}
    assert set(found) == {("a", f"a{nodes[0].id}"), ("a", f"a{nodes[1].id}"), ("b", f"b{nodes[1].id}")}
    assert all(found["a", f"a{n.id}"] == dict.fromkeys(n.children, 0.5) for n in nodes)
