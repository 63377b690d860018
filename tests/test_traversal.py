import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from branchwise.plans.catalog import shared_fixture

from branchwise.functions import text
from branchwise.operators import traversal as tv
from branchwise.plans.catalog import fixture
from branchwise.sources import ontology as onto


def small(**over):
    leaf = lambda i: onto.Node(i, i, "leaf", definition="d")
    inner = lambda i, *c: onto.Node(i, i, "multi_label", "q", "d", children=c)
    return onto.Ontology("t", "1", ("r",), (inner("r", "a", "b"), inner("a", "x", "y"), leaf("b"), leaf("x"), leaf("y")))


def scored(table):
    def run(rows):
        pairs = F.create_map(*[v for k, s in table.items() for v in (F.lit(k), F.lit(s).cast("double"))])
        return rows.withColumns({"score": pairs[F.col("child_id")], "status": F.when(pairs[F.col("child_id")].isNull(), "TIMEOUT").otherwise("SUCCESS")})
    return run


def rows(spark, table, o=None, **kw):
    arts = spark.createDataFrame([("1",)], "article_id string")
    return {r.child_id: r for r in tv.traverse(arts, o or small(), scored(table), **{"traversal": 0.3, "positive": 0.5, "max_depth": 10, "max_nodes": None} | kw).collect()}


def test_low_parent_still_descends_and_path_product(spark):
    got = rows(spark, {"a": 0.42, "b": 0.3, "x": 0.91, "y": 0.5})
    assert not got["a"].selected_positive and got["a"].selected_for_traversal
    assert got["x"].selected_positive and got["x"].path_score == pytest.approx(0.42 * 0.91)
    assert got["b"].selected_for_traversal and got["y"].selected_positive  # thresholds are inclusive


def test_failure_is_no_negative_and_is_not_descended(spark):
    got = rows(spark, {"a": None, "b": 0.9})
    assert got["a"].selected_positive is None and got["a"].selected_for_traversal is None and got["a"].status == "TIMEOUT"
    assert set(got) == {"a", "b"}


def test_scores_out_of_range_are_model_errors(spark):
    got = rows(spark, {"a": float("nan"), "b": 1.1})
    assert {g.status for g in got.values()} == {"MODEL_ERROR"} and all(g.score is None for g in got.values())


def test_depth_cap(spark):
    assert set(rows(spark, {"a": 0.9, "b": 0.9, "x": 0.9, "y": 0.9}, max_depth=1)) == {"a", "b"}


def test_ontology_rules():
    o = small()
    assert onto.validate(o) == [] and onto.validate(fixture()) == []
    n = list(o.nodes)
    broken = {
        "duplicate": [*n, n[2]], "nonexistent": [replace(n[0], children=("a", "b", "gone")), *n[1:]], "leaf has children": [*n[:2], replace(n[2], children=("x",)), *n[3:]],
        "no children": [replace(n[0], children=("a", "b")), replace(n[1], children=()), *n[2:4]], "parents": [n[0], n[1], replace(n[2], type="multi_label", question="q", children=("x",)), *n[3:]],
        "empty": [replace(n[0], definition=""), *n[1:]], "cycle": [n[0], replace(n[1], children=("x", "y", "r")), *n[2:]],
    }
    for word, nodes in broken.items():
        assert any(word in e for e in onto.validate(replace(o, nodes=tuple(nodes)))), word
    assert "a root is missing" in onto.validate(replace(o, roots=()))


def test_decomposed_text_is_composed(spark):
    frame = spark.createDataFrame([("é  x\n",), (None,)], "t string")
    assert [r[0] for r in frame.select(text.normalize(F.col("t"))).collect()] == ["é x", None]


def test_decisions_within_a_row_are_those_of_a_window(spark):
    rng = random.Random(5)
    values = [None, 0.0, 0.3, 0.5, 0.5, 0.9, 1.0, 1.2, -0.1, float("nan")]
    arts = spark.createDataFrame([(f"a{k}",) for k in range(40)], "article_id string")
    table = {(f"a{k}", c): rng.choice(values) for k in range(40) for _, c, _ in fixture().edges()}
    scores = F.create_map(*[F.lit(x) for (a, c), v in table.items() for x in (f"{a}:{c}", v)])
    made = lambda a, n, c: (F.try_element_at(scores, F.concat(a, F.lit(":"), c)), F.when(F.try_element_at(scores, F.concat(a, F.lit(":"), c)).isNull(), "TIMEOUT").otherwise("SUCCESS"))
    nodes = arts.crossJoin(F.broadcast(tv.nested(spark, fixture(), 0.3, 0.5)))
    edges = arts.crossJoin(F.broadcast(tv.children(spark, fixture(), 0.3, 0.5)))
    score, status = made(F.col("article_id"), F.col("node_id"), F.col("child_id"))
    want = tv.decide(edges.withColumns({"score": score, "status": status}))
    got = tv.decide_all(nodes, tv._by_columns(made))
    columns = ["article_id", "node_id", "child_id", "score", "status", "selected_positive", "selected_for_traversal", "local_threshold", "ordinal"]
    listed = lambda df: sorted(map(str, df.select(columns).collect()))
    assert listed(got) == listed(want) and any(v is not None and math.isnan(v) for v in table.values())


def test_levels_need_no_window_and_no_exchange(spark):
    arts = spark.createDataFrame([(f"a{k}",) for k in range(9)], "article_id string")
    walk = tv.traverse(arts, fixture(), tv.hash_scorer, traversal=0.3, positive=0.5, max_depth=10, max_nodes=None)
    plan = walk._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange hashpartitioning" not in plan and "Python" not in plan and "BroadcastHashJoin" in plan


def test_recursive_query_is_the_loop(spark):
    arts = spark.createDataFrame([(f"a{k}",) for k in range(50)], "article_id string")
    how = {"traversal": 0.3, "positive": 0.5}
    nodes = arts.crossJoin(F.broadcast(tv.nested(spark, fixture(), 0.3, 0.5)))
    columns = ["article_id", "node_id", "node_depth", "child_id", "score", "selected_positive", "selected_for_traversal", "path_score"]
    listed = lambda df: sorted(map(str, df.select(columns).collect()))
    for depth in (1, 3, 10):
        loop = tv.traverse(arts, fixture(), tv.hash_scorer, **how, max_depth=depth, max_nodes=None)
        assert listed(tv.walk_recursive(tv.decide_all(nodes, tv.hash_scorer), fixture(), depth)) == listed(loop)
    with pytest.raises(ValueError, match="parents"):
        tv.walk_recursive(arts, shared_fixture(), 3)


def test_shared_nodes_are_visited_once_on_their_longest_path(spark):
    leaf = lambda i: onto.Node(i, i, "leaf", definition="d")
    inner = lambda i, *c: onto.Node(i, i, "multi_label", "q", "d", children=c)
    o = onto.Ontology("t", "1", ("r",), (inner("r", "a", "s"), inner("a", "b"), inner("b", "s"), inner("s", "x", "y"), leaf("x"), leaf("y")))
    assert any("parents" in e for e in onto.validate(o))
    o = replace(o, multiple_parents=True)
    assert onto.validate(o) == [] and o.depths() == {"r": 0, "a": 1, "b": 2, "s": 3, "x": 4, "y": 4}
    assert o.sha256() != replace(o, multiple_parents=False).sha256()
    with pytest.raises(onto.OntologyError):
        onto.view(o, 1)
    for table, best in (({"a": 0.9, "b": 0.9, "s": 0.5, "x": 0.5, "y": 0.1}, 0.5), ({"a": 0.1, "b": 0.9, "s": 0.5, "x": 0.5, "y": 0.1}, 0.5)):
        got = [r for r in tv.traverse(spark.createDataFrame([("1",)], "article_id string"), o, scored(table), traversal=0.3, positive=0.5, max_depth=10, max_nodes=None).collect()]
        of = [r for r in got if r.node_id == "s"]
        assert [r.child_id for r in sorted(of, key=lambda r: r.child_id)] == ["x", "y"] and {r.node_depth for r in of} == {3}
        assert max(r.path_score for r in of) == pytest.approx(best * 0.5)  # the shorter path gives more than 0.9 * 0.9 * 0.5
    cyclic = replace(o, nodes=(*o.nodes[:3], inner("s", "x", "y", "a"), *o.nodes[4:]))
    assert "a cycle" in onto.validate(cyclic)
    arts = spark.createDataFrame([(f"a{k}",) for k in range(60)], "article_id string")
    walk = tv.traverse(arts, shared_fixture(), tv.hash_scorer, traversal=0.3, positive=0.5, max_depth=10, max_nodes=None)
    assert walk.groupBy("article_id", "node_id", "child_id").count().where("count > 1").isEmpty()
    assert tv.reconcile(walk, arts, shared_fixture(), 10).isEmpty()


def test_reconciliation_sees_what_is_lost_doubled_or_unplanned(spark):
    arts = spark.createDataFrame([(f"a{k}",) for k in range(20)], "article_id string")
    for cap in (None, 3):
        walk = tv.traverse(arts, fixture(), tv.hash_scorer, traversal=0.3, positive=0.5, max_depth=10, max_nodes=cap)
        assert tv.reconcile(walk, arts, fixture(), 10, cap).isEmpty()
    walk = tv.traverse(arts, fixture(), tv.hash_scorer, traversal=0.3, positive=0.5, max_depth=10, max_nodes=None)
    found = lambda rows: {(r.article_id, r.node_id, r.problem) for r in tv.reconcile(rows, arts, fixture(), 10).collect()}
    assert found(walk.where("article_id <> 'a3'")) == {("a3", "relevance", "missing")}
    assert found(walk.where("NOT (article_id = 'a3' AND child_id = 'gsib_activity')")) >= {("a3", "relevance", "children")}
    assert found(walk.unionByName(walk.where("article_id = 'a3' AND node_id = 'relevance'"))) == {("a3", "relevance", "children")}


def test_nodes_that_no_root_reaches_and_doubled_keys_are_errors():
    o = small()
    assert any("no root reaches z" in e for e in onto.validate(replace(o, nodes=(*o.nodes, onto.Node("z", "z", "leaf", definition="d")))))
    text_ = "id: t\nversion: '1'\nroots: [r]\nnodes:\n  - {id: r, name: r, name: q, type: leaf, definition: d}\n"
    with pytest.raises(onto.OntologyError, match="twice"):
        onto.parse(text_)
