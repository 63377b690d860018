"""Hierarchical traversal: a level at a time, scores joined to a broadcast ontology.

Scores stay apart from two decisions: positive (final threshold) and traversal.
A null score, of a failed call, makes both null: never a negative, and not
descended. The ontology was loaded by one driver, so broadcasting it is safe.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from branchwise.functions import text
from branchwise.sources.ontology import Ontology

STATUSES = ("SUCCESS", "TIMEOUT", "RATE_LIMITED", "PROVIDER_ERROR", "INVALID_REQUEST", "MODEL_ERROR", "SKIPPED_BY_ROUTING")
KEYS = ["article_id", "node_id", "child_id"]
COLUMNS = ["article_id", "task_root", "node_id", "node_depth", "child_id", "ordinal", "score", "selected_positive", "selected_for_traversal", "local_threshold", "traversal_threshold", "path_score", "status"]
KID = ["ordinal", "child_id", "child_type", "is_none", "traversal_threshold", "local_threshold"]
Scorer = Callable[[DataFrame], DataFrame]


def children(spark: SparkSession, o: Ontology, traversal: float, positive: float) -> DataFrame:
    """An edge a row, with the child's type and thresholds: its own, else those given."""
    return spark.createDataFrame(_edge_rows(o, traversal, positive), "node_id string, child_id string, ordinal int, node_type string, child_type string, is_none boolean, traversal_threshold double, local_threshold double")


def _edge_rows(o: Ontology, traversal: float, positive: float) -> list[tuple]:
    by = {n.id: n for n in o.nodes}
    pick = lambda own, default: default if own is None else own
    return [(n, c, k, by[n].type, by[c].type, by[c].none, pick(by[c].traversal_threshold, traversal), pick(by[c].positive_threshold, positive)) for n, c, k in o.edges()]


def nested(spark: SparkSession, o: Ontology, traversal: float, positive: float) -> DataFrame:
    """children() with a node a row: its edges are an array in canonical order."""
    made: dict[tuple[str, str], list[tuple]] = {}
    for node, child, ordinal, kind, *rest in _edge_rows(o, traversal, positive):
        made.setdefault((node, kind), []).append((ordinal, child, *rest))
    kid = "ordinal: int, child_id: string, child_type: string, is_none: boolean, traversal_threshold: double, local_threshold: double"
    return spark.createDataFrame([(*k, v) for k, v in made.items()], f"node_id string, node_type string, kids array<struct<{kid}>>")


def _by_columns(columns: Callable[[Column, Column, Column], tuple[Column, Column]]) -> Scorer:
    """A scorer of rows from expressions of article, node and child: score and status. traverse() puts them into the rows of nodes."""

    def score(rows: DataFrame) -> DataFrame:
        made = columns(F.col("article_id"), F.col("node_id"), F.col("child_id"))
        return rows.withColumns({"score": made[0], "status": made[1]})

    score.columns = columns
    return score


hash_scorer = _by_columns(lambda article, node, child: (text.hash_score(article, child), F.lit("SUCCESS")))


def _failing(article: Column, node: Column, child: Column) -> tuple[Column, Column]:
    failed = text.hash_score(article, F.concat(F.lit("fail:"), node)) < 0.1
    return F.when(~failed, text.hash_score(article, child)), F.when(failed, F.lit("TIMEOUT")).otherwise(F.lit("SUCCESS"))


#: Times out for the nodes whose hash is small; all children of a failed node fail with it.
failing_scorer = _by_columns(_failing)


def _valid(score: Column) -> Column:
    return score.isNull() | (score.between(0.0, 1.0) & ~F.isnan(score))


def decide_nested(rows: DataFrame, score: Callable[[Column], Column], status: Callable[[Column], Column], error: Callable[[Column], Column] | None = None) -> DataFrame:
    """decide() within rows of nodes (node_type, kids), then a row for each child: no window, no exchange."""

    def scored(c: Column) -> Column:
        more = {"error_code": error(c)} if error else {}
        return F.struct(*[c[k].alias(k) for k in KID], score(c).alias("score"), status(c).alias("status"), *[v.alias(k) for k, v in more.items()])

    def checked(c: Column) -> Column:
        return c.withField("status", F.when(_valid(c["score"]), c["status"]).otherwise(F.lit("MODEL_ERROR"))).withField("score", F.when(_valid(c["score"]), c["score"]))

    single = F.col("node_type") == "single_choice"

    def decided(c: Column) -> Column:
        best, known = c["ordinal"] == F.col("_best"), c["score"].isNotNull()
        positive = F.when(single, F.when(known, best)).otherwise(c["score"] >= c["local_threshold"])
        descend = F.when(single, F.when(known, best & ~c["is_none"])).otherwise(c["score"] >= c["traversal_threshold"])
        return c.withField("selected_positive", positive).withField("selected_for_traversal", descend)

    rows = rows.withColumn("kids", F.transform("kids", scored)).withColumn("kids", F.transform("kids", checked))  # two steps: a score is made once
    rows = rows.withColumn("_top", F.array_max(F.transform("kids", lambda c: c["score"])))
    rows = rows.withColumn("_best", F.get(F.filter("kids", lambda c: c["score"] == F.col("_top")), F.lit(0))["ordinal"])
    rows = rows.withColumn("kids", F.transform("kids", decided)).drop("_top", "_best")
    return rows.select(*[c for c in rows.columns if c != "kids"], F.inline("kids"))


def decide(scored: DataFrame, ranked: bool = True) -> DataFrame:
    """Positive and traversal decisions. Scores outside [0, 1] are model errors.

    Of a single_choice node the best child (ties: canonical order) is both, but
    a `none` child is not descended. Without such nodes pass ranked=False: no
    window and no shuffle.
    """
    valid = _valid(F.col("score"))
    out = scored.withColumns({"status": F.when(valid, F.col("status")).otherwise(F.lit("MODEL_ERROR")), "score": F.when(valid, F.col("score"))})
    positive, descend = F.col("score") >= F.col("local_threshold"), F.col("score") >= F.col("traversal_threshold")
    if ranked:
        best = F.row_number().over(Window.partitionBy("article_id", "node_id").orderBy(F.desc_nulls_last("score"), "ordinal")) == 1
        single = F.col("node_type") == "single_choice"
        known = F.col("score").isNotNull()
        out = out.withColumn("_best", best)
        positive = F.when(single, F.when(known, F.col("_best"))).otherwise(positive)
        descend = F.when(single, F.when(known, F.col("_best") & ~F.col("is_none"))).otherwise(descend)
    return out.withColumns({"selected_positive": positive, "selected_for_traversal": descend}).drop("_best")


def _level(front: DataFrame, scorer: Scorer, edges: DataFrame, kids: DataFrame, ranked: bool) -> DataFrame:
    if getattr(scorer, "by_node", False):
        called = scorer(front).withColumnRenamed("error_code", "_error").join(kids, "node_id")
        good, found = F.col("call_status") == "SUCCESS", lambda c: F.element_at("scores", c["child_id"])
        lacking = lambda c: good & found(c).isNull()  # noqa: E731  a successful call that leaves a child out: no lost row, no negative
        out = decide_nested(
            called, lambda c: F.when(good, found(c)), lambda c: F.when(lacking(c), F.lit("MODEL_ERROR")).otherwise(F.col("call_status")),
            lambda c: F.when(lacking(c), F.lit("missing_child")).otherwise(F.col("_error")))
        return out.drop("scores", "call_status", "_error")
    if made := getattr(scorer, "columns", None):
        at = F.col("article_id"), F.col("node_id")
        return decide_nested(front.join(kids, "node_id"), lambda c: made(*at, c["child_id"])[0], lambda c: made(*at, c["child_id"])[1])
    return decide(scorer(front.join(edges, "node_id")), ranked)


def traverse(articles: DataFrame, o: Ontology, scorer: Scorer, *, traversal: float, positive: float, max_depth: int, max_nodes: int | None, stage: Callable[[DataFrame, int], DataFrame] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row an article, visited node and child (COLUMNS), child_type and the scorer's columns `keep`.

    A scorer of expressions, and one with the attribute by_node, which scores
    articles and nodes, are decided within a node's row, without a shuffle. Any
    other one adds score and status to rows of article, node and child. Past
    max_nodes visited nodes of an article, in breadth-first canonical order, no
    call is made (None: no budget).

    A node with several parents is visited once, on the level of its longest
    path, if any parent's row leads to it; its paths' scores give the maximum.

    `stage` writes a level and reads it back: needed when scores cost something,
    or each later level would ask for them again.
    """
    spark = articles.sparkSession
    edges, kids = F.broadcast(children(spark, o, traversal, positive)), F.broadcast(nested(spark, o, traversal, positive))
    ranked = any(n.type == "single_choice" for n in o.nodes)
    front = None
    for root in o.roots:
        one = articles.select("article_id").withColumns({"task_root": F.lit(root), "node_id": F.lit(root), "node_depth": F.lit(0), "above": F.lit(1.0)})
        front = one if front is None else front.unionByName(one)
    at, levels, depth = o.depths(), [], 0
    inner = {n.id for n in o.nodes if n.type != "leaf"}
    places = F.broadcast(spark.createDataFrame(list(_places(o).items()), "node_id string, place string")) if max_nodes else None
    if max_nodes:
        front = front.withColumn("seen", F.lit(0))
    while depth < max_depth and any(at[n] == depth for n in inner):
        if max_nodes:
            each = Window.partitionBy("article_id")
            ranks = {"turn": F.row_number().over(each.orderBy("place")) + F.col("seen"), "seen": F.col("seen") + F.count("*").over(each).cast("int")}
            front = front.join(places, "node_id").withColumns(ranks).where(F.col("turn") <= max_nodes).drop("turn", "place")
        level = _level(front, scorer, edges, kids, ranked).withColumn("path_score", F.col("above") * F.col("score"))
        level = level.select(*COLUMNS, "child_type", *keep, *["seen"] * bool(max_nodes))
        level = stage(level, depth) if stage else level
        levels.append(level)
        depth += 1
        following = sorted(n for n in inner if at[n] == depth)
        front = None
        for earlier in levels if o.multiple_parents else levels[-1:]:
            more = earlier.where(F.col("selected_for_traversal") & F.col("child_id").isin(following)).select(
                "article_id", "task_root", F.col("child_id").alias("node_id"), F.lit(depth).alias("node_depth"), F.col("path_score").alias("above"), *["seen"] * bool(max_nodes))
            front = more if front is None else front.unionByName(more)
        if o.multiple_parents:
            front = front.groupBy("article_id", "node_id", "node_depth").agg(F.min("task_root").alias("task_root"), F.max("above").alias("above"), *[F.max("seen").alias("seen")] * bool(max_nodes))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.select(*COLUMNS, "child_type", *keep)


def decide_all(rows: DataFrame, scorer: Scorer) -> DataFrame:
    """decide_nested() of rows of articles and nodes by a scorer of expressions."""
    at = F.col("article_id"), F.col("node_id")
    return decide_nested(rows, lambda c: scorer.columns(*at, c["child_id"])[0], lambda c: scorer.columns(*at, c["child_id"])[1])


def walk_recursive(decided: DataFrame, o: Ontology, max_depth: int) -> DataFrame:
    """The walk over decisions of all nodes (a row an article, node and child) as one recursive query.

    For scores that cost nothing: each step joins all decisions, so the loop of
    traverse() is the better one where a call is paid for. Ontologies are forests.
    """
    if o.multiple_parents:
        raise ValueError("a node with several parents would be walked once for each path")
    spark, name = decided.sparkSession, f"decided_{uuid.uuid4().hex}"
    carried = ["article_id", "node_id", "child_id", "child_type", "score", "selected_positive", "selected_for_traversal"]
    decided.createOrReplaceTempView(name)
    of = lambda t: ", ".join(f"{t}.{c}" for c in carried)
    roots = ", ".join("'" + r.replace("'", "''") + "'" for r in o.roots)
    out = spark.sql(f"""
        WITH RECURSIVE w({', '.join(carried)}, node_depth, path_score) MAX RECURSION LEVEL {max_depth + 1} AS (
            SELECT {of('d')}, 0, d.score FROM {name} d WHERE d.node_id IN ({roots})
            UNION ALL
            SELECT {of('d')}, w.node_depth + 1, w.path_score * d.score FROM w JOIN {name} d ON d.article_id = w.article_id AND d.node_id = w.child_id
            WHERE w.selected_for_traversal AND w.node_depth + 1 < {max_depth})
        SELECT * FROM w LIMIT ALL""")
    spark.catalog.dropTempView(name)
    return out


def reconcile(rows: DataFrame, articles: DataFrame, o: Ontology, max_depth: int, max_nodes: int | None = None) -> DataFrame:
    """(article_id, node_id, problem): where stored rows are not what they themselves plan.

    Planned are the roots of each article and each inner child that a stored row
    leads to, above max_depth. "missing": planned, not stored (an article that
    reached max_nodes may stop anywhere); "unplanned": stored, not planned;
    "children": other than the node's number of rows. A sound table has none.
    """
    at, inner = o.depths(), [n for n in o.nodes if n.children]
    done = rows.where("status <> 'SKIPPED_BY_ROUTING'")
    held = done.groupBy("article_id", "node_id").agg(F.count("*").alias("n"), F.countDistinct("child_id").alias("distinct"))
    roots = articles.select("article_id", F.explode(F.array(*[F.lit(r) for r in o.roots])).alias("node_id"))
    led = done.where("selected_for_traversal").select("article_id", F.col("child_id").alias("node_id")).where(F.col("node_id").isin([n.id for n in inner if at[n.id] < max_depth]))
    planned = roots.unionByName(led).distinct().withColumn("planned", F.lit(True))
    both = held.join(planned, ["article_id", "node_id"], "full")
    if max_nodes:
        full = held.groupBy("article_id").agg((F.count("*") >= max_nodes).alias("full"))
        both = both.join(full, "article_id", "left")
    else:
        both = both.withColumn("full", F.lit(False))
    size = F.element_at(F.create_map(*[F.lit(x) for n in inner for x in (n.id, len(n.children))]), F.col("node_id"))
    problem = F.when(F.col("n").isNull(), F.when(~F.coalesce("full", F.lit(False)), F.lit("missing"))).when(F.col("planned").isNull(), F.lit("unplanned")).when((F.col("n") != size) | (F.col("distinct") != size), F.lit("children"))
    return both.select("article_id", "node_id", problem.alias("problem")).where("problem IS NOT NULL")


def _places(o: Ontology) -> dict[str, str]:
    """Where each node stands: the ordinals on its path."""
    paths = {r: f"{k:04d}" for k, r in enumerate(o.roots)}
    for n in _breadth(o):
        for k, c in enumerate(n.children):
            paths[c] = f"{paths[n.id]}.{k:04d}"
    return paths


def _breadth(o: Ontology):
    by, level = {n.id: n for n in o.nodes}, list(o.roots)
    while level:
        yield from (by[i] for i in level)
        level = [c for i in level for c in by[i].children]


def skipped(articles: DataFrame, rows: DataFrame, o: Ontology) -> DataFrame:
    """A row for each child that routing left out; below a failed node there are none."""
    failed = rows.where("status <> 'SUCCESS'").select("article_id", F.col("child_id").alias("lost")).distinct()
    below = {n.id: _under(o, n.id) for n in o.nodes}
    pairs = articles.sparkSession.createDataFrame([(a, d) for a, ds in below.items() for d in ds], "lost string, node_id string")
    lost = failed.join(F.broadcast(pairs), "lost").select("article_id", "node_id").distinct()
    every = articles.select("article_id", F.explode(F.array(*[F.struct(F.lit(n).alias("node_id"), F.lit(c).alias("child_id")) for n, c, _ in o.edges()])).alias("e")).select("article_id", "e.*")
    return every.join(rows.select(*KEYS), KEYS, "left_anti").join(lost, ["article_id", "node_id"], "left_anti").withColumn("status", F.lit("SKIPPED_BY_ROUTING"))


def _under(o: Ontology, node: str) -> list[str]:
    by = {n.id: n for n in o.nodes}
    out, todo = [], [node]
    while todo:
        out.append(todo.pop())
        todo += by[out[-1]].children
    return out


def leaves(rows: DataFrame) -> DataFrame:
    """Leaves reached, with whether they are positive."""
    return rows.where("child_type = 'leaf' AND selected_for_traversal").select("article_id", F.col("child_id").alias("leaf_id"), "score", "path_score", "selected_positive")


def pending(planned: DataFrame, prior: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Work left and rows to reuse, by prediction_key; only successes are reused."""
    done = prior.where("status = 'SUCCESS'")
    return planned.join(done.select("prediction_key").distinct(), "prediction_key", "left_anti"), done.join(planned.select("prediction_key").distinct(), "prediction_key", "left_semi")


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))
