"""The registered queries and their SQL."""

from __future__ import annotations

from dataclasses import replace
from functools import cache, partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from branchwise.adapters import models
from branchwise.adapters.base import RateLimited, with_retries
from branchwise.control import config, provenance
from branchwise.control.files import Files
from branchwise.functions import text
from branchwise.operators import scoring, staging, traversal as tv
from branchwise.sinks import results
from branchwise.sources import articles as src, ontology as onto, templates

SEED, SAMPLE = 917341, 100
#: The queries' configuration of traverse(), which has no defaults.
HIERARCHY = {"traversal": 0.30, "positive": 0.50, "max_depth": 10, "max_nodes": None}


DATA = Path(__file__).parents[1] / "data"


@cache
def fixture() -> onto.Ontology:
    return onto.load(str(DATA / "fixture_ontology.yaml"))


def _articles(s: SparkSession, d: str) -> DataFrame:
    raw = src.from_documents(s, d)
    made = raw.select("doc_id", text.article_id(text.normalize(F.col("headline")), F.col("date"), text.normalize(F.col("article"))).alias("article_id"))
    return made.groupBy("article_id").agg(F.min("doc_id").alias("doc_id"))


def _edges(s) -> DataFrame:
    return F.broadcast(tv.children(s, fixture(), HIERARCHY["traversal"], HIERARCHY["positive"]))


def _walk(s, d, o=None, scorer=tv.hash_scorer, **kw) -> DataFrame:
    """Ids are written once, and levels whose scorer is no expression: those of expressions cost less to make again than to write."""
    stage = staging.stager(s)
    levels = None if hasattr(scorer, "columns") else stage
    return tv.traverse(stage(_articles(s, d).select("article_id"), -1), o or fixture(), scorer, **HIERARCHY | {"stage": levels} | kw)


def _docs(s, d):
    return s.read.parquet(f"{d}/documents.parquet")


def canonical_articles(s, d):
    raw = src.from_documents(s, d)
    return src.canonical(raw).select("article_id", "source", "source_hash")


def dedup_articles(s, d):
    return _articles(s, d)


def build_inputs(s, d):
    raw = src.from_documents(s, d)
    made = text.model_input(text.normalize(F.col("headline")), text.normalize(F.col("article")), "\n\n", "headline_plus_article")
    return raw.select("doc_id", made.alias("t")).select("doc_id", *[c.alias(k) for k, c in text.truncation(F.col("t"), 12000).items()]).withColumn("article_input_hash", F.sha2("input_text", 256))


def truncation_audit(s, d):
    return build_inputs(s, d).groupBy("truncated").agg(F.count("*").alias("n"), F.sum(F.col("original_chars").cast("long")).alias("original"), F.sum(F.col("submitted_chars").cast("long")).alias("submitted"))


def sample_topk(s, d):
    return sample_ranked(s, d).select("article_id")


def sample_ranked(s, d):
    return src.sample(_articles(s, d), SEED, SAMPLE)


def sample_restriction(s, d):
    return src.restricted(_articles(s, d), sample_ranked(s, d)).select("article_id", "doc_id")


def sample_manifest_hash(s, d):
    ids = F.array_sort(F.collect_list("article_id"))  # of SAMPLE rows
    return sample_topk(s, d).agg(F.sha2(F.array_join(ids, "\n"), 256).alias("manifest_sha256"), F.count("*").alias("size"))


def _broken(s):
    edges = [("r", "a"), ("r", "b"), ("a", "x"), ("b", "x"), ("a", "gone"), ("leaf", "b")]
    nodes = [("r", "multi_label"), ("a", "multi_label"), ("b", "multi_label"), ("b", "leaf"), ("x", "leaf"), ("leaf", "leaf")]
    return s.createDataFrame(nodes, "node_id string, type string"), s.createDataFrame(edges, "node_id string, child_id string")


_BROKEN = "WITH n(node_id, type) AS (VALUES ('r','multi_label'),('a','multi_label'),('b','multi_label'),('b','leaf'),('x','leaf'),('leaf','leaf')), e(node_id, child_id) AS (VALUES ('r','a'),('r','b'),('a','x'),('b','x'),('a','gone'),('leaf','b')) "


def score_children(s, d):
    edges = _edges(s).select("node_id", "child_id")
    return tv.hash_scorer(_articles(s, d).select("article_id").withColumn("node_id", F.lit("markets.financing")).join(edges, "node_id")).select("article_id", "node_id", "child_id", "score")


def _all(s, d):
    """All inner nodes' decisions, as if every one were visited."""
    o = fixture()
    pairs = _articles(s, d).select("article_id", F.explode(F.array(*[F.lit(n.id) for n in o.nodes if n.type != "leaf"])).alias("node_id"))
    return tv.decide_all(pairs.join(F.broadcast(tv.nested(s, o, HIERARCHY["traversal"], HIERARCHY["positive"])), "node_id"), tv.hash_scorer)


def decide_children(s, d):
    return _all(s, d).select("article_id", "node_id", "child_id", "selected_positive", "selected_for_traversal")


def threshold_overrides(s, d):
    return _all(s, d).where("local_threshold <> 0.5 OR traversal_threshold <> 0.3").select("article_id", "child_id", "local_threshold", "traversal_threshold", "selected_positive", "selected_for_traversal")


def single_choice(s, d):
    return _all(s, d).where("node_type = 'single_choice' AND selected_positive").select("article_id", "node_id", F.col("child_id").alias("choice"))


WALK = ["article_id", "node_id", "node_depth", "child_id", "score", "selected_positive", "selected_for_traversal", "path_score"]


def traverse_bfs(s, d):
    return _walk(s, d).select(*WALK)


def traverse_loop_mapinpandas(s, d):
    """The same walk with an opaque scorer."""

    def score(rows: DataFrame) -> DataFrame:
        def run(frames):
            for f in frames:
                yield f.assign(score=[text.hashed(a, c) for a, c in zip(f["article_id"], f["child_id"], strict=True)], status="SUCCESS")
        fields = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in rows.schema)
        return rows.mapInPandas(run, f"{fields}, score double, status string")

    return _walk(s, d, scorer=score).select(*WALK)


def traverse_recursive(s, d):
    """The walk as one recursive query over decisions that were made before."""
    return tv.walk_recursive(staging.stager(s)(_all(s, d), 0), fixture(), HIERARCHY["max_depth"]).select(*WALK)


@cache
def shared_fixture() -> onto.Ontology:
    """The fixture with one inner node below a second parent, on a longer path, too."""
    o = fixture()
    grown = tuple(replace(n, children=(*n.children, "markets.underwriting")) if n.id == "lending.leveraged" else n for n in o.nodes)
    made = replace(o, nodes=grown, multiple_parents=True)
    if errors := onto.validate(made):
        raise onto.OntologyError("; ".join(errors))
    return made


def traverse_shared_nodes(s, d):
    return _walk(s, d, shared_fixture()).select(*WALK)


def reconciliation(s, d):
    """Where a table that has lost some calls' rows is not what its rows plan."""
    w = _walk(s, d)
    left = w.where(text.hash_score(F.col("article_id"), F.concat(F.lit("lost:"), F.col("node_id"))) >= 0.1)
    return tv.reconcile(left, _articles(s, d), fixture(), HIERARCHY["max_depth"])


def relevance_routing(s, d):
    return _walk(s, d).where("node_id = 'relevance'").groupBy("article_id").agg(
        F.max(F.when(F.col("child_id") == "gsib_activity", F.col("selected_for_traversal"))).alias("proceeds"),
        F.max(F.when(F.col("child_id") == "market_context_only", F.col("selected_positive"))).alias("context"))


def leaf_reached(s, d):
    return tv.leaves(_walk(s, d)).select("article_id", "leaf_id", "path_score")


def leaf_positives(s, d):
    return tv.leaves(_walk(s, d)).where("selected_positive").groupBy("article_id").agg(F.count("*").alias("n_positive"), F.array_join(F.array_sort(F.collect_list("leaf_id")), ",").alias("leaves"))


def depth_cap(s, d):
    return _walk(s, d, max_depth=2).select(*WALK)


def node_budget(s, d):
    return _walk(s, d, max_nodes=3).select("article_id", "node_id", "child_id")


def nodes_visited(s, d):
    return _walk(s, d).groupBy("article_id").agg(F.countDistinct("node_id").alias("n_nodes"))


def failure_rows(s, d):
    return _walk(s, d, scorer=tv.failing_scorer).select("article_id", "node_id", "child_id", "score", "selected_positive", "selected_for_traversal", "status")


def skipped_by_routing(s, d):
    return tv.skipped(_articles(s, d), _walk(s, d), fixture())


def _keyed(rows):
    return rows.withColumn("prediction_key", text.prediction_key(F.lit("model-1"), F.col("article_id"), F.col("node_id"), F.lit("ontology-1"), F.lit("config-1"), F.lit("template-1")))


def prediction_keys(s, d):
    return _keyed(_walk(s, d)).select("article_id", "node_id", "prediction_key").distinct()


def _resumed(s, d):
    planned = _keyed(_walk(s, d)).select("article_id", "node_id", "prediction_key").distinct()
    prior = _keyed(_walk(s, d, scorer=tv.failing_scorer)).select("article_id", "node_id", "prediction_key", "status").distinct()
    return tv.pending(planned, prior)


def resume_work(s, d):
    return _resumed(s, d)[0].select("article_id", "node_id")


def resume_reuse(s, d):
    return _resumed(s, d)[1].select("article_id", "node_id")


def embedding_similarity(s, d):
    e = s.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding")
    anchors = [(r[0], list(r[1])) for r in e.where("vec_id < 8").collect()]  # eight rows stand for node descriptions
    a = s.createDataFrame(anchors, "anchor_id long, anchor array<float>")
    return e.join(F.broadcast(a)).select("vec_id", "anchor_id", F.round(tv.cosine(F.col("embedding"), F.col("anchor")), 6).alias("similarity"))


def label_permutation(s, d):
    return s.createDataFrame(onto.permuted(fixture(), SEED).edges(), onto.EDGES)


def taxonomy_view(s, d):
    return _walk(s, d, onto.view(fixture(), 2)).select(*WALK)


def ablation_text(s, d):
    return s.createDataFrame([(n.id, k, onto.label_text(n, k)) for n in fixture().nodes for k in (1, 2, 3)], "node_id string, level int, label string")


def returned_versions(s, d):
    v = F.when(text.hash_score(F.col("article_id"), F.lit("version")) < 0.5, "m-1").otherwise("m-2")
    return _walk(s, d).select("node_id", v.alias("v")).groupBy("node_id").agg(F.array_join(F.array_sort(F.collect_set("v")), ",").alias("versions"))


def path_scores(s, d):
    """Each row's path product, made anew from its parent row."""
    w = _walk(s, d)
    parent = w.select("article_id", F.col("child_id").alias("node_id"), F.col("path_score").alias("above"))
    return w.join(parent, ["article_id", "node_id"], "left").select("article_id", "child_id", "path_score", (F.coalesce("above", F.lit(1.0)) * F.col("score")).alias("rebuilt"))


def input_lead(s, d):
    raw = src.from_documents(s, d)
    lead = text.normalize(F.substring_index("article", "\n\n", 1))
    return raw.select("doc_id", F.sha2(text.model_input(text.normalize(F.col("headline")), lead, "\n\n", "headline_plus_lead"), 256).alias("article_input_hash"))


def task_roots(s, d):
    return _walk(s, d).groupBy("article_id", "task_root").agg(F.count("*").alias("n_rows"))


def missing_children(s, d):
    """Decisions that leave out the children of small scores: each is still a row, and no negative."""
    scored = tv.hash_scorer(_articles(s, d).select("article_id").withColumn("node_id", F.lit("markets.financing")).join(_edges(s).select("node_id", "child_id"), "node_id"))
    held = F.filter(F.collect_list(F.struct("child_id", "score")), lambda x: x["score"] >= 0.05)
    made = scored.groupBy("article_id", "node_id").agg(F.map_from_entries(held).alias("scores")).withColumns({"call_status": F.lit("SUCCESS"), "error_code": F.lit(None).cast("string")})
    return scoring.child_rows(made, _edges(s)).select("article_id", "node_id", "child_id", "score", "status", "error_code")


ADAPTERS = ("hosted", "label_encoder", "nli", "embedding")


def render_labels(s, d):
    found = {a: templates.load(str(DATA / "templates"), a, "v1") for a in ADAPTERS}
    return s.createDataFrame([(a, n.id, k, t.render(n, k)) for a, t in found.items() for n in fixture().nodes for k in (1, 2, 3)], "adapter string, node_id string, level int, label string")


class _Flaky(models.HashAdapter):
    """Its calls are rate-limited 0 to 2 times, by a hash, before they succeed."""

    def classify(self, article, node, context):
        left = [int(text.hashed(article.article_id, f"try:{node.id}") * 3)]

        def call():
            if left[0]:
                left[0] -= 1
                raise RateLimited("http_429")
            return models.HashAdapter.classify(self, article, node, context)

        return with_retries(call, node.id, 5, lambda _: None)


MODEL = config.LocalModel(adapter="hash", enabled=True, provider="none", model="hash", revision="0000000", device="cpu", batch_size=32, threshold=0.5)


def _inputs(s, d) -> DataFrame:
    """What models see of each article: the text of its smallest doc_id, normalized once."""
    raw = src.from_documents(s, d).where("doc_id IS NOT NULL")
    parts = raw.select("doc_id", "date", text.normalize(F.col("headline")).alias("h"), text.normalize(F.col("article")).alias("a"))
    made = parts.select("doc_id", text.article_id(F.col("h"), F.col("date"), F.col("a")).alias("article_id"), text.model_input(F.col("h"), F.col("a"), "\n\n", "headline_plus_article").alias("t"))
    made = made.select("article_id", F.struct("doc_id", *[c.alias(k) for k, c in text.truncation(F.col("t"), 12000).items()]).alias("i"))
    return made.groupBy("article_id").agg(F.min("i").alias("i")).select("article_id", "i.*").drop("doc_id").withColumn("article_input_hash", F.sha2("input_text", 256))


def _classified(s, inputs, stage, make=partial(models.HashAdapter, MODEL), reuse=None):
    """Result rows of an adapter over inputs that are bucketed by article: their texts are never shuffled."""
    template = templates.load(str(DATA / "templates"), "hash", "v1")
    key = scoring.key_column({n.id: n.sha256() for n in fixture().nodes}, MODEL.version, "ontology-1", "config-1", "template-1")
    keep = ("prediction_key", "error_code", "original_chars", "submitted_chars", "truncated", "truncation_strategy", *scoring.TELEMETRY)
    scorer = scoring.adapter_scorer(inputs, fixture(), make, template, 3, key, reuse=reuse)
    return tv.traverse(inputs.select("article_id"), fixture(), scorer, **HIERARCHY, stage=stage, keep=keep).withColumn("model_id", F.lit("hash"))


def _results(s, d, make=partial(models.HashAdapter, MODEL)):
    """Result rows of an adapter over all articles."""
    with staging.keyed(_inputs(s, d), "article_id") as inputs:
        return _classified(s, inputs, staging.stager(s), make)


RESULT = [*WALK, "task_root", "model_id", "local_threshold", "traversal_threshold", "original_chars", "submitted_chars", "truncated", "truncation_strategy", "status", "error_code", "prediction_key"]


def result_rows(s, d):
    return _results(s, d).select(*RESULT)


def resume_union(s, d):
    """A run that stopped half way and is resumed: rows taken over and rows made anew are the whole run's.

    The stopped run has come as far as the articles whose rows are stored. What
    nothing reads any more goes: its levels once its calls are known, the texts
    once the last level is written.
    """
    with staging.keyed(_inputs(s, d), "article_id") as inputs:
        stopped, stage = staging.stager(s), staging.stager(s)
        try:
            stored = _classified(s, inputs.where(text.hash_score(F.col("article_id"), F.lit("stored")) < 0.5), stopped)
            reuse = stage(scoring.known(stored, fixture()), -1)
        finally:
            Files(s, stopped.root).delete(stopped.root)
        return _classified(s, inputs, stage, reuse=reuse).select(*RESULT)


def key_uniqueness(s, d):
    rows = _results(s, d)
    return rows.agg(F.count("*").alias("n_rows"), F.countDistinct("prediction_key", "child_id").alias("n_keys")).crossJoin(F.broadcast(results.duplicate_keys(rows).agg(F.count("*").alias("n_duplicates"))))


def retry_counts(s, d):
    rows = _results(s, d, make=partial(_Flaky, MODEL))
    calls = rows.groupBy("article_id", "node_id").agg(F.max("retry_count").alias("r"))
    return calls.groupBy("node_id").agg(F.sum(F.col("r").cast("long")).alias("retries"), F.count("*").alias("calls"))


def union_models(s, d):
    one, two = _walk(s, d), _walk(s, d, scorer=tv.failing_scorer)
    return one.withColumn("model_id", F.lit("a")).unionByName(two.withColumn("model_id", F.lit("b"))).select("model_id", "article_id", "node_id", "child_id", "score", "status")


def manifest_status(s, d):
    done = F.min(F.col("status").isin("SUCCESS", "SKIPPED_BY_ROUTING").cast("int")) == 1
    return union_models(s, d).groupBy("model_id").agg(F.when(done, F.lit(provenance.COMPLETE)).otherwise(F.lit(provenance.INCOMPLETE)).alias("status"), F.sum((F.col("status") != "SUCCESS").cast("long")).alias("failed_rows"))


QUERIES = {f.__name__: f for f in (
    input_lead, sample_ranked, sample_restriction, task_roots, missing_children, render_labels, result_rows, resume_union, key_uniqueness, retry_counts, union_models, manifest_status, traverse_recursive, traverse_shared_nodes, reconciliation,
    canonical_articles, dedup_articles, build_inputs, truncation_audit, sample_topk, sample_manifest_hash, score_children, decide_children, threshold_overrides,
    single_choice, traverse_bfs, traverse_loop_mapinpandas, relevance_routing, leaf_reached, leaf_positives, depth_cap, node_budget, nodes_visited, failure_rows,
    skipped_by_routing, prediction_keys, resume_work, resume_reuse, embedding_similarity, label_permutation, taxonomy_view, ablation_text, returned_versions, path_scores)}
QUERIES |= {
    "normalize_ws": lambda s, d: _docs(s, d).select("doc_id", text.collapse_whitespace(F.col("text")).alias("normalized")),
    "normalize_nfc": lambda s, d: _docs(s, d).select("doc_id", text.nfc(F.col("text")).alias("normalized")),
    "strip_html": lambda s, d: s.read.parquet(f"{d}/pages.parquet").select("page_id", text.strip_html(F.col("html")).alias("stripped")),
    "ontology_duplicates": lambda s, d: _broken(s)[0].groupBy("node_id").agg(F.count("*").alias("n")).where("n > 1"),
    "ontology_dangling": lambda s, d: _broken(s)[1].join(_broken(s)[0].select(F.col("node_id").alias("child_id")), "child_id", "left_anti").select("node_id", "child_id"),
    "ontology_multi_parent": lambda s, d: _broken(s)[1].groupBy("child_id").agg(F.countDistinct("node_id").alias("n")).where("n > 1"),
    "ontology_leaf_children": lambda s, d: _broken(s)[1].join(_broken(s)[0].where("type = 'leaf'").select("node_id"), "node_id", "left_semi"),
    "ontology_roots": lambda s, d: _broken(s)[0].select("node_id").distinct().join(_broken(s)[1].select(F.col("child_id").alias("node_id")), "node_id", "left_anti"),
}


# SQL


def _q(x) -> str:
    return "NULL" if x is None else str(x).lower() if isinstance(x, bool) else repr(x) if isinstance(x, (int, float)) else "'" + str(x).replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(map(_q, r)) + ")" for r in rows)


def _edge_rows(o: onto.Ontology) -> str:
    by = {n.id: n for n in o.nodes}
    return _values((n, c, k, by[n].type, by[c].type, by[c].none, by[c].traversal_threshold if by[c].traversal_threshold is not None else 0.3, by[c].positive_threshold if by[c].positive_threshold is not None else 0.5) for n, c, k in o.edges())


_WS = r"trim(regexp_replace({}, '[ \t\n\r\f]+', ' ', 'g'))"
_RAW = "raw AS (SELECT doc_id, source, CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END AS headline, CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS article FROM documents), "
_NORM = _RAW + f"norm AS (SELECT doc_id, source, headline, article, {_WS.format('nfc_normalize(headline)')} AS h, {_WS.format('nfc_normalize(article)')} AS a FROM raw), "
_IDS = _NORM + "ids AS (SELECT 'blbg_' || sha256(h || chr(10) || chr(10) || a) AS article_id, doc_id, source, headline, article FROM norm), "
_ARTS = _IDS + "arts AS (SELECT article_id, min(doc_id) AS doc_id FROM ids GROUP BY article_id)"
_HASH = "('0x' || substr(sha256({} || ':' || {}), 1, 8))::BIGINT::DOUBLE / 4294967296"


_LABELS = "WITH n(node_id, name, definition, inc, exc) AS (VALUES {}), l AS (SELECT node_id, k::INT AS level, CASE k WHEN 1 THEN name WHEN 2 THEN name || '. ' || definition ELSE name || '. ' || definition || CASE WHEN inc <> '' THEN '. Includes: ' || inc ELSE '' END || CASE WHEN exc <> '' THEN '. Excludes: ' || exc ELSE '' END END AS label FROM n, range(1, 4) r(k))"


def _decisions(o: onto.Ontology, failing: bool = False) -> str:
    score = _HASH.format("article_id", "child_id")
    fail = f"({_HASH.format('article_id', chr(39) + 'fail:' + chr(39) + ' || node_id')}) < 0.1" if failing else "false"
    return _ARTS + f""", e(node_id, child_id, ordinal, node_type, child_type, is_none, tt, pt) AS (SELECT c0, c1, c2, c3, c4, c5, c6::DOUBLE, c7::DOUBLE FROM (VALUES {_edge_rows(o)}) v(c0, c1, c2, c3, c4, c5, c6, c7)),
s AS (SELECT article_id, e.*, {fail} AS failed, CASE WHEN NOT {fail} THEN {score} END AS score FROM arts, e),
b AS (SELECT *, row_number() OVER (PARTITION BY article_id, node_id ORDER BY score DESC NULLS LAST, ordinal) = 1 AS best FROM s),
d AS (SELECT *, CASE WHEN node_type = 'single_choice' THEN CASE WHEN score IS NOT NULL THEN best END ELSE score >= pt END AS selected_positive,
      CASE WHEN node_type = 'single_choice' THEN CASE WHEN score IS NOT NULL THEN best AND NOT is_none END ELSE score >= tt END AS selected_for_traversal FROM b)"""


def _walked(o: onto.Ontology, failing: bool = False, depth: int = 10) -> str:
    roots = ", ".join(map(_q, o.roots))
    cols = "{0}.article_id, {0}.node_id, {0}.child_id, {0}.child_type, {0}.score, {0}.selected_positive, {0}.selected_for_traversal, {0}.failed"
    return "WITH RECURSIVE " + _decisions(o, failing) + f""", w AS (
SELECT {cols.format('d')}, 0 AS node_depth, d.score AS path_score FROM d WHERE node_id IN ({roots})
UNION ALL
SELECT {cols.format('d')}, w.node_depth + 1, w.path_score * d.score FROM w JOIN d ON d.article_id = w.article_id AND d.node_id = w.child_id
WHERE w.selected_for_traversal AND w.node_depth + 1 < {depth}) """


def _oracles() -> dict[str, str]:
    o, cols = fixture(), ", ".join(WALK)
    walk, fail = _walked(o), _walked(o, True)
    strip = r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(?:script\b.*?</script\s*>|style\b.*?</style\s*>)', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
    key = "sha256('model-1' || chr(31) || article_id || chr(31) || node_id || chr(31) || 'ontology-1' || chr(31) || 'config-1' || chr(31) || 'template-1')"
    inputs = "WITH " + _NORM + "t AS (SELECT doc_id, h || chr(10) || chr(10) || a AS t FROM norm), i AS (SELECT doc_id, substr(t, 1, 12000) AS input_text, length(t)::INT AS original_chars, least(length(t), 12000)::INT AS submitted_chars, length(t) > 12000 AS truncated, CASE WHEN length(t) > 12000 THEN 'head' END AS truncation_strategy, sha256(substr(t, 1, 12000)) AS article_input_hash FROM t) "
    sample = "WITH " + _ARTS + f", k AS (SELECT article_id FROM arts ORDER BY sha256('{SEED}:' || article_id), article_id LIMIT {SAMPLE}) "
    order = {o.roots[0]: "0000"}
    for n in tv._breadth(o):
        for k, c in enumerate(n.children):
            order[c] = f"{order[n.id]}.{k:04d}"
    status = "SELECT article_id, node_id, child_id, score, CASE WHEN failed THEN 'TIMEOUT' ELSE 'SUCCESS' END AS status FROM w"
    resulting = walk.rstrip() + f""", x AS (SELECT ids.article_id, h || chr(10) || chr(10) || a AS t FROM ids JOIN norm USING (doc_id) JOIN arts USING (doc_id)),
i AS (SELECT article_id, length(t)::INT AS original_chars, least(length(t), 12000)::INT AS submitted_chars, length(t) > 12000 AS truncated, CASE WHEN length(t) > 12000 THEN 'head' END AS truncation_strategy, sha256(substr(t, 1, 12000)) AS input_hash FROM x),
nh(node_id, node_hash) AS (VALUES {_values((n.id, n.sha256()) for n in o.nodes)})
SELECT {', '.join('w.' + c for c in WALK)}, {_q(o.roots[0])} AS task_root, 'hash' AS model_id, e.pt AS local_threshold, e.tt AS traversal_threshold, original_chars, submitted_chars, truncated, truncation_strategy, 'SUCCESS' AS status, NULL::VARCHAR AS error_code,
sha256('{MODEL.version}' || chr(31) || input_hash || chr(31) || node_hash || chr(31) || 'ontology-1' || chr(31) || 'config-1' || chr(31) || 'template-1') AS prediction_key
FROM w JOIN i USING (article_id) JOIN nh USING (node_id) JOIN e ON e.node_id = w.node_id AND e.child_id = w.child_id"""
    second = walk.rstrip() + f", f AS (SELECT article_id, node_id, score IS NULL AS failed FROM ({fail} SELECT * FROM w)) "
    return {
        "canonical_articles": "WITH " + _IDS.rstrip(", ") + " SELECT article_id, source, 'sha256:' || sha256(headline || chr(31) || chr(31) || article || chr(31)) AS source_hash FROM ids",
        "dedup_articles": "WITH " + _ARTS + " SELECT article_id, doc_id FROM arts",
        "build_inputs": inputs + "SELECT * FROM i",
        "truncation_audit": inputs + "SELECT truncated, count(*) AS n, sum(original_chars)::BIGINT AS original, sum(submitted_chars)::BIGINT AS submitted FROM i GROUP BY truncated",
        "sample_topk": sample + "SELECT * FROM k",
        "sample_manifest_hash": sample + "SELECT sha256(string_agg(article_id, chr(10) ORDER BY article_id)) AS manifest_sha256, count(*) AS size FROM k",
        "score_children": "WITH " + _decisions(o) + " SELECT article_id, node_id, child_id, score FROM d WHERE node_id = 'markets.financing'",
        "decide_children": "WITH " + _decisions(o) + " SELECT article_id, node_id, child_id, selected_positive, selected_for_traversal FROM d",
        "threshold_overrides": "WITH " + _decisions(o) + " SELECT article_id, child_id, pt AS local_threshold, tt AS traversal_threshold, selected_positive, selected_for_traversal FROM d WHERE pt <> 0.5 OR tt <> 0.3",
        "single_choice": "WITH " + _decisions(o) + " SELECT article_id, node_id, child_id AS choice FROM d WHERE node_type = 'single_choice' AND best",
        "traverse_bfs": walk + f"SELECT {cols} FROM w",
        "traverse_recursive": walk + f"SELECT {cols} FROM w",
        "traverse_shared_nodes": _walked(shared_fixture()).rstrip() + f", l(node_id, depth) AS (VALUES {_values(shared_fixture().depths().items())}) SELECT article_id, node_id, any_value(l.depth)::INT AS node_depth, child_id, any_value(score) AS score, any_value(selected_positive) AS selected_positive, any_value(selected_for_traversal) AS selected_for_traversal, max(path_score) AS path_score FROM w JOIN l USING (node_id) GROUP BY article_id, node_id, child_id",
        "reconciliation": walk.rstrip() + f", k AS (SELECT * FROM w WHERE ({_HASH.format('article_id', chr(39) + 'lost:' + chr(39) + ' || node_id')}) >= 0.1), p AS (SELECT article_id, {_q(o.roots[0])} AS node_id FROM arts UNION SELECT article_id, child_id FROM k WHERE selected_for_traversal AND child_type <> 'leaf'), h AS (SELECT DISTINCT article_id, node_id FROM k) SELECT coalesce(p.article_id, h.article_id) AS article_id, coalesce(p.node_id, h.node_id) AS node_id, CASE WHEN h.node_id IS NULL THEN 'missing' ELSE 'unplanned' END AS problem FROM p FULL JOIN h ON p.article_id = h.article_id AND p.node_id = h.node_id WHERE p.node_id IS NULL OR h.node_id IS NULL",
        "traverse_loop_mapinpandas": walk + f"SELECT {cols} FROM w",
        "relevance_routing": walk + "SELECT article_id, bool_or(selected_for_traversal) FILTER (WHERE child_id = 'gsib_activity') AS proceeds, bool_or(selected_positive) FILTER (WHERE child_id = 'market_context_only') AS context FROM w WHERE node_id = 'relevance' GROUP BY article_id",
        "leaf_reached": walk + "SELECT article_id, child_id AS leaf_id, path_score FROM w WHERE child_type = 'leaf' AND selected_for_traversal",
        "leaf_positives": walk + "SELECT article_id, count(*) AS n_positive, string_agg(child_id, ',' ORDER BY child_id) AS leaves FROM w WHERE child_type = 'leaf' AND selected_for_traversal AND selected_positive GROUP BY article_id",
        "depth_cap": _walked(o, depth=2) + f"SELECT {cols} FROM w",
        "node_budget": walk.rstrip() + f", o(node_id, place) AS (VALUES {_values(order.items())}), v AS (SELECT article_id, node_id, row_number() OVER (PARTITION BY article_id ORDER BY node_depth, place) AS k FROM (SELECT DISTINCT article_id, node_id, node_depth FROM w) JOIN o USING (node_id)) SELECT w.article_id, w.node_id, w.child_id FROM w JOIN v USING (article_id, node_id) WHERE k <= 3",
        "nodes_visited": walk + "SELECT article_id, count(DISTINCT node_id) AS n_nodes FROM w GROUP BY article_id",
        "failure_rows": fail + "SELECT article_id, node_id, child_id, score, selected_positive, selected_for_traversal, CASE WHEN failed THEN 'TIMEOUT' ELSE 'SUCCESS' END AS status FROM w",
        "skipped_by_routing": walk + "SELECT arts.article_id, e.node_id, e.child_id, 'SKIPPED_BY_ROUTING' AS status FROM arts, e WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.article_id = arts.article_id AND w.node_id = e.node_id AND w.child_id = e.child_id)",
        "prediction_keys": walk + f"SELECT DISTINCT article_id, node_id, {key} AS prediction_key FROM w",
        "resume_work": second + "SELECT DISTINCT article_id, node_id FROM w WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.article_id = w.article_id AND f.node_id = w.node_id AND NOT f.failed)",
        "resume_reuse": second + "SELECT DISTINCT article_id, node_id FROM f WHERE NOT failed",
        "embedding_similarity": "SELECT e.vec_id, a.vec_id AS anchor_id, round(list_cosine_similarity(e.embedding::DOUBLE[], a.embedding::DOUBLE[]), 6) AS similarity FROM embeddings e, embeddings a WHERE a.vec_id < 8",
        "label_permutation": f"WITH e(node_id, child_id) AS (VALUES {_values((n, c) for n, c, _ in o.edges())}) SELECT node_id, child_id, (row_number() OVER (PARTITION BY node_id ORDER BY sha256('{SEED}:' || node_id || ':' || child_id), child_id) - 1)::INT AS ordinal FROM e",
        "taxonomy_view": _walked(onto.view(o, 2)) + f"SELECT {cols} FROM w",
        "ablation_text": f"WITH n(node_id, name, definition, inc, exc) AS (VALUES {_values((n.id, n.name, n.definition, ', '.join(n.includes), ', '.join(n.excludes)) for n in o.nodes)}) SELECT node_id, k::INT AS level, CASE k WHEN 1 THEN name WHEN 2 THEN name || '. ' || definition ELSE name || '. ' || definition || CASE WHEN inc <> '' THEN '. Includes: ' || inc ELSE '' END || CASE WHEN exc <> '' THEN '. Excludes: ' || exc ELSE '' END END AS label FROM n, range(1, 4) r(k)",
        "returned_versions": walk + f"SELECT node_id, string_agg(DISTINCT CASE WHEN {_HASH.format('article_id', chr(39) + 'version' + chr(39))} < 0.5 THEN 'm-1' ELSE 'm-2' END, ',' ORDER BY CASE WHEN {_HASH.format('article_id', chr(39) + 'version' + chr(39))} < 0.5 THEN 'm-1' ELSE 'm-2' END) AS versions FROM w GROUP BY node_id",
        "input_lead": "WITH " + _RAW.rstrip(", ") + f" SELECT doc_id, sha256({_WS.format('nfc_normalize(headline)')} || chr(10) || chr(10) || {_WS.format('nfc_normalize(split_part(article, chr(10) || chr(10), 1))')}) AS article_input_hash FROM raw",
        "sample_ranked": sample + f"SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || article_id), article_id)::INT AS rank, article_id FROM k",
        "sample_restriction": sample + "SELECT article_id, doc_id FROM arts WHERE article_id IN (SELECT article_id FROM k)",
        "task_roots": walk + f"SELECT article_id, {_q(o.roots[0])} AS task_root, count(*) AS n_rows FROM w GROUP BY article_id",
        "missing_children": "WITH " + _decisions(o) + " SELECT article_id, node_id, child_id, CASE WHEN score >= 0.05 THEN score END AS score, CASE WHEN score >= 0.05 THEN 'SUCCESS' ELSE 'MODEL_ERROR' END AS status, CASE WHEN score < 0.05 THEN 'missing_child' END AS error_code FROM d WHERE node_id = 'markets.financing'",
        "render_labels": _LABELS.format(_values((n.id, n.name, n.definition, ", ".join(n.includes), ", ".join(n.excludes)) for n in o.nodes)) + " SELECT adapter, node_id, level, before || label || after AS label FROM l, (VALUES ('hosted', 'Does the text describe this activity? ', ''), ('label_encoder', '', ''), ('nli', 'This text describes ', '.'), ('embedding', '', '')) t(adapter, before, after)",
        "result_rows": resulting, "resume_union": resulting,
        "key_uniqueness": walk + "SELECT count(*) AS n_rows, count(DISTINCT article_id || ' ' || child_id) AS n_keys, 0::BIGINT AS n_duplicates FROM w",
        "retry_counts": walk + f"SELECT node_id, sum(floor({_HASH.format('article_id', chr(39) + 'try:' + chr(39) + ' || node_id')} * 3))::BIGINT AS retries, count(*) AS calls FROM (SELECT DISTINCT article_id, node_id FROM w) GROUP BY node_id",
        "union_models": f"SELECT 'a' AS model_id, * FROM ({walk} {status}) UNION ALL SELECT 'b' AS model_id, * FROM ({fail} {status})",
        "manifest_status": f"SELECT model_id, CASE WHEN bool_and(status = 'SUCCESS') THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS status, count(*) FILTER (WHERE status <> 'SUCCESS') AS failed_rows FROM (SELECT 'a' AS model_id, * FROM ({walk} {status}) UNION ALL SELECT 'b' AS model_id, * FROM ({fail} {status})) GROUP BY model_id",
        "path_scores": walk + "SELECT article_id, child_id, path_score, path_score AS rebuilt FROM w",
        "normalize_ws": f"SELECT doc_id, {_WS.format('text')} AS normalized FROM documents",
        "normalize_nfc": "SELECT doc_id, nfc_normalize(text) AS normalized FROM documents",
        "strip_html": f"SELECT page_id, {_WS.format(strip)} AS stripped FROM pages",
        "ontology_duplicates": _BROKEN + "SELECT node_id, count(*) AS n FROM n GROUP BY node_id HAVING count(*) > 1",
        "ontology_dangling": _BROKEN + "SELECT node_id, child_id FROM e WHERE child_id NOT IN (SELECT node_id FROM n)",
        "ontology_multi_parent": _BROKEN + "SELECT child_id, count(DISTINCT node_id) AS n FROM e GROUP BY child_id HAVING count(DISTINCT node_id) > 1",
        "ontology_leaf_children": _BROKEN + "SELECT node_id, child_id FROM e WHERE node_id IN (SELECT node_id FROM n WHERE type = 'leaf')",
        "ontology_roots": _BROKEN + "SELECT DISTINCT node_id FROM n WHERE node_id NOT IN (SELECT child_id FROM e)",
    }


ORACLE_SQL = _oracles()
