"""Adapters on executors: a logical call for each article and node, a row for each child."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from branchwise.adapters.base import ArticleInput, ClassificationAdapter, ClassificationContext, NodeDecision
from branchwise.sources.ontology import Node, Ontology
from branchwise.sources.templates import Template

TELEMETRY = {
    "returned_version": "string", "latency_ms": "double", "input_tokens": "long", "output_tokens": "long", "provider_cost_usd": "double", "retry_count": "int", "raw_response": "string",
}
DECISION = {"scores": "map<string,double>", "call_status": "string", "error_code": "string"} | TELEMETRY


def decisions(calls: DataFrame, o: Ontology, make: Callable[[], ClassificationAdapter], template: Template, level: int, batch: int = 256) -> DataFrame:
    """calls (article_id, node_id, input_text and what else they carry) without their text, with scores, status and telemetry.

    The adapter, and each node's labels, are made once a task; calls of one node follow each other.
    """
    by: dict[str, Node] = {n.id: n for n in o.nodes}
    carried = [f for f in calls.schema.fields if f.name != "input_text"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        adapter, contexts = make(), {}
        for frame in frames:
            for k in range(0, len(frame), batch):
                part, items = frame.iloc[k : k + batch], []
                for article, node, text in zip(part["article_id"], part["node_id"], part["input_text"], strict=True):
                    if node not in contexts:
                        contexts[node] = ClassificationContext(tuple(by[c] for c in by[node].children), template, level)
                    items.append((ArticleInput(article, text or ""), by[node], contexts[node]))
                yield _frame(part.drop(columns="input_text"), adapter.classify_batch(items))

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in carried), *(f"{k} {t}" for k, t in DECISION.items())])
    return calls.sortWithinPartitions("node_id").mapInPandas(run, schema)


def _frame(part: pd.DataFrame, made: list[NodeDecision]) -> pd.DataFrame:
    columns = {k: pd.Series([getattr(d, k) for d in made], part.index, dtype=object) for k in TELEMETRY}
    out = part.assign(scores=pd.Series([d.scores for d in made], part.index), call_status=[d.status for d in made], error_code=[d.error_code for d in made], **columns)
    return out.astype({"input_tokens": "Int64", "output_tokens": "Int64", "latency_ms": "Float64", "provider_cost_usd": "Float64", "retry_count": "Int64"})


def child_rows(made: DataFrame, edges: DataFrame) -> DataFrame:
    """Every canonical child of each decision; one that a successful call has left out is a model error, not a lost row."""
    rows = made.join(edges, "node_id")
    score, good = F.element_at("scores", F.col("child_id")), F.col("call_status") == "SUCCESS"
    return rows.withColumns({
        "score": F.when(good, score), "status": F.when(good & score.isNull(), F.lit("MODEL_ERROR")).otherwise(F.col("call_status")),
        "error_code": F.when(good & score.isNull(), F.lit("missing_child")).otherwise(F.col("error_code")),
    }).drop("scores", "call_status")


def key_column(node_hashes: dict[str, str], model_version: str, ontology_hash: str, model_config_hash: str, template_hash: str) -> Column:
    """The prediction key of an article_input_hash and a node_id."""
    from branchwise.functions.text import prediction_key

    node = F.create_map(*[F.lit(x) for pair in node_hashes.items() for x in pair])
    return prediction_key(F.lit(model_version), F.col("article_input_hash"), F.element_at(node, F.col("node_id")), F.lit(ontology_hash), F.lit(model_config_hash), F.lit(template_hash))


def known(prior: DataFrame, o: Ontology) -> DataFrame:
    """The calls that succeeded for every child in rows of earlier results or journals: a row a call, with its decision."""
    children = F.create_map(*[F.lit(x) for n in o.nodes if n.children for x in (n.id, len(n.children))])
    by = [c for c in ("article_id", "prediction_key", "node_id") if c in prior.columns]
    good = prior.where((F.col("status") == "SUCCESS") & F.col("score").isNotNull())
    calls = good.groupBy(*by).agg(F.collect_list(F.struct("child_id", "score")).alias("found"), F.max(F.struct(*TELEMETRY)).alias("t"))
    first = lambda c: F.struct(c.alias("child_id"), F.filter("found", lambda x: x["child_id"] == c)[0]["score"].alias("score"))  # noqa: E731  a row may stand in journal and results
    calls = calls.withColumn("scores", F.map_from_entries(F.transform(F.array_distinct("found.child_id"), first)))
    calls = calls.where(F.size("scores") == F.element_at(children, F.col("node_id")))
    return calls.select(*by[:-1], "scores", F.lit("SUCCESS").alias("call_status"), F.lit(None).cast("string").alias("error_code"), *[F.col(f"t.{k}").alias(k) for k in TELEMETRY])


def adapter_scorer(inputs: DataFrame, o: Ontology, make: Callable[[], ClassificationAdapter], template: Template, level: int, key: Column, parts: int | None = None, reuse: DataFrame | None = None):
    """A scorer by node for traverse(). inputs: article_id, input_text, article_input_hash, original_chars and so on.

    Text is joined once at each level, to the calls that are made, and ends in
    the adapter; what else a row carries goes through with it. reuse: known()
    calls, which are not made again; they are found by prediction_key, of the
    same article where they name it. Calls are dealt to `parts` tasks, which
    with the adapter's own concurrency bounds how many run at once.
    """

    def score(front: DataFrame) -> DataFrame:
        seen = inputs if reuse is None else inputs.drop("input_text")
        calls = front.join(seen, "article_id").withColumn("prediction_key", key).drop("article_input_hash")
        if reuse is None:
            return decisions(_dealt(calls, parts), o, make, template, level)
        both = calls.join(reuse, [c for c in ("article_id", "prediction_key") if c in reuse.columns], "left")
        new = both.where("call_status IS NULL").select(calls.columns).join(inputs.select("article_id", "input_text"), "article_id")
        return decisions(_dealt(new, parts), o, make, template, level).unionByName(both.where("call_status IS NOT NULL"))

    score.by_node = True
    return score


def _dealt(calls: DataFrame, parts: int | None) -> DataFrame:
    # An explicit number of partitions: adaptive execution would merge them and change how many calls run at once.
    return calls.repartition(parts, "article_id", "node_id") if parts else calls
