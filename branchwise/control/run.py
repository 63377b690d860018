"""validate, prepare and run."""

from __future__ import annotations

import contextlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import partial, reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from branchwise.adapters import models
from branchwise.adapters.base import ClassificationAdapter, ReturnedModelMismatch
from branchwise.control import provenance
from branchwise.control.config import Config, ConfigError, HostedModel, LocalModel, check_credentials, sha256
from branchwise.control.files import Files
from branchwise.control.leases import Leases, leased
from branchwise.functions import text
from branchwise.operators import scoring, staging, traversal as tv
from branchwise.sinks import results
from branchwise.sinks.results import TABLE, RunFolder
from branchwise.sources import articles as src, ontology as onto, templates

Registry = Callable[[str, HostedModel | LocalModel], ClassificationAdapter]
REPOSITORY = str(Path(__file__).resolve().parents[2])


@dataclass(frozen=True)
class Checked:
    config: Config
    ontology: onto.Ontology
    ontology_hash: str
    templates: dict[str, templates.Template]
    git: provenance.GitState


@dataclass(frozen=True)
class Prepared:
    checked: Checked
    digest: str
    sample_path: str
    sample_hash: str
    sample_size: int

    def hashes(self) -> dict:
        c = self.checked
        return {"identity": self.digest, "dataset": c.config.dataset.file_sha256, "sample": self.sample_hash, "ontology": c.ontology_hash, "templates": {k: t.sha256 for k, t in c.templates.items()}}


def validate(config: Config, repository: str = REPOSITORY, code: provenance.GitState | None = None) -> Checked:
    """All that can be checked without Spark and without a call; fails at the first fault. code: the state of the code, else found in `repository`."""
    with open(config.ontology.path, "rb") as f:
        raw = f.read()
    if (found := sha256(raw)) != config.ontology.sha256:
        raise ConfigError(f"{config.ontology.path}: {found} is not the pinned {config.ontology.sha256}")
    o = onto.parse(raw.decode("utf-8"))
    if o.version != config.ontology.version:
        raise ConfigError(f"ontology version {o.version} is not the pinned {config.ontology.version}")
    if config.ontology.view_depth is not None:
        o = onto.view(o, config.ontology.view_depth)
    if config.ontology.child_order_seed is not None:
        o = onto.permuted(o, config.ontology.child_order_seed)
    if not config.enabled():
        raise ConfigError("no model is enabled")
    check_credentials(config)
    git = code or provenance.code_state(repository)
    provenance.check_git(config, git)
    used = {name: templates.load(config.templates.directory, m.adapter, config.templates.version) for name, m in config.enabled().items()}
    return Checked(config, o, o.sha256(), used, git)


def _normalization(config: Config) -> dict[str, bool]:
    n = config.input.normalization
    return {"unicode_nfc": n.unicode == "NFC", "whitespace": n.collapse_whitespace, "html": n.strip_html}


def articles(spark: SparkSession, config: Config) -> DataFrame:
    """Canonical articles; equal contents have equal ids."""
    return src.canonical(src.snapshot(spark, config.dataset), **_normalization(config))


def prepare(spark: SparkSession, checked: Checked) -> Prepared:
    """The sample manifest, written outside the results, and the run's identity."""
    config = checked.config
    work = config.output.work_directory.rstrip("/")
    ids = articles(spark, config).select("article_id")
    drawn = src.sample(ids, config.run.seed, config.sample.size)
    place = f"{work}/sample-{sha256([config.dataset.file_sha256, config.run.seed, config.sample.size, config.input.model_dump(mode='json'), text.NORMALIZATION_VERSION])[:16]}"
    if not Files(spark, work).exists(f"{place}/_SUCCESS"):
        drawn.coalesce(1).write.mode("overwrite").parquet(place)
    digest, size = src.sample_hash(spark.read.schema(src.SAMPLE).parquet(place))
    identity = provenance.identity(config, checked.ontology_hash, config.dataset.file_sha256, digest, {k: t.sha256 for k, t in checked.templates.items()}, checked.git)
    return Prepared(checked, identity, place, digest, size)


def inputs(spark: SparkSession, config: Config, sample: DataFrame) -> DataFrame:
    """What models see of each sampled article, with the audit of what was cut."""
    first = F.row_number().over(Window.partitionBy("article_id").orderBy("source_hash", "url", "source"))
    chosen = src.restricted(articles(spark, config), sample).withColumn("first", first).where("first = 1")
    head, body = (text.normalize(F.col(c), **_normalization(config)) for c in ("headline", "article"))
    if config.input.mode == "headline_plus_lead":  # the lead ends where a paragraph does, which normalization would hide
        body = text.normalize(F.substring_index("article", "\n\n", 1), **_normalization(config))
    made = chosen.select("article_id", F.concat(F.coalesce(head, F.lit("")), F.lit(config.input.separator), F.coalesce(body, F.lit(""))).alias("t"))
    return made.select("article_id", *[c.alias(k) for k, c in text.truncation(F.col("t"), config.input.max_chars).items()]).withColumn("article_input_hash", F.sha2("input_text", 256))


def _speculates(spark: SparkSession) -> bool:
    return spark.sparkContext.getConf().get("spark.speculation", "false").lower() == "true"


@contextlib.contextmanager
def _calls(spark: SparkSession, config: Config, model_id: str, model: HostedModel | LocalModel, patience: float) -> Iterator[tuple[int | None, Callable[[], None]]]:
    """The calls of a hosted model that this run holds, and a check that it still does."""
    if not isinstance(model, HostedModel):
        yield None, lambda: None
        return
    work = config.output.work_directory
    leases = Leases(Files(spark, work), work, [model.provider, model.model])

    def alive() -> None:
        if leases.lost.is_set():
            raise RuntimeError(f"{model_id}: another run has taken over calls of this one, which stood still; resume it")

    with leased(leases, model.concurrency, model_id, patience) as held:
        yield held, alive


def _make(registry: Registry, name: str, model, share: int | None) -> ClassificationAdapter:
    made = registry(name, model)
    if share:
        made.concurrency = share
    return made


def run(spark: SparkSession, prepared: Prepared, registry: Registry = models.offline, only: str | None = None, resume: bool = False, patience: float = 0.0) -> RunFolder:
    """Classifies the sample with each enabled model and stores rows and manifest.

    Without `resume` the identity must be new, but that several calls may each
    add a model (`only`). With it, successful calls of the journal, which has
    each level that any attempt has ended, and of the stored rows are taken over
    by prediction key, and just the rest are made. One model's rows replace its
    older ones when the manifest names them, so a reader sees either. A run is
    COMPLETE if no row failed and its rows are those that they plan themselves;
    then its folder is sealed, and resuming it does nothing.

    Runs that share a work folder share each hosted model's `concurrency`: a run
    takes what no other holds, and waits up to `patience` seconds for the first
    call of a model before it ends.
    """
    if _speculates(spark) and any(isinstance(m, HostedModel) for m in prepared.checked.config.enabled(only).values()):
        raise ConfigError("spark.speculation would make paid calls twice and pass a model's concurrency")
    checked, config = prepared.checked, prepared.checked.config
    chosen, started = config.enabled(only), datetime.now(UTC).isoformat()
    name = RunFolder.find(spark, config.output, prepared.digest)
    if resume and name is None:
        raise ConfigError("there is no run of this identity to resume")
    folder = RunFolder(spark, config.output, name or provenance.run_id(prepared.digest))
    if not resume and (taken := [m for m in chosen if folder.read(m) is not None]):
        raise ConfigError(f"{folder.run_id} has results of {taken} already; resume it")
    earlier = json.loads(folder.manifest() or "{}")
    if earlier and earlier["identity_sha256"] != prepared.digest:
        raise ConfigError(f"{folder.run_id} is of another identity")
    if earlier.get("status") == provenance.COMPLETE:
        return folder
    said, retried, live, libraries = (dict(earlier.get(k, {})) for k in ("models", "retry_counts", "live", "libraries"))
    note = partial(provenance.manifest, config, folder.run_id, git=checked.git, hashes=prepared.hashes(), sample_size=prepared.sample_size, models=said, started=earlier.get("started_at", started), retries=retried, live=live)
    folder.write_manifest(provenance.to_json(note(status=provenance.RUNNING, completed=None)))
    folder.sweep()
    sample = spark.read.schema(src.SAMPLE).parquet(prepared.sample_path)
    stage = staging.stager(spark)
    try:
        seen = stage(inputs(spark, config, sample), 0)
        for model_id, model in chosen.items():
            libraries[model_id] = list(registry(model_id, model).libraries)
            with _calls(spark, config, model_id, model, patience) as (share, alive):
                _store(spark, prepared, model_id, model, seen, registry, folder, said, retried, live, share, alive)
            folder.write_manifest(provenance.to_json(note(status=provenance.RUNNING, completed=None)))
            folder.sweep()
    finally:
        Files(spark, stage.root).delete(stage.root)
    done = set(said) >= set(config.enabled()) and not any(m["failed_rows"] or m["unreconciled"] for m in said.values())
    named = tuple(sorted({x for xs in libraries.values() for x in xs}))
    folder.write_manifest(provenance.to_json(note(status=provenance.COMPLETE if done else provenance.INCOMPLETE, completed=datetime.now(UTC).isoformat(), libraries=named)))
    folder.guard()
    if done:
        folder.files.seal(folder.root)
    return folder


def _store(spark: SparkSession, prepared: Prepared, model_id: str, model: HostedModel | LocalModel, seen: DataFrame, registry: Registry, folder: RunFolder, said: dict, retried: dict, live: dict, at_once: int | None, alive: Callable[[], None]) -> None:
    """One model's rows as a generation that the next manifest names; rows that must not count never do."""
    config, walk = prepared.checked.config, prepared.checked.config.hierarchy.traversal
    generation = folder.write(classify(spark, prepared, model_id, model, seen, registry, folder, at_once, alive), model_id)
    alive()
    stored = folder.read(model_id, {model_id: generation})
    if stored is None:
        stored = spark.createDataFrame([], TABLE)
    if not results.duplicate_keys(stored).isEmpty():
        raise RuntimeError(f"{folder.run_id}: {model_id} has rows with one key")
    lost = tv.reconcile(stored, seen.select("article_id"), prepared.checked.ontology, walk.max_depth, walk.max_nodes_per_article).count()
    facts = stored.agg(F.array_sort(F.collect_set("returned_version")), F.sum(F.when(F.col("retry_count") > 0, F.col("retry_count")).otherwise(0)), F.sum((~F.col("status").isin("SUCCESS", "SKIPPED_BY_ROUTING")).cast("long"))).first()
    if isinstance(model, HostedModel) and not model.allow_returned_model_mismatch and set(facts[0]) - {model.model}:
        raise ReturnedModelMismatch(f"{model_id}: asked for {model.model}, answered by {facts[0]}")
    said[model_id] = {"requested": model.version, "returned_versions": facts[0], "failed_rows": int(facts[2] or 0), "unreconciled": lost}
    retried[model_id], live[model_id] = int(facts[1] or 0), generation


def classify(spark: SparkSession, prepared: Prepared, model_id: str, model: HostedModel | LocalModel, seen: DataFrame, registry: Registry, folder: RunFolder, at_once: int | None = None, alive: Callable[[], None] = lambda: None) -> DataFrame:
    """Result rows of one model. Each level's calls are written before their rows are read twice.

    at_once: the calls of a hosted model that this run may make at once, else its whole concurrency. alive() raises if it may make no more.
    """
    checked, config = prepared.checked, prepared.checked.config
    o, template, walk = checked.ontology, checked.templates[model_id], config.hierarchy.traversal
    positive = model.threshold if isinstance(model, LocalModel) else config.hierarchy.classification.positive_threshold  # a node's own threshold goes before both
    key = scoring.key_column({n.id: n.sha256() for n in o.nodes}, model.version, checked.ontology_hash, sha256([model_id, model.model_dump(mode="json"), config.templates.label_level]), template.sha256)
    cores, parts, share = spark.sparkContext.defaultParallelism, None, None
    if isinstance(model, HostedModel):  # tasks times threads is at most the calls at once
        at_once = at_once or model.concurrency
        parts = min(cores, at_once)
        share = max(1, at_once // parts)
    make = partial(_make, registry, model_id, model, share)
    columns = ["input_text", "article_input_hash", "original_chars", "submitted_chars", "truncated", "truncation_strategy"]
    journal = staging.Journal(spark, f"{config.output.work_directory.rstrip('/')}/journal/{prepared.digest}/{model_id}")

    def stage(level: DataFrame, depth: int) -> DataFrame:
        alive()
        return journal.stage(level, depth)

    known = ["prediction_key", "node_id", "child_id", "score", "status", *scoring.TELEMETRY]
    found = [x.select(known) for x in (journal.rows(), folder.read(model_id)) if x is not None]
    scorer = scoring.adapter_scorer(seen.select("article_id", *columns), o, make, template, config.templates.label_level, key, parts, scoring.known(reduce(DataFrame.unionByName, found), o) if found else None)
    keep = ("prediction_key", "error_code", "original_chars", "submitted_chars", "truncated", "truncation_strategy", *scoring.TELEMETRY)
    rows = tv.traverse(seen.select("article_id"), o, scorer, traversal=walk.threshold, positive=positive, max_depth=walk.max_depth, max_nodes=walk.max_nodes_per_article, stage=stage, keep=keep)
    rows = rows.select(*tv.COLUMNS, *keep)
    if config.output.materialize_skipped:
        edges = tv.children(spark, o, walk.threshold, positive).select("node_id", "child_id", "traversal_threshold", "local_threshold")
        depths, roots = _depths(o)
        lost = tv.skipped(seen.select("article_id"), rows, o).join(F.broadcast(edges), ["node_id", "child_id"]).join(seen.select("article_id", *columns[2:]), "article_id")
        at = lambda table: F.element_at(F.create_map(*[F.lit(x) for p in table.items() for x in p]), F.col("node_id"))
        rows = rows.unionByName(lost.withColumns({"node_depth": at(depths), "task_root": at(roots)}), allowMissingColumns=True)
    facts = {
        "run_id": folder.run_id, "model_id": model_id, "model_version": model.version, "config_hash": sha256(config.resolved()), "ontology_hash": checked.ontology_hash, "dataset_hash": config.dataset.file_sha256,
        "sample_manifest_hash": prepared.sample_hash, "template_hash": template.sha256, "code_commit": checked.git.commit}
    out = rows.withColumns({k: F.lit(v) for k, v in facts.items()} | {"created_at": F.current_timestamp()})
    return out.select(*[f.name for f in TABLE.fields])


def _depths(o: onto.Ontology) -> tuple[dict[str, int], dict[str, str]]:
    depths, roots, by = o.depths(), {r: r for r in o.roots}, {n.id: n for n in o.nodes}
    for n in sorted(depths, key=depths.get):
        for c in by[n].children:
            roots[c] = min(roots.get(c, roots[n]), roots[n])
    return depths, roots


def union_models(folders: list[RunFolder]) -> DataFrame:
    return reduce(DataFrame.unionByName, [f.read() for f in folders])


def experiments(config: Config, depths: list[int] = (), seeds: list[int] = (), levels: list[int] = ()) -> dict[str, Config]:
    """Configurations of robustness and scale runs; each has an identity of its own."""
    out = {}
    for d in depths:
        out[f"view-{d}"] = config.model_copy(update={"ontology": config.ontology.model_copy(update={"view_depth": d})})
    for s in seeds:
        out[f"order-{s}"] = config.model_copy(update={"ontology": config.ontology.model_copy(update={"child_order_seed": s})})
    for k in levels:
        out[f"labels-{k}"] = config.model_copy(update={"templates": config.templates.model_copy(update={"label_level": k})})
    return out
