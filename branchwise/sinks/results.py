"""The result table: its schema, its layout on disk, and the guard of what a run may write."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from branchwise.control.config import Output
from branchwise.control.files import Files

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}
#: A row an article, model, node and child; names and order are fixed.
RESULT = T.StructType([T.StructField(n, _TYPES[t], null) for n, t, null in (
    ("run_id", "string", False), ("article_id", "string", False), ("model_id", "string", False), ("model_version", "string", False), ("task_root", "string", False),
    ("node_id", "string", False), ("node_depth", "int", False), ("child_id", "string", False), ("score", "double", True), ("selected_positive", "boolean", True),
    ("selected_for_traversal", "boolean", True), ("local_threshold", "double", False), ("traversal_threshold", "double", False), ("path_score", "double", True),
    ("original_chars", "int", False), ("submitted_chars", "int", False), ("truncated", "boolean", False), ("truncation_strategy", "string", True), ("latency_ms", "double", True),
    ("input_tokens", "long", True), ("output_tokens", "long", True), ("provider_cost_usd", "double", True), ("config_hash", "string", False), ("ontology_hash", "string", False),
    ("dataset_hash", "string", False), ("sample_manifest_hash", "string", False), ("template_hash", "string", False), ("code_commit", "string", False), ("status", "string", False),
    ("error_code", "string", True), ("created_at", "timestamp", False))])
#: Columns of our own: what resuming needs, retries, and the raw response.
EXTRA = T.StructType([T.StructField(n, _TYPES[t]) for n, t in (("prediction_key", "string"), ("retry_count", "int"), ("returned_version", "string"), ("raw_response", "string"))])
TABLE = T.StructType([*RESULT.fields, *EXTRA.fields])


def shaped(rows: DataFrame, output: Output) -> DataFrame:
    """rows in the table's columns and types; what the configuration leaves out is null."""
    hidden = {c for on, cs in ((output.include_node_scores, ("score", "path_score")), (output.include_latency, ("latency_ms",)), (output.include_usage, ("input_tokens", "output_tokens", "provider_cost_usd")), (output.include_raw_provider_response, ("raw_response",))) if not on for c in cs}
    return rows.select(*[(F.lit(None) if f.name in hidden else F.col(f.name)).cast(f.dataType).alias(f.name) for f in TABLE.fields])


class RunFolder:
    """<directory>/<run_id>/manifest.json and results/model=<m>/*.parquet, and nothing else."""

    def __init__(self, spark: SparkSession, output: Output, run_id: str):
        self.spark, self.output, self.run_id = spark, output, run_id
        self.root = f"{output.directory.rstrip('/')}/{run_id}"
        self.files = Files(spark, self.root)

    @staticmethod
    def find(spark: SparkSession, output: Output, digest: str) -> str | None:
        """The run with this identity: the time in its name does not count."""
        held = [x for x in Files(spark, output.directory).names(output.directory) if re.fullmatch(rf"\d{{8}}T\d{{6}}Z_{digest[:8]}", x)]
        return min(held, default=None)

    def place(self, model: str) -> str:
        return f"{self.root}/results/model={model}"

    def live(self) -> dict[str, str]:
        """The generation of each model's files that counts, by the manifest."""
        return json.loads(self.manifest() or "{}").get("live", {})

    def paths(self, model: str | None = None, live: dict[str, str] | None = None) -> list[str]:
        live = self.live() if live is None else live
        return [f"{self.place(m)}/{x}" for m, g in sorted(live.items()) if model in (None, m) for x in self.files.names(self.place(m)) if x.startswith(f"part-{g}-")]

    def read(self, model: str | None = None, live: dict[str, str] | None = None) -> DataFrame | None:
        """Stored rows, by the declared schema; None where there are none."""
        found = self.paths(model, live)
        return self.spark.read.schema(TABLE).parquet(*found) if found else None

    def write(self, rows: DataFrame, model: str) -> str:
        """One model's rows as a new generation of files beside the older one; it counts once a manifest names it."""
        work, generation = Files(self.spark, self.output.work_directory), uuid.uuid4().hex[:12]
        staged = f"{work.root}/{self.run_id}-{model}-{generation}"
        try:
            shaped(rows, self.output).write.parquet(staged)
            parts = [x for x in work.names(staged) if x.startswith("part-") and x.endswith(".parquet")]
            for k, name in enumerate(parts):
                self.files.move(f"{staged}/{name}", f"{self.place(model)}/part-{generation}-{k:05d}.parquet")
        finally:
            work.delete(staged)
        return generation

    def sweep(self) -> None:
        """Deletes files of generations that the manifest does not name."""
        kept = set(self.paths())
        for name in self.files.walk(f"{self.root}/results"):
            if f"{self.root}/results/{name}" not in kept:
                self.files.delete(f"{self.root}/results/{name}")

    def write_manifest(self, text: str) -> None:
        self.files.write(f"{self.root}/manifest.json", text)

    def manifest(self) -> str | None:
        name = f"{self.root}/manifest.json"
        return self.files.read(name) if self.files.exists(name) else None

    def guard(self) -> None:
        """Fails if the run folder holds anything but the manifest and result files."""
        odd = [x for x in self.files.walk(self.root) if not re.fullmatch(r"manifest\.json|results/model=[A-Za-z0-9_-]+/part-[^/]*\.parquet", x)]
        if odd:
            raise RuntimeError(f"{self.root} holds {odd[:5]}")


def read_results(spark: SparkSession, directory: str, *run_ids: str) -> DataFrame:
    """Rows of runs, for whoever consumes them: the files that each manifest names, by the declared schema."""
    places = []
    for r in run_ids:
        root = f"{directory.rstrip('/')}/{r}"
        files = Files(spark, root)
        live = json.loads(files.read(f"{root}/manifest.json"))["live"]
        places += [f"{root}/results/model={m}/{x}" for m, g in sorted(live.items()) for x in files.names(f"{root}/results/model={m}") if x.startswith(f"part-{g}-")]
    return spark.read.schema(TABLE).parquet(*places)


def duplicate_keys(rows: DataFrame) -> DataFrame:
    """(prediction_key, child_id, n) that stand more than once for one article and model; a sound table has none."""
    return rows.where("prediction_key IS NOT NULL").groupBy("model_id", "article_id", "prediction_key", "child_id").agg(F.count("*").alias("n")).where("n > 1")
