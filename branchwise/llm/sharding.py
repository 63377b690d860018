"""Size-tiered compaction of immutable Parquet shards under a versioned manifest.

A run is a folder of shards that one write made. Arrivals are small runs; when
a tier (sizes within one power of the fan-out) holds `fanout` runs, the oldest
are rewritten into one run of target-sized shards. Rewriting needs no shuffle:
input splits are coalesced. Runs are written under a temporary name and moved to
a name that is never used again; a version becomes visible when its manifest is
renamed into place, which fails if another writer was first: then the change is
made anew upon that writer's version. A crash leaves at worst folders that no
manifest names, which vacuum() clears. The last `keep_versions` versions can be
read; older manifests go, and then the runs that only they name.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from branchwise.llm.common import need, shared_dir, table


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 512 << 20, base_bytes: int = 16 << 20, fanout: int = 4, keep_versions: int = 8):
        self.spark, self.root, self.target, self.base, self.fanout, self.keep_versions = spark, root.rstrip("/"), target_bytes, base_bytes, fanout, max(1, keep_versions)
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)
        for name in ("runs", "manifests", "tmp"):
            self._fs.mkdirs(self._path(f"{self.root}/{name}"))

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _size(self, name: str) -> int:
        return self._fs.getContentSummary(self._path(name)).getLength()

    # manifests

    def _names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/{folder}"))]

    def _delete(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{name}"), True)

    def versions(self) -> list[int]:
        return sorted(int(x[:-5]) for x in self._names("manifests") if x.endswith(".json"))

    def version(self) -> int:
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "next_run": 0, "schema": None, "runs": []}
        stream = self._fs.open(self._path(f"{self.root}/manifests/{version:08d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> bool:
        """Whether this manifest became the next version: False if another writer was first."""
        name = f"{manifest['version']:08d}.json"
        temporary, final = self._path(f"{self.root}/tmp/{uuid.uuid4().hex}"), self._path(f"{self.root}/manifests/{name}")
        out = self._fs.create(temporary, True)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf).rename(temporary, final, options)
        except Exception:
            if not self._fs.exists(final):
                raise
            self._fs.delete(temporary, False)
            return False
        return True

    def _commit(self, change: Callable[[dict], dict | None]) -> bool:
        """Publishes change(manifest) upon the last version, again if another writer is first; None gives up."""
        while True:
            now = self.manifest()
            new = change(now)
            if new is None:
                return False
            if self._publish(new | {"version": now["version"] + 1}):
                self._expire()
                return True

    def _expire(self) -> None:
        versions = self.versions()
        old, kept = versions[: -self.keep_versions], versions[-self.keep_versions :]
        if not old:
            return
        held = {r["name"] for v in kept for r in self.manifest(v)["runs"]}
        gone = {r["name"] for v in old for r in self.manifest(v)["runs"]} - held
        for v in old:
            self._delete(f"manifests/{v:08d}.json")
        for name in gone:
            self._delete(f"runs/{name}")

    def vacuum(self) -> list[str]:
        """Deletes runs and temporary files that no manifest names, as a crash leaves them; only while nobody writes."""
        held = {r["name"] for v in self.versions() for r in self.manifest(v)["runs"]}
        orphans = sorted(x for x in self._names("runs") if x not in held)
        for name in orphans:
            self._delete(f"runs/{name}")
        for name in self._names("tmp"):
            self._delete(f"tmp/{name}")
        return orphans

    # runs

    def _adopt(self, written: str) -> dict:
        name = f"run-{uuid.uuid4().hex}"
        if not self._fs.rename(self._path(written), self._path(f"{self.root}/runs/{name}")):
            raise OSError(f"could not move {written}")
        size = self._size(f"{self.root}/runs/{name}")
        return {"name": name, "bytes": size, "tier": max(0, math.floor(math.log(max(size, 1) / self.base, self.fanout)) + 1)}

    def append(self, df: DataFrame, arrivals: int = 1) -> None:
        """df as `arrivals` runs of small shards, dealt by a hash of the row and written in one pass."""
        column = "_arrival"
        while column in df.columns:
            column += "_"
        dealt = df.withColumn(column, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(arrivals)).cast("int"))
        place, schema = f"{self.root}/tmp/{uuid.uuid4().hex}", df.schema.json()
        dealt.write.partitionBy(column).parquet(place)
        for k in range(arrivals):
            part = f"{place}/{column}={k}"
            if not self._fs.exists(self._path(part)):
                continue
            run = self._adopt(part)
            self._commit(lambda now, run=run: now | {"next_run": now["next_run"] + 1, "schema": schema, "runs": [*now["runs"], run | {"number": now["next_run"]}]})
            self.compact()
        self._commit(lambda now: None if now["schema"] else now | {"schema": schema})
        self._fs.delete(self._path(place), True)

    def compact(self) -> None:
        """Merges until no tier holds `fanout` runs."""
        while True:
            now = self.manifest()
            tiers: dict[int, list[dict]] = {}
            for run in now["runs"]:
                tiers.setdefault(run["tier"], []).append(run)
            full = next((runs[: self.fanout] for _, runs in sorted(tiers.items()) if len(runs) >= self.fanout), None)
            if not full:
                return
            place = f"{self.root}/tmp/{uuid.uuid4().hex}"
            files = max(1, round(sum(r["bytes"] for r in full) / self.target))
            self._read(now, full).coalesce(files).write.parquet(place)
            made = self._adopt(place)
            made["tier"] = max(made["tier"], full[0]["tier"] + 1)  # rises even if compression shrank it
            gone = {r["name"] for r in full}

            def swap(now: dict, made=made, gone=gone) -> dict | None:
                if not gone <= {r["name"] for r in now["runs"]}:
                    return None  # another writer merged some of them
                return now | {"next_run": now["next_run"] + 1, "runs": [*(r for r in now["runs"] if r["name"] not in gone), made | {"number": now["next_run"]}]}

            if not self._commit(swap):
                self._delete(f"runs/{made['name']}")

    def _read(self, manifest: dict, runs: list[dict]) -> DataFrame:
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(json.loads(manifest["schema"]))
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/runs/{r['name']}" for r in runs])

    def read(self, version: int | None = None) -> DataFrame:
        now = self.manifest(version)
        return self._read(now, now["runs"])


def shard(docs: DataFrame, arrivals: int = 16, target_bytes: int = 128 << 20, base_bytes: int = 4 << 20, fanout: int = 4) -> DataFrame:
    """docs, read back through the last manifest, with shard (run/part), tier and version.

    Rows come back as they were, with nulls, empty and long texts, ties and
    repeats; an empty table gives an empty store with a schema. Columns named
    shard, tier or version are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "tier", "version")
    store = ShardStore(spark, f"{shared_dir(spark, 'shards')}", target_bytes, base_bytes, fanout, keep_versions=1)
    store.append(docs, arrivals)
    now = store.manifest()
    where = F.input_file_name()
    run = F.regexp_extract(where, r"/(run-[0-9a-f]+)/", 1)
    known = lambda k: F.element_at(F.create_map(*[x for r in now["runs"] for x in (F.lit(r["name"]), F.lit(r[k]))]), run).cast("int") if now["runs"] else F.lit(0)
    return store.read().withColumns({
        "shard": F.concat(F.format_string("run-%08d", known("number")), F.lit("/"), F.regexp_extract(where, r"/(part-\d+)", 1)), "tier": known("tier"), "version": F.lit(now["version"]).cast("long")
    })


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return shard(docs).select("doc_id", "shard", "tier", "version", F.length("text").cast("long").alias("n_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
