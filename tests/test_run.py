"""A run from its configuration to stored rows, interrupted and resumed."""

import json
import os
import threading
import time
from dataclasses import replace
from functools import partial
from pathlib import Path

import pytest
import yaml
from pyspark.sql import DataFrame, Window, functions as F

from branchwise import cli
from branchwise.adapters import models
from branchwise.adapters.base import ClassificationAdapter, NodeDecision
from branchwise.control import config as cfg, provenance as pv, run as runs
from branchwise.control.files import Files
from branchwise.control.leases import Leases, leased
from branchwise.operators import traversal as tv
from branchwise.plans.catalog import fixture
from branchwise.sinks import results
from branchwise.sources import articles as src
from tests.test_control import raw_config


DEPTHS = fixture().depths()


class Recorded(ClassificationAdapter):
    """Hash scores; notes its calls in a file and fails for a share of them while a flag file is there."""

    def __init__(self, model, folder):
        self.model, self.folder = model, folder

    def classify(self, article, node, context):
        if os.path.exists(f"{self.folder}/crash") and DEPTHS[node.id] == 2:
            raise RuntimeError("crash")
        with open(f"{self.folder}/calls", "a") as f:
            f.write(f"{article.article_id} {node.id}\n")
        if os.path.exists(f"{self.folder}/failing") and int(article.article_id[-1], 16) % 3 == 0:
            return NodeDecision(node.id, status="TIMEOUT", error_code="timeout", retry_count=2)
        return models.HashAdapter(self.model).classify(article, node, context)


CODE = pv.GitState("c" * 40, False, None)
ONE = {"first": raw_config()["models"]["similarity"] | {"adapter": "hash", "model": "hash-1"}}


def registry(folder, name, model):
    return Recorded(model, folder)


@pytest.fixture()
def place(spark, tmp_path):
    raw = src.from_documents(spark, "/root/testdata/sf0.001").drop("doc_id")
    raw.coalesce(1).write.parquet(f"{tmp_path}/articles")
    [part] = [p for p in (tmp_path / "articles").iterdir() if p.name.startswith("part-")]
    part.rename(tmp_path / "articles.parquet")
    local = raw_config()["models"]["similarity"]
    over = {
        "dataset__file": f"{tmp_path}/articles.parquet", "dataset__file_sha256": cfg.sha256((tmp_path / "articles.parquet").read_bytes()), "sample__size": 12, "output__directory": f"{tmp_path}/results",
        "output__work_directory": f"{tmp_path}/work", "models": {"first": local | {"adapter": "hash", "model": "hash-1"}, "second": local | {"threshold": 0.6}},
    }

    def write(**more):
        (tmp_path / "config.yaml").write_text(yaml.safe_dump(raw_config(**over | more)))
        return cfg.load(str(tmp_path / "config.yaml"))

    write.folder = tmp_path
    return write


def calls(folder):
    return sorted((folder / "calls").read_text().split("\n")[:-1]) if (folder / "calls").exists() else []


def test_run_store_resume(spark, place):
    folder, config = place.folder, place(models=ONE)
    prepared = runs.prepare(spark, runs.validate(config, code=CODE))
    assert prepared.sample_size == 12 and prepared == runs.prepare(spark, runs.validate(config, code=CODE))
    (folder / "failing").touch()
    done = runs.run(spark, prepared, partial(registry, str(folder)))
    first, stored = calls(folder), done.read()
    manifest = json.loads(done.manifest())
    assert manifest["status"] == "INCOMPLETE" and manifest["models"]["first"]["failed_rows"] > 0 and manifest["retry_counts"]["first"] > 0
    assert len(first) == len(set(first)) == stored.select("article_id", "node_id").distinct().count()  # a call each, however often rows are read
    assert stored.where("status = 'TIMEOUT' AND (score IS NOT NULL OR selected_positive IS NOT NULL OR selected_for_traversal IS NOT NULL)").count() == 0
    assert stored.schema.names == results.TABLE.names + ["model"] or stored.schema.names == results.TABLE.names
    with pytest.raises(cfg.ConfigError, match="resume"):
        runs.run(spark, prepared, partial(registry, str(folder)))

    (folder / "failing").unlink()
    (folder / "calls").unlink()
    good = {f"{r.article_id} {r.node_id}" for r in stored.groupBy("article_id", "node_id").agg(F.min((F.col("status") == "SUCCESS").cast("int")).alias("ok")).where("ok = 1").collect()}
    again = runs.run(spark, prepared, partial(registry, str(folder)), resume=True)
    assert again.run_id == done.run_id and json.loads(again.manifest())["status"] == "COMPLETE"
    assert not set(calls(folder)) & good  # no successful call is made twice
    rows = again.read()
    assert results.duplicate_keys(rows).count() == 0 and rows.where("status <> 'SUCCESS'").count() == 0
    sample = spark.read.parquet(prepared.sample_path).select("article_id")
    want = tv.traverse(sample, fixture(), tv.hash_scorer, traversal=0.3, positive=0.5, max_depth=10, max_nodes=100)
    columns = ["article_id", "node_id", "node_depth", "child_id", "score", "selected_positive", "selected_for_traversal", "path_score", "task_root"]
    assert sorted(map(str, rows.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    assert sorted(map(str, results.read_results(spark, config.output.directory, again.run_id).select(columns).collect())) == sorted(map(str, rows.select(columns).collect()))
    (folder / "calls").unlink()
    runs.run(spark, prepared, partial(registry, str(folder)), resume=True)
    assert calls(folder) == []
    assert all(oct(p.stat().st_mode)[-3:] == ("555" if p.is_dir() else "444") for p in [Path(done.root), *Path(done.root).rglob("*")])  # sealed
    (Path(done.root)).chmod(0o755)
    (Path(done.root) / "metrics.json").write_text("{}")
    with pytest.raises(RuntimeError, match="metrics"):
        done.guard()


def test_command_line(spark, place, capsys):
    folder = place.folder
    place(output__materialize_skipped=True, output__include_latency=False)
    path = ["--config", str(folder / "config.yaml")]
    assert cli.main(["validate", *path], spark) == 0 and cli.main(["prepare", *path], spark) == 0
    assert not (folder / "results").exists()
    assert cli.main(["run", *path, "--model", "third"], spark) == 2
    assert cli.main(["run", *path, "--model", "first"], spark) == 0
    [name] = os.listdir(folder / "results")
    assert json.loads((folder / "results" / name / "manifest.json").read_text())["status"] == "INCOMPLETE"  # the second is to come
    assert cli.main(["run", *path, "--model", "second"], spark) == 0
    manifest = json.loads((folder / "results" / name / "manifest.json").read_text())
    assert os.listdir(folder / "results") == [name] and manifest["status"] == "COMPLETE" and set(manifest["models"]) == {"first", "second"} and manifest["environment"]["python"]
    assert sorted(os.listdir(folder / "results" / name)) == ["manifest.json", "results"] and sorted(os.listdir(folder / "results" / name / "results")) == ["model=first", "model=second"]
    files = [f for _, _, fs in os.walk(folder / "results" / name / "results") for f in fs]
    assert files and all(f.startswith("part-") and f.endswith(".parquet") for f in files)
    rows = spark.read.schema(results.TABLE).parquet(str(folder / "results" / name / "results"))
    per = rows.groupBy("model_id", "article_id").count().collect()
    assert {r["count"] for r in per} == {len(fixture().edges())} and len(per) == 24  # every child is a row, visited or skipped
    assert rows.where("latency_ms IS NOT NULL").count() == 0 and rows.where("status = 'SKIPPED_BY_ROUTING' AND score IS NOT NULL").count() == 0
    assert {r[0] for r in rows.where("model_id = 'second' AND child_id = 'markets'").select("local_threshold").distinct().collect()} == {0.6}
    assert {r[0] for r in rows.where("child_id = 'markets.financing.repo'").select("local_threshold").distinct().collect()} == {0.7}
    assert cli.main(["run", *path, "--model", "first", "--resume"], spark) == 0
    place(dataset__file_sha256="b" * 64)
    assert cli.main(["validate", *path], spark) == 2 and "pinned" in capsys.readouterr().err


def within_budget(rows: DataFrame, o, max_nodes: int) -> DataFrame:
    """The rows of each article's first max_nodes visited nodes in breadth-first, canonical order; ancestors come first."""
    order = rows.sparkSession.createDataFrame(list(tv._places(o).items()), "node_id string, place string")
    visited = rows.select("article_id", "node_id", "node_depth").distinct().join(F.broadcast(order), "node_id")
    first = visited.withColumn("k", F.row_number().over(Window.partitionBy("article_id").orderBy("node_depth", "place"))).where(F.col("k") <= max_nodes)
    return rows.join(first.select("article_id", "node_id"), ["article_id", "node_id"], "left_semi")


def test_budget_stops_calls(spark):
    """The cut inside the walk is the cut after it, and nodes past it are not scored."""
    arts = spark.createDataFrame([(f"a{k}",) for k in range(60)], "article_id string")
    how = {"traversal": 0.3, "positive": 0.5, "max_depth": 10}
    whole = tv.traverse(arts, fixture(), tv.hash_scorer, **how, max_nodes=None)
    for cap in (1, 2, 4):
        inside = tv.traverse(arts, fixture(), tv.hash_scorer, **how, max_nodes=cap)
        key = lambda df: sorted(map(str, df.select(*tv.COLUMNS).collect()))
        assert key(inside) == key(within_budget(whole, fixture(), cap))
        assert max(r[0] for r in inside.groupBy("article_id").agg(F.countDistinct("node_id")).select("count(DISTINCT node_id)").collect()) <= cap


def test_sample_does_not_depend_on_partitions(spark):
    ids = spark.createDataFrame([(f"x{k}",) for k in range(500)] + [("x1",)], "article_id string")
    drawn = [src.sample(ids.repartition(n), 7, 50) for n in (1, 5)]
    assert src.sample_hash(drawn[0]) == src.sample_hash(drawn[1]) and src.sample_hash(drawn[0])[1] == 50
    assert src.sample_hash(src.sample(ids, 8, 50)) != src.sample_hash(drawn[0])
    assert src.restricted(ids, drawn[0]).distinct().count() == 50


def test_snapshot_hash_gate(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a").write_text("x")
    files = Files(spark, str(tmp_path))
    src.verify_snapshot(files, f"{tmp_path}/d/a", cfg.sha256("x"))
    before = files.sha256(f"{tmp_path}/d")
    (tmp_path / "d/b").write_text("y")
    assert files.sha256(f"{tmp_path}/d") != before
    with pytest.raises(src.SnapshotMismatch):
        src.verify_snapshot(files, f"{tmp_path}/d/a", "0" * 64)


def test_a_crash_repeats_no_call_of_an_ended_level(spark, place):
    folder, config = place.folder, place(models=ONE)
    prepared = runs.prepare(spark, runs.validate(config, code=CODE))
    (folder / "crash").touch()
    with pytest.raises(Exception, match="crash"):
        runs.run(spark, prepared, partial(registry, str(folder)))
    before = calls(folder)
    ended = [c for c in before if DEPTHS[c.split()[1]] < 2]
    assert ended and not [p for p in (folder / "work").iterdir() if p.name.startswith("stage-")]
    (folder / "crash").unlink()
    (folder / "calls").unlink()
    done = runs.run(spark, prepared, partial(registry, str(folder)), resume=True)
    assert not set(calls(folder)) & set(ended) and json.loads(done.manifest())["status"] == "COMPLETE"
    sample = spark.read.parquet(prepared.sample_path).select("article_id")
    assert tv.reconcile(done.read(), sample, fixture(), 10, 100).isEmpty() and done.read().where("status <> 'SUCCESS'").isEmpty()


def test_hidden_scores_do_not_hinder_resuming(spark, place):
    folder, config = place.folder, place(models=ONE, output__include_node_scores=False)
    prepared = runs.prepare(spark, runs.validate(config, code=CODE))
    (folder / "failing").touch()
    done = runs.run(spark, prepared, partial(registry, str(folder)))
    failed = {f"{r.article_id} {r.node_id}" for r in done.read().where("status = 'TIMEOUT'").select("article_id", "node_id").distinct().collect()}
    good = set(calls(folder)) - failed
    assert good and failed and done.read().where("score IS NOT NULL").isEmpty()
    (folder / "failing").unlink()
    (folder / "calls").unlink()
    again = runs.run(spark, prepared, partial(registry, str(folder)), resume=True)
    assert not set(calls(folder)) & good and json.loads(again.manifest())["status"] == "COMPLETE" and again.read().where("score IS NOT NULL").isEmpty()


def test_a_fault_at_any_step_leaves_the_old_rows_or_the_new(spark, tmp_path, monkeypatch):
    output = cfg.parse(yaml.safe_dump(raw_config(output__directory=f"{tmp_path}/results", output__work_directory=f"{tmp_path}/work"))).output
    folder = results.RunFolder(spark, output, "20261001T221503Z_01234567")
    kinds = {"string": "x", "integer": 1, "bigint": 1, "int": 1, "double": 0.5, "boolean": True, "timestamp": None}

    def rows(article):
        row = [article if f.name == "article_id" else kinds[f.dataType.simpleString()] for f in results.TABLE.fields]
        return spark.createDataFrame([row], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in results.TABLE.fields))

    def commit(article):
        live = {"m": folder.write(rows(article), "m")}
        folder.write_manifest(json.dumps({"live": live}))
        folder.sweep()

    commit("old")
    left = [0]

    def faulty(name):
        true = getattr(Files, name)

        def run(self, *a):
            left[0] -= 1
            if left[0] == 0:
                raise OSError(f"fault in {name}")
            return true(self, *a)

        monkeypatch.setattr(Files, name, run)

    for name in ("move", "delete", "write", "_swap", "names", "walk", "read"):
        faulty(name)
    seen = []
    for step in range(1, 40):
        left[0] = step
        try:
            commit("new")
            failed = False
        except OSError:
            failed = True
        left[0] = 0
        [found] = folder.read("m").select("article_id").collect()
        seen.append((failed, found[0]))
        if not failed:
            break
        if found[0] == "new":
            commit("old")
    assert not failed and found[0] == "new" and {x for f, x in seen if f} == {"old", "new"}
    folder.sweep()
    assert {x.split("-")[1] for x in folder.files.walk(f"{folder.root}/results")} == {folder.live()["m"]}


def test_rows_of_another_model_never_count(spark, place, monkeypatch):
    folder, config = place.folder, place(models={"hosted": raw_config()["models"]["hosted"] | {"enabled": True}})
    monkeypatch.setenv("MODEL_API_KEY", "k")
    prepared = runs.prepare(spark, runs.validate(config, code=CODE))
    with pytest.raises(Exception, match="answered by"):
        runs.run(spark, prepared, partial(other_model, str(folder)))
    name = results.RunFolder.find(spark, config.output, prepared.digest)
    assert results.RunFolder(spark, config.output, name).read() is None
    monkeypatch.setattr(runs, "_speculates", lambda _: True)
    with pytest.raises(cfg.ConfigError, match="speculation"):
        runs.run(spark, prepared, partial(other_model, str(folder)), resume=True)


class _Other(ClassificationAdapter):
    def classify(self, article, node, context):
        return NodeDecision(node.id, {c.id: 0.5 for c in context.children}, returned_version="another")


def other_model(folder, name, model):
    return _Other()


def test_leases_never_pass_the_slots(spark, tmp_path):
    files, held, most, lock = Files(spark, str(tmp_path)), [0], [0], threading.Lock()

    def take(wanted):
        mine = Leases(files, str(tmp_path), ["p", "m"])
        n = mine.take(wanted)
        with lock:
            held[0] += n
            most[0] = max(most[0], held[0])
        time.sleep(0.05)
        with lock:
            held[0] -= n
        mine.give_back()

    threads = [threading.Thread(target=take, args=(3,)) for _ in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert most[0] == 3
    one, other, apart = (Leases(files, str(tmp_path), ["p", m], stale=1.0) for m in ("m", "m", "n"))
    assert one.take(2) == 2 and one.take(2) == 2 and other.take(3) == 1 and apart.take(2) == 2
    with pytest.raises(cfg.ConfigError, match="hold all 2 calls"):
        with leased(Leases(files, str(tmp_path), ["p", "m"]), 2, "x"):
            raise AssertionError
    assert one.renew() and other.renew()
    time.sleep(1.2)
    assert other.renew() and other.take(3) == 3 and not one.renew() and one.lost.is_set()  # `one` stood still
    one.give_back()
    assert other.renew() and Leases(files, str(tmp_path), ["p", "m"]).take(3) == 0
    other.give_back()
    with leased(Leases(files, str(tmp_path), ["p", "m"], stale=0.4), 3, "x") as n:
        time.sleep(1.0)
        assert n == 3 and Leases(files, str(tmp_path), ["p", "m"], stale=0.4).take(3) == 0  # renewed meanwhile


class Timed(ClassificationAdapter):
    """Hash scores; notes when each call begins and ends."""

    def __init__(self, folder):
        self.folder = folder

    def classify(self, article, node, context):
        began = time.time()
        time.sleep(0.03)
        with open(f"{self.folder}/calls", "a") as f:
            f.write(f"{began} {time.time()}\n")
        return replace(models.HashAdapter(LOCAL_HASH).classify(article, node, context), returned_version=raw_config()["models"]["hosted"]["model"])


LOCAL_HASH = cfg.parse(yaml.safe_dump(raw_config(models=ONE))).models["first"]


def test_a_run_makes_no_more_calls_at_once_than_others_leave(spark, place, monkeypatch):
    monkeypatch.setenv("MODEL_API_KEY", "k")
    hosted = raw_config()["models"]["hosted"] | {"enabled": True, "concurrency": 6}
    folder, config = place.folder, place(models={"first": hosted})
    prepared = runs.prepare(spark, runs.validate(config, code=CODE))
    model, work = config.models["first"], config.output.work_directory
    others = Leases(Files(spark, work), work, [model.provider, model.model])
    assert others.take(6) == 6
    make = lambda name, m: Timed(str(folder))
    with pytest.raises(cfg.ConfigError, match="hold all 6 calls"):
        runs.run(spark, prepared, make)
    assert not (folder / "calls").exists()
    others.give_back()
    assert others.take(4) == 4
    done = runs.run(spark, prepared, make, resume=True)
    spans = [tuple(map(float, x.split())) for x in (folder / "calls").read_text().splitlines()]
    moments = sorted([(a, 1) for a, _ in spans] + [(b, -1) for _, b in spans])
    now = most = 0
    for _, step in moments:
        now += step
        most = max(most, now)
    assert 1 <= most <= 2 and len(done.read().take(1)) == 1
    others.give_back()
    assert Leases(Files(spark, work), work, [model.provider, model.model]).take(6) == 6  # the run has given its own back
