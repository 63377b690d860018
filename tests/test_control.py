"""Configuration, identity, templates and adapters: no Spark."""

import ast
import copy
import re
import subprocess
import sys
import threading
import time
from dataclasses import replace
from datetime import UTC, datetime
from pathlib import Path

import pytest
import yaml

from branchwise.adapters import models
from branchwise.adapters.base import (
    ArticleInput, AuthenticationFailed, ClassificationContext, NodeDecision, RateLimited, ReturnedModelMismatch, TimedOut, with_retries,
)
from branchwise.control import config as cfg, provenance as pv, run as runs
from branchwise.plans.catalog import DATA, fixture
from branchwise.sources import ontology as onto, templates

ONTOLOGY = DATA / "fixture_ontology.yaml"


def raw_config(**over):
    raw = yaml.safe_load((DATA / "example_config.yaml").read_text())
    raw["dataset"] |= {"revision": "0123abc", "file": "/data/articles.parquet", "file_sha256": "a" * 64}
    raw["ontology"] |= {"path": str(ONTOLOGY), "sha256": cfg.sha256(ONTOLOGY.read_bytes())}
    raw["templates"]["directory"] = str(DATA / "templates")
    raw["run"]["allow_dirty_git"] = True
    for path, value in over.items():
        *way, last = path.split("__")
        at = raw
        for k in way:
            at = at[k]
        at[last] = value
    return raw


def config(**over):
    return cfg.parse(yaml.safe_dump(raw_config(**over)))


def leaves(raw, way=()):
    for k, v in raw.items():
        yield from leaves(v, (*way, k)) if isinstance(v, dict) else [(*way, k)]


def test_every_key_is_required_and_no_other_known():
    assert config().models["similarity"].version == "hashed-words-256@0000000"
    for way in leaves(raw_config()):
        raw = raw_config()
        at = raw
        for k in way[:-1]:
            at = at[k]
        del at[way[-1]]
        with pytest.raises(cfg.ConfigError):
            cfg.parse(yaml.safe_dump(raw))
        at[way[-1] + "_"] = 1
        with pytest.raises(cfg.ConfigError):
            cfg.parse(yaml.safe_dump(raw))


@pytest.mark.parametrize("over", [
    {"dataset__revision": "<PINNED_COMMIT_SHA>"}, {"dataset__revision": "main"}, {"dataset__file_sha256": "<SHA256>"}, {"ontology__sha256": "abc"}, {"models__hosted__model": "model-latest"},
    {"models__hosted__model": "latest"}, {"models__similarity__revision": "<PINNED>"}, {"hierarchy__traversal__threshold": 1.01}, {"hierarchy__classification__positive_threshold": -0.1},
    {"models__similarity__threshold": 2.0}, {"run__seed": None}, {"run__seed": "1"}, {"hierarchy__traversal__max_depth": 0}, {"input__mode": "headline_plus_summary"}, {"output__format": "csv"}, {"sample__size": 0},
])
def test_bad_values_fail(over):
    with pytest.raises(cfg.ConfigError):
        config(**over)


def test_keys_written_twice_fail():
    with pytest.raises(cfg.ConfigError, match="twice"):
        cfg.parse(yaml.safe_dump(raw_config()) + "\nsample: {size: 5}\n")


def test_checks_before_any_call(monkeypatch, tmp_path):
    code = pv.GitState("c" * 40, True, "d" * 64)
    assert runs.validate(config(), code=code).ontology == fixture() and runs.validate(config()).git.commit
    with pytest.raises(cfg.ConfigError, match="pinned"):
        runs.validate(config(ontology__sha256="b" * 64))
    with pytest.raises(cfg.ConfigError, match="version"):
        runs.validate(config(ontology__version="2.0.0"))
    monkeypatch.delenv("MODEL_API_KEY", raising=False)
    with pytest.raises(cfg.ConfigError, match="MODEL_API_KEY"):
        runs.validate(config(models__hosted__enabled=True))
    with pytest.raises(cfg.ConfigError, match="enabled"):
        runs.validate(config(models__similarity__enabled=False))
    with pytest.raises(cfg.ConfigError, match="template"):
        runs.validate(config(templates__version="v9"))
    broken = tmp_path / "o.yaml"
    for old, new in (("children: [gsib_activity, market_context_only]", "children: [gsib_activity, gone]"), ("children: [markets, lending]", "children: [markets, lending, relevance]"), ("{id: lending.leveraged.bridge", "{id: lending.leveraged.acquisition"), ('name: Repo, type: leaf', 'name: Repo, type: leaf, children: [lending]')):
        broken.write_text(ONTOLOGY.read_text().replace(old, new))
        with pytest.raises(onto.OntologyError):
            runs.validate(config(ontology__path=str(broken), ontology__sha256=cfg.sha256(broken.read_bytes())))
    with pytest.raises(cfg.ConfigError, match="dirty"):
        runs.validate(config(run__allow_dirty_git=False), code=code)
    assert config().enabled("similarity") and pytest.raises(cfg.ConfigError, config().enabled, "hosted")


def test_secrets_stay_out_of_the_resolved_configuration(monkeypatch):
    monkeypatch.setenv("MODEL_API_KEY", "s3cret-value")
    c = config(models__hosted__enabled=True)
    cfg.check_credentials(c)
    assert "MODEL_API_KEY" in cfg.canonical_json(c.resolved()) and "s3cret" not in cfg.canonical_json(c.resolved())
    root = Path(runs.REPOSITORY)
    assert {".env", ".env.*", "!.env.example", "secrets/"} <= set((root / ".gitignore").read_text().split())
    assert all(x.endswith("=") for x in (root / ".env.example").read_text().split())


GIT = pv.GitState("c" * 40, False, None)


def digest(c, o="o", d="d", s="s", t=None, git=GIT):
    return pv.identity(c, o, d, s, t or {"m": "t"}, git)


def test_identity_follows_every_input():
    base = digest(config())
    assert base == digest(config())
    others = [digest(config(), o="x"), digest(config(), d="x"), digest(config(), s="x"), digest(config(), t={"m": "x"}), digest(config(), git=replace(GIT, commit="e" * 40)), digest(config(), git=replace(GIT, dirty=True, diff_sha256="f"))]
    changed = {"run__seed": 1, "hierarchy__traversal__threshold": 0.31, "models__similarity__revision": "0000001", "input__separator": " ", "templates__label_level": 2, "ontology__view_depth": 2, "ontology__child_order_seed": 3, "input__mode": "headline_plus_lead"}
    others += [digest(config(**{k: v})) for k, v in changed.items()]
    assert len({base, *others}) == len(others) + 1
    name = pv.run_id(base, datetime(2026, 10, 1, 22, 15, 3, tzinfo=UTC))
    assert name == f"20261001T221503Z_{base[:8]}" and pv.is_run_id(name)
    views = runs.experiments(config(), [1, 2], [5], [1, 2])
    assert len({digest(c) for c in views.values()} | {base}) == 6


def test_ontology_text_and_topology_change_its_hash():
    o = fixture()
    n = list(o.nodes)
    assert len({x.sha256() for x in (o, onto.view(o, 2), onto.permuted(o, 1), replace(o, nodes=(replace(n[0], question="Other?"), *n[1:])), replace(o, nodes=(replace(n[0], children=n[0].children[::-1]), *n[1:])))}) == 5


def test_templates(tmp_path):
    node = next(n for n in fixture().nodes if n.includes)
    t = templates.load(str(DATA / "templates"), "nli", "v1")
    assert t.render(node, 1) == "This text describes Debt capital markets." and "Includes: bonds, notes" in t.render(node, 3) and "bonds" not in t.render(node, 2)
    (tmp_path / "nli").mkdir()
    for bad in ("{unknown}", "no field", "{label"):
        (tmp_path / "nli/v1.txt").write_text(bad)
        with pytest.raises(cfg.ConfigError):
            templates.load(str(tmp_path), "nli", "v1")


def context(node, adapter="hosted", level=3):
    by = {n.id: n for n in fixture().nodes}
    return ClassificationContext(tuple(by[c] for c in node.children), templates.load(str(DATA / "templates"), adapter, "v1"), level)


MULTI, SINGLE = (next(n for n in fixture().nodes if n.id == i) for i in ("markets.financing", "markets.underwriting"))
ARTICLE = ArticleInput("a-1", "A dealer lent securities against cash in a repurchase.")
LOCAL = config().models["similarity"]


def hosted(transport, **over):
    return models.HostedAdapter(config(models__hosted__retries=2, **over).models["hosted"], transport, wait=lambda _: None)


def answer(request, key, timeout):
    assert key == "k" and timeout == 60
    return 200, {"model": request["model"], "scores": {o["id"]: 0.5 for o in request["options"]}, "usage": {"input_tokens": 7, "output_tokens": 2, "cost_usd": 0.001}}


@pytest.fixture()
def key(monkeypatch):
    monkeypatch.setenv("MODEL_API_KEY", "k")


def adapters():
    even = lambda pairs: [[0.25] * len(labels) for _, labels in pairs]
    return {
        "hosted": hosted(answer), "label_encoder": models.LabelEncoderAdapter(LOCAL, even), "nli": models.NliAdapter(LOCAL, lambda pairs: [len(h) % 7 / 7 for _, h in pairs]),
        "embedding": models.EmbeddingAdapter(LOCAL, models.hashed_words), "hash": models.HashAdapter(LOCAL),
    }


def test_all_adapters_keep_one_contract(key):
    for name, adapter in adapters().items():
        items = [(ArticleInput(f"a{k}", f"text {k} of repo and loans"), n, context(n, name)) for k in range(40) for n in (MULTI, SINGLE)]
        made = adapter.classify_batch(items)
        assert [d.node_id for d in made] == [n.id for _, n, _ in items], name
        for d, (a, n, c) in zip(made, items):
            assert isinstance(d, NodeDecision) and d.status == "SUCCESS" and set(d.scores) == set(n.children) and all(0 <= x <= 1 for x in d.scores.values()), name
            assert adapter.classify(a, n, c).scores == d.scores


def test_hosted_decision_kinds_and_telemetry(key):
    asked = []
    adapter = hosted(lambda r, k, t: asked.append(r) or answer(r, k, t))
    d = adapter.classify(ARTICLE, MULTI, context(MULTI))
    adapter.classify(ARTICLE, SINGLE, context(SINGLE))
    assert [r["decision"] for r in asked] == ["binary", "choice"] and "Repurchase" in asked[0]["options"][0]["text"]
    assert (d.input_tokens, d.output_tokens, d.provider_cost_usd, d.returned_version, d.retry_count) == (7, 2, 0.001, "model-2026-01-01", 0) and d.latency_ms >= 0


@pytest.mark.parametrize("code, status, calls", [(429, "RATE_LIMITED", 3), (503, "PROVIDER_ERROR", 3), (504, "TIMEOUT", 3), (400, "INVALID_REQUEST", 1), (TimeoutError, "TIMEOUT", 3), (ConnectionError, "PROVIDER_ERROR", 3)])
def test_failures_have_a_status_and_no_scores(key, code, status, calls):
    count = []

    def transport(*_):
        count.append(1)
        if not isinstance(code, int):
            raise code()
        return code, {}

    d = hosted(transport).classify(ARTICLE, MULTI, context(MULTI))
    assert (d.status, d.scores, len(count), d.retry_count) == (status, {}, calls, calls - 1) and d.error_code


def test_a_retry_that_succeeds_counts_and_auth_and_mismatch_end_the_run(key):
    left = [2]

    def transport(*x):
        left[0] -= 1
        return (429, {}) if left[0] >= 0 else answer(*x)

    d = hosted(transport).classify(ARTICLE, MULTI, context(MULTI))
    assert (d.status, d.retry_count) == ("SUCCESS", 2)
    with pytest.raises(AuthenticationFailed):
        hosted(lambda *_: (401, {})).classify(ARTICLE, MULTI, context(MULTI))
    other = lambda r, k, t: (200, {"model": "other", "scores": {}})
    with pytest.raises(ReturnedModelMismatch):
        hosted(other).classify(ARTICLE, MULTI, context(MULTI))
    assert hosted(other, models__hosted__allow_returned_model_mismatch=True).classify(ARTICLE, MULTI, context(MULTI)).returned_version == "other"
    assert hosted(lambda *_: (200, {"scores": "bad"})).classify(ARTICLE, MULTI, context(MULTI)).status == "MODEL_ERROR"


def test_retries_are_bounded_and_waits_grow():
    waits = []

    def call():
        raise RateLimited()

    assert with_retries(call, "n", 3, waits.append).retry_count == 3 and waits == sorted(waits) and len(waits) == 3
    assert with_retries(lambda: (_ for _ in ()).throw(TimedOut()), "n", 0, waits.append).status == "TIMEOUT"


def test_similarity_knows_the_nearer_node():
    adapter = models.EmbeddingAdapter(LOCAL, models.hashed_words)
    s = adapter.classify(ArticleInput("a", "Repo: a repurchase agreement. Repo repurchase."), MULTI, context(MULTI, "embedding")).scores
    assert max(s, key=s.get) == "markets.financing.repo"


def test_package_imports_nothing_beyond_its_own_and_what_is_allowed():
    """By the import graph: no evaluation package, and nothing of the training-data operators."""
    allowed = {"__future__", "branchwise", "pyspark", "pandas", "pyarrow", "pydantic", "yaml", "numpy", *sys.stdlib_module_names}
    package = Path(runs.__file__).parents[1]
    for p in package.rglob("*.py"):
        if "llm" in p.relative_to(package).parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            for name in names:
                assert name.split(".")[0] in allowed and not name.startswith("branchwise.llm"), (p, name)
                assert not re.search(r"adjudicat|gold|evaluat", name), (p, name)
        assert "labels.parquet" not in p.read_text(), p


def git(folder, *args):
    subprocess.run(["git", "-c", "user.name=t", "-c", "user.email=t@localhost", "-C", str(folder), *args], check=True, capture_output=True)


def test_code_identity_follows_contents(tmp_path):
    repo = tmp_path / "repo"
    repo.mkdir()
    git(repo, "init", "-q")
    (repo / "a.py").write_text("1")
    git(repo, "add", "-A")
    git(repo, "commit", "-qm", "one")
    clean = pv.code_state(str(repo))
    assert not clean.dirty and clean.diff_sha256 is None and len(clean.commit) == 40
    states = [clean]
    for change in (lambda: (repo / "new.py").write_text("1"), lambda: (repo / "new.py").write_text("2"), lambda: (repo / "a.py").write_text("2"), lambda: (repo / "new.py").rename(repo / "other.py")):
        change()
        states.append(pv.code_state(str(repo)))
    assert all(s.dirty for s in states[1:]) and len({s.diff_sha256 for s in states}) == 5
    (repo / ".git" / "HEAD").write_text("broken")
    with pytest.raises(cfg.ConfigError, match="rev-parse"):
        pv.code_state(str(repo))
    installed = pv.code_state(str(tmp_path))
    assert installed.commit.startswith("package-") and installed == pv.code_state(str(tmp_path)) and not installed.dirty


def test_a_hanging_call_ends_at_its_deadline(key):
    began = time.monotonic()
    adapter = models.HostedAdapter(config(models__hosted__retries=1, models__hosted__timeout_seconds=1).models["hosted"], lambda *_: time.sleep(20), wait=lambda _: None)
    d = adapter.classify(ARTICLE, MULTI, context(MULTI))
    assert (d.status, d.error_code, d.retry_count) == ("TIMEOUT", "deadline", 1) and time.monotonic() - began < 8


def test_a_provider_is_waited_for_as_it_asks(key):
    waits, answers = [], [(429, {}, {"Retry-After": "7"}), (503, {}, {"retry-after": "Wed, 21 Oct 2026 07:28:00 GMT"}), (429, {}, {"Retry-After": "100000"}), (429, {})]
    adapter = models.HostedAdapter(config(models__hosted__retries=4).models["hosted"], lambda *x: answers.pop(0) if answers else answer(*x), wait=waits.append)
    d = adapter.classify(ARTICLE, MULTI, context(MULTI))
    assert d.status == "SUCCESS" and d.retry_count == 4
    assert waits[0] == 7 and 1 <= waits[1] <= 1.5 and waits[2] == 120 and 4 <= waits[3] <= 6


def test_calls_at_once_never_pass_the_models_concurrency(key):
    now, most, lock = [0], [0], threading.Lock()

    def transport(*x):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.01)
        with lock:
            now[0] -= 1
        return answer(*x)

    adapter = models.HostedAdapter(config().models["hosted"], transport, concurrency=3)
    adapter.classify_batch([(ARTICLE, MULTI, context(MULTI))] * 40)
    assert 1 < most[0] <= 3


def test_a_label_is_embedded_once():
    seen = []
    adapter = models.EmbeddingAdapter(LOCAL, lambda texts: seen.extend(texts) or models.hashed_words(texts))
    for k in range(3):
        adapter.classify_batch([(ArticleInput(f"a{i}", f"text {k} {i}"), n, context(n, "embedding")) for i in range(40) for n in (MULTI, SINGLE)])
    labels = {x for n in (MULTI, SINGLE) for x in context(n, "embedding").labels()}
    assert all(seen.count(x) == 1 for x in labels)


def test_json_schema_is_strict():
    schema = cfg.json_schema()
    assert schema["additionalProperties"] is False and set(schema["required"]) == set(schema["properties"])
    assert copy.deepcopy(schema) == schema
