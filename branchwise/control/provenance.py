"""Run identity, environment and manifest."""

from __future__ import annotations

import importlib.metadata
import json
import os
import platform
import re
import subprocess
import sys
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path

from branchwise.control.config import Config, ConfigError, canonical_json, sha256
from branchwise.functions.text import NORMALIZATION_VERSION

RUNNING, INCOMPLETE, COMPLETE = "RUNNING", "INCOMPLETE", "COMPLETE"
LIBRARIES = ("pyspark", "pandas", "pyarrow", "pydantic", "PyYAML")


@dataclass(frozen=True)
class GitState:
    commit: str
    dirty: bool
    diff_sha256: str | None


def code_state(folder: str) -> GitState:
    """Of a checkout; elsewhere, as in an installed package, the version and contents of the package's files stand for the commit."""
    if os.path.exists(os.path.join(folder, ".git")):
        return git_state(folder)
    package = Path(__file__).resolve().parents[1]
    files = sorted(p for p in package.rglob("*") if p.is_file() and "__pycache__" not in p.parts)
    content = sha256("".join(f"{p.relative_to(package)}\t{sha256(p.read_bytes())}\n" for p in files))
    try:
        version = importlib.metadata.version("branchwise")
    except importlib.metadata.PackageNotFoundError:
        version = "0"
    return GitState(f"package-{version}-{content}", False, None)


def git_state(folder: str) -> GitState:
    """Commit, and a hash of all that differs from it: changes, and names and contents of untracked files."""

    def git(*args: str) -> bytes:
        done = subprocess.run(["git", "-c", f"safe.directory={os.path.realpath(folder)}", "-C", folder, *args], capture_output=True)
        if done.returncode:
            raise ConfigError(f"no git state of {folder}: git {args[0]}: {done.stderr.decode(errors='replace').strip()}")
        return done.stdout

    try:
        commit, status = git("rev-parse", "HEAD").decode().strip(), git("status", "--porcelain", "-z", "--untracked-files=all")
        if not status:
            return GitState(commit, False, None)
        top = git("rev-parse", "--show-toplevel").decode().rstrip("\n")
        new = [x for x in git("-C", top, "ls-files", "--others", "--exclude-standard", "-z").split(b"\0") if x]
        held = b"".join(x + b"\0" + sha256((Path(top) / os.fsdecode(x)).read_bytes()).encode() + b"\n" for x in sorted(new))
        return GitState(commit, True, sha256(git("diff", "HEAD", "--binary") + status + held))
    except OSError as e:
        raise ConfigError(f"no git state of {folder}: {e}") from e


def check_git(config: Config, git: GitState) -> None:
    if git.dirty and not config.run.allow_dirty_git:
        raise ConfigError("the git tree is dirty and run.allow_dirty_git is false")


def identity(config: Config, ontology_hash: str, dataset_hash: str, sample_hash: str, template_hashes: dict[str, str], git: GitState) -> str:
    """The authoritative part of a run's name: a hash of all that could change a result, and of nothing else."""
    parts = [config.resolved(), ontology_hash, dataset_hash, sample_hash, template_hashes, git.commit, git.diff_sha256, NORMALIZATION_VERSION]
    return sha256("\x1f".join(map(canonical_json, parts)))


def run_id(digest: str, now: datetime | None = None) -> str:
    return f"{(now or datetime.now(UTC)).strftime('%Y%m%dT%H%M%SZ')}_{digest[:8]}"


def is_run_id(name: str) -> bool:
    return bool(re.fullmatch(r"\d{8}T\d{6}Z_[0-9a-f]{8}", name))


def environment(libraries: tuple[str, ...] = ()) -> dict:
    """libraries: those that the adapters of a run name besides the engine's own."""

    def version(name: str) -> str | None:
        try:
            return importlib.metadata.version(name)
        except importlib.metadata.PackageNotFoundError:
            return None

    try:
        gpus = subprocess.run(["nvidia-smi", "--query-gpu=name,driver_version", "--format=csv,noheader"], capture_output=True, text=True, check=True).stdout.strip().splitlines()
    except (OSError, subprocess.CalledProcessError):
        gpus = []
    return {"python": sys.version.split()[0], "os": platform.platform(), "cpu": platform.processor() or platform.machine(), "gpu": gpus, "cuda": None if not gpus else gpus[0].rpartition(", ")[2], "libraries": {n: version(n) for n in dict.fromkeys((*LIBRARIES, *libraries))}}


def manifest(config: Config, name: str, status: str, git: GitState, hashes: dict, sample_size: int, models: dict, started: str, completed: str | None, retries: dict[str, int], live: dict[str, str], libraries: tuple[str, ...] = ()) -> dict:
    """Provenance alone: no judgments, no metrics. live: of each model the generation of result files that counts."""
    return {
        "run_id": name, "benchmark_spec": config.benchmark.spec_version, "status": status, "identity_sha256": hashes["identity"],
        "git": {"commit": git.commit, "dirty": git.dirty, "diff_sha256": git.diff_sha256},
        "dataset": {"provider": config.dataset.provider, "repository": config.dataset.repository, "file": config.dataset.file, "revision": config.dataset.revision, "sha256": hashes["dataset"]},
        "sample": {"size": sample_size, "seed": config.run.seed, "manifest_sha256": hashes["sample"]},
        "ontology": {"version": config.ontology.version, "sha256": hashes["ontology"]},
        "models": models, "config": config.resolved(), "config_sha256": sha256(config.resolved()), "template_hashes": hashes["templates"],
        "normalization_version": NORMALIZATION_VERSION, "materialize_skipped": config.output.materialize_skipped, "retry_counts": retries, "live": live,
        "environment": environment(libraries), "started_at": started, "completed_at": completed,
    }


def to_json(value: dict) -> str:
    return json.dumps(value, sort_keys=True, indent=1, ensure_ascii=False) + "\n"
