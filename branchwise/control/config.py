"""Strict run configuration: every key is written in the YAML, none has a default in code."""

from __future__ import annotations

import hashlib
import json
import os
import re
from typing import Annotated, Literal

import yaml
from pydantic import BaseModel, ConfigDict, Field, ValidationError, field_validator

HEX = re.compile(r"[0-9a-f]{7,64}")
SHA256 = re.compile(r"[0-9a-f]{64}")
Share = Annotated[float, Field(ge=0, le=1)]
Count = Annotated[int, Field(ge=1)]


class ConfigError(ValueError):
    """The configuration or one of its pinned inputs is not fit for a run."""


class Strict(BaseModel):
    model_config = ConfigDict(extra="forbid", frozen=True, protected_namespaces=(), strict=True)


def pinned(value: str) -> str:
    if not value or value.startswith("<") or re.search(r"(^|[-_:/@. ])latest$", value, re.I):
        raise ValueError(f"{value!r} is not pinned")
    return value


def content_hash(value: str) -> str:
    if not SHA256.fullmatch(value):
        raise ValueError(f"{value!r} is no SHA-256")
    return value


class Benchmark(Strict):
    name: str
    spec_version: str


class Run(Strict):
    label: str
    seed: int
    allow_dirty_git: bool


class Dataset(Strict):
    provider: str
    repository: str
    revision: str
    file: str
    file_sha256: str

    _pinned = field_validator("revision", "file")(pinned)
    _hash = field_validator("file_sha256")(content_hash)

    @field_validator("revision")
    @classmethod
    def _commit(cls, value: str) -> str:
        if not HEX.fullmatch(value):
            raise ValueError(f"revision {value!r} is no commit")
        return value


class OntologyRef(Strict):
    path: str
    version: str
    sha256: str
    view_depth: Count | None
    child_order_seed: int | None

    _hash = field_validator("sha256")(content_hash)


class Sample(Strict):
    size: Count


class Normalization(Strict):
    unicode: Literal["NFC", "none"]
    collapse_whitespace: bool
    strip_html: bool


class Input(Strict):
    mode: Literal["headline_plus_article", "headline_plus_lead"]
    max_chars: Count
    separator: str
    normalization: Normalization

    @field_validator("mode", mode="before")
    @classmethod
    def _spelling(cls, value: str) -> str:
        return {"headline + article": "headline_plus_article", "headline + full_article": "headline_plus_article"}.get(value, value)


class Traversal(Strict):
    mode: Literal["breadth_first", "depth_first"]  # recorded; rows do not depend on it
    threshold: Share
    max_depth: Count
    max_nodes_per_article: Count


class Classification(Strict):
    positive_threshold: Share


class Hierarchy(Strict):
    traversal: Traversal
    classification: Classification


class Templates(Strict):
    directory: str
    version: str
    label_level: Annotated[int, Field(ge=1, le=3)]


class HostedModel(Strict):
    adapter: Literal["hosted"]
    enabled: bool
    provider: str
    model: str
    api_key_env: str
    timeout_seconds: Annotated[float, Field(gt=0)]
    retries: Annotated[int, Field(ge=0)]
    concurrency: Count
    allow_returned_model_mismatch: bool

    _pinned = field_validator("model")(pinned)

    @property
    def version(self) -> str:
        return self.model


class LocalModel(Strict):
    adapter: Literal["label_encoder", "nli", "embedding", "hash"]
    enabled: bool
    provider: str
    model: str
    revision: str
    device: str
    batch_size: Count
    threshold: Share

    _pinned = field_validator("model", "revision")(pinned)

    @field_validator("revision")
    @classmethod
    def _commit(cls, value: str) -> str:
        if not HEX.fullmatch(value):
            raise ValueError(f"revision {value!r} is no commit")
        return value

    @property
    def version(self) -> str:
        return f"{self.model}@{self.revision}"


class Output(Strict):
    directory: str
    work_directory: str
    format: Literal["parquet"]
    include_node_scores: bool
    include_latency: bool
    include_usage: bool
    include_raw_provider_response: bool
    materialize_skipped: bool


class Config(Strict):
    benchmark: Benchmark
    run: Run
    dataset: Dataset
    ontology: OntologyRef
    sample: Sample
    input: Input
    hierarchy: Hierarchy
    templates: Templates
    models: dict[str, Annotated[HostedModel | LocalModel, Field(discriminator="adapter")]]
    output: Output

    @field_validator("models")
    @classmethod
    def _names(cls, models: dict) -> dict:
        if bad := [m for m in models if not re.fullmatch(r"[A-Za-z0-9_-]+", m)]:
            raise ValueError(f"model names {bad} do not fit a folder name")
        return models

    def enabled(self, only: str | None = None) -> dict[str, HostedModel | LocalModel]:
        found = {k: m for k, m in self.models.items() if m.enabled}
        if only is None:
            return found
        if only not in found:
            raise ConfigError(f"model {only!r} is not enabled")
        return {only: found[only]}

    def resolved(self) -> dict:
        """Plain data; of secrets it holds the names of environment variables alone."""
        return self.model_dump(mode="json")


class UniqueKeys(yaml.SafeLoader):
    def construct_mapping(self, node, deep=False):
        seen = [self.construct_object(k, deep=True) for k, _ in node.value]
        if len(seen) != len(set(seen)):
            raise ConfigError(f"line {node.start_mark.line + 1}: a key is written twice")
        return super().construct_mapping(node, deep)


def parse(text: str) -> Config:
    try:
        raw = yaml.load(text, UniqueKeys)  # noqa: S506  a SafeLoader
        return Config.model_validate(raw)
    except (yaml.YAMLError, ValidationError) as e:
        raise ConfigError(str(e)) from e


def load(path: str) -> Config:
    with open(path, encoding="utf-8") as f:
        return parse(f.read())


def canonical_json(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def sha256(value) -> str:
    """Of bytes or text as they are, of other values by their canonical JSON."""
    raw = value if isinstance(value, bytes) else (value if isinstance(value, str) else canonical_json(value)).encode()
    return hashlib.sha256(raw).hexdigest()


def secret(name: str) -> str:
    """Read where it is used, on the worker, and never kept in a plan, a column or a file."""
    value = os.environ.get(name, "")
    if not value:
        raise ConfigError(f"environment variable {name} is not set")
    return value


def check_credentials(config: Config) -> None:
    for model in config.enabled().values():
        if isinstance(model, HostedModel):
            secret(model.api_key_env)


def json_schema() -> dict:
    return Config.model_json_schema()
