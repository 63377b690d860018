"""Versioned templates that turn a node into an adapter's own label text."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path
from string import Formatter

from branchwise.control.config import ConfigError, sha256
from branchwise.sources.ontology import Node, label_text

FIELDS = {"id", "name", "question", "definition", "includes", "excludes", "synonyms", "label"}


@dataclass(frozen=True)
class Template:
    adapter: str
    version: str
    text: str

    @property
    def sha256(self) -> str:
        return sha256(self.text)

    def render(self, node: Node, level: int) -> str:
        """All adapters see the same fields of a node; `level` says how much of it `label` holds."""
        return self.text.format(**values(node, level))


def values(node: Node, level: int) -> dict[str, str]:
    shown = {"definition": node.definition if level >= 2 else "", "includes": ", ".join(node.includes) if level >= 3 else "", "excludes": ", ".join(node.excludes) if level >= 3 else ""}
    return {"id": node.id, "name": node.name, "question": node.question, "synonyms": ", ".join(node.synonyms), "label": label_text(node, level), **shown}


def load(directory: str, adapter: str, version: str) -> Template:
    path = Path(directory) / adapter / f"{version}.txt"
    if not path.is_file():
        raise ConfigError(f"no template {path}")
    found = Template(adapter, version, path.read_text(encoding="utf-8").rstrip("\n"))
    try:
        asked = {f for _, f, _, _ in Formatter().parse(found.text) if f is not None}
    except ValueError as e:
        raise ConfigError(f"{path}: {e}") from e
    if not asked or asked - FIELDS:
        raise ConfigError(f"{path}: fields {sorted(asked)}, known are {sorted(FIELDS)}")
    return found
