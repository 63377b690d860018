"""Ontologies: loading, validation, views, frames."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field, replace

import yaml

from branchwise.control.config import ConfigError, UniqueKeys

TYPES = ("multi_label", "single_choice", "leaf")
EDGES = "node_id string, child_id string, ordinal int"


class OntologyError(ValueError):
    pass


@dataclass(frozen=True)
class Node:
    id: str
    name: str
    type: str
    question: str = ""
    definition: str = ""
    includes: tuple = ()
    excludes: tuple = ()
    synonyms: tuple = ()
    children: tuple = ()
    basel: dict = field(default_factory=dict)
    traversal_threshold: float | None = None
    positive_threshold: float | None = None
    none: bool = False

    def sha256(self) -> str:
        return hashlib.sha256(json.dumps(vars(self), sort_keys=True).encode()).hexdigest()


@dataclass(frozen=True)
class Ontology:
    id: str
    version: str
    roots: tuple
    nodes: tuple
    multiple_parents: bool = False

    def sha256(self) -> str:
        said = {"id": self.id, "version": self.version, "roots": self.roots, "nodes": [vars(n) for n in self.nodes]} | ({"multiple_parents": True} if self.multiple_parents else {})
        return hashlib.sha256(json.dumps(said, sort_keys=True).encode()).hexdigest()

    def depths(self) -> dict[str, int]:
        """Of each node that a root reaches, the length of its longest path from one; there is no cycle."""
        by, out = {n.id: n for n in self.nodes}, dict.fromkeys(self.roots, 0)
        level = list(self.roots)
        while level:
            level = list(dict.fromkeys(c for i in level for c in by[i].children))
            depth = max(out.values()) + 1
            out |= dict.fromkeys(level, depth)
        return out

    def edges(self) -> list[tuple[str, str, int]]:
        return [(n.id, c, k) for n in self.nodes for k, c in enumerate(n.children)]


def load(path: str) -> Ontology:
    with open(path, encoding="utf-8") as f:
        return parse(f.read())


def parse(text: str) -> Ontology:
    try:
        raw = yaml.load(text, UniqueKeys)
    except ConfigError as e:
        raise OntologyError(str(e)) from e
    if unknown := set(raw) - {"id", "version", "roots", "nodes", "multiple_parents"}:
        raise OntologyError(f"unknown keys: {sorted(unknown)}")
    nodes = []
    for n in raw["nodes"]:  # a list: mappings would drop duplicate ids in silence
        if unknown := set(n) - set(Node.__dataclass_fields__):
            raise OntologyError(f"unknown keys of {n.get('id')}: {sorted(unknown)}")
        nodes.append(Node(**{k: tuple(v) if isinstance(v, list) else v for k, v in n.items()}))
    found = Ontology(raw["id"], str(raw["version"]), tuple(raw["roots"]), tuple(nodes), bool(raw.get("multiple_parents", False)))
    if errors := validate(found):
        raise OntologyError("; ".join(errors))
    return found


def validate(o: Ontology) -> list[str]:
    errors, by = [], {n.id: n for n in o.nodes}
    if len(by) < len(o.nodes):
        errors.append("duplicate node ids: " + ", ".join(sorted({n.id for n in o.nodes if sum(m.id == n.id for m in o.nodes) > 1})))
    if not o.roots or any(r not in by for r in o.roots):
        errors.append("a root is missing")
    parents: dict[str, list[str]] = {}
    for n in o.nodes:
        if n.type not in TYPES:
            errors.append(f"{n.id}: unknown type {n.type}")
        if n.type == "leaf" and n.children:
            errors.append(f"{n.id}: a leaf has children")
        if n.type != "leaf" and not n.children:
            errors.append(f"{n.id}: no children")
        if not (n.name and n.definition and (n.question or n.type == "leaf")):
            errors.append(f"{n.id}: an empty semantic field")
        for t in (n.traversal_threshold, n.positive_threshold):
            if t is not None and not 0 <= t <= 1:
                errors.append(f"{n.id}: threshold {t}")
        if n.none and n.type != "leaf":
            errors.append(f"{n.id}: a none choice must be a leaf")
        for c in n.children:
            parents.setdefault(c, []).append(n.id)
            if c not in by:
                errors.append(f"{n.id}: nonexistent child {c}")
    if not o.multiple_parents:
        errors += [f"{c}: {len(p)} parents" for c, p in parents.items() if len(p) > 1]
    waiting = {i: len(parents.get(i, [])) for i in by}
    free = [i for i, n in waiting.items() if not n]
    while free:
        for c in by[free.pop()].children:
            if c in waiting:
                waiting[c] -= 1
                if not waiting[c]:
                    free.append(c)
    if any(n > 0 for n in waiting.values()):
        errors.append("a cycle")
    elif all(r in by for r in o.roots) and all(c in by for c in parents) and (lost := sorted(by.keys() - o.depths().keys())):
        errors.append("no root reaches " + ", ".join(lost))
    return errors


def view(o: Ontology, depth: int) -> Ontology:
    """The ontology, a forest, cut below `depth`; what was inner there becomes a leaf."""
    if o.multiple_parents:
        raise OntologyError("a view of an ontology with several parents a node has no one depth")
    by, level, kept = {n.id: n for n in o.nodes}, list(o.roots), []
    for d in range(depth + 1):
        cut = d == depth
        kept += [replace(by[i], type="leaf", children=()) if cut else by[i] for i in level]
        level = [c for i in level for c in by[i].children]
    return replace(o, version=f"{o.version}+depth{depth}", nodes=tuple(kept))


def permuted(o: Ontology, seed: int) -> Ontology:
    """Children in the order of a hash of seed, node and child."""
    key = lambda n, c: (hashlib.sha256(f"{seed}:{n}:{c}".encode()).hexdigest(), c)
    return replace(o, version=f"{o.version}+order{seed}", nodes=tuple(replace(n, children=tuple(sorted(n.children, key=lambda c, n=n: key(n.id, c)))) for n in o.nodes))


def label_text(n: Node, level: int) -> str:
    """1: the name; 2: with the definition; 3: with inclusions and exclusions."""
    parts = [n.name]
    if level >= 2:
        parts.append(n.definition)
    if level >= 3:
        parts += [f"Includes: {', '.join(n.includes)}"] * bool(n.includes) + [f"Excludes: {', '.join(n.excludes)}"] * bool(n.excludes)
    return ". ".join(parts)
