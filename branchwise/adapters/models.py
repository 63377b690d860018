"""Adapters of the model kinds. Transports and backends are passed in: none is bundled, and none but the hashes runs offline."""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Callable, Sequence

from branchwise.adapters.base import (
    ArticleInput, AuthenticationFailed, ClassificationAdapter, ClassificationContext, InvalidRequest, ModelError, NodeDecision, ProviderError, RateLimited,
    ReturnedModelMismatch, TimedOut, with_retries,
)
from branchwise.control.config import HostedModel, LocalModel, secret
from branchwise.functions.text import hashed
from branchwise.sources.ontology import Node

#: HTTP status codes of a hosted model's failures.
_FAILURES = {400: InvalidRequest, 404: InvalidRequest, 408: TimedOut, 413: InvalidRequest, 422: InvalidRequest, 429: RateLimited, 504: TimedOut}
Transport = Callable[[dict, str, float], tuple[int, dict]]


class HostedAdapter(ClassificationAdapter):
    """Typed decisions of a hosted model: one choice for exclusive nodes, else a yes-or-no decision for each child.

    transport(request, api_key, timeout_seconds) returns an HTTP status, a body
    {"model", "scores", "usage"} and, if it has any, headers; it may raise
    TimeoutError or OSError. One that hangs is left after timeout_seconds.
    """

    def __init__(self, model: HostedModel, transport: Transport, wait: Callable[[float], None] | None = None, concurrency: int | None = None):
        self.model, self.transport, self.wait = model, transport, {} if wait is None else {"wait": wait}
        self.concurrency = concurrency or model.concurrency

    def classify(self, article: ArticleInput, node: Node, context: ClassificationContext) -> NodeDecision:
        kind = "choice" if node.type == "single_choice" else "binary"
        request = {
            "model": self.model.model, "text": article.text, "question": node.question, "decision": kind,
            "options": [{"id": c.id, "text": t} for c, t in zip(context.children, context.labels(), strict=True)],
        }
        return with_retries(lambda: self._call(request, node), node.id, self.model.retries, deadline=self.model.timeout_seconds, **self.wait)

    def _call(self, request: dict, node: Node) -> NodeDecision:
        try:
            code, body, *headers = self.transport(request, secret(self.model.api_key_env), self.model.timeout_seconds)
        except TimeoutError as e:
            raise TimedOut("timeout") from e
        except OSError as e:
            raise ProviderError(type(e).__name__) from e
        if code in (401, 403):
            raise AuthenticationFailed(f"{self.model.provider}: HTTP {code}")
        if code != 200:
            raise _FAILURES.get(code, ProviderError if code >= 500 else InvalidRequest)(f"http_{code}", _retry_after(*headers))
        if (returned := body.get("model")) is not None and returned != self.model.model and not self.model.allow_returned_model_mismatch:
            raise ReturnedModelMismatch(f"asked for {self.model.model}, answered by {returned}")
        usage = body.get("usage") or {}
        return NodeDecision(
            node.id, normalized(body.get("scores")), returned_version=returned, input_tokens=usage.get("input_tokens"), output_tokens=usage.get("output_tokens"),
            provider_cost_usd=usage.get("cost_usd"), raw_response=json.dumps(body, sort_keys=True))


def _retry_after(headers: dict | None = None) -> float | None:
    """Seconds that a provider asks to wait for; a date is not taken as one."""
    value = next((v for k, v in (headers or {}).items() if k.lower() == "retry-after"), None)
    try:
        return max(0.0, float(value))
    except (TypeError, ValueError):
        return None


def normalized(scores) -> dict[str, float]:
    """{child: score}, also of [{"id", "score"}]."""
    if isinstance(scores, list):
        scores = {x["id"]: x["score"] for x in scores}
    if not isinstance(scores, dict):
        raise ModelError("no_scores")
    try:
        return {str(k): float(v) for k, v in scores.items() if v is not None}
    except (TypeError, ValueError) as e:
        raise ModelError("bad_score") from e


class _Local(ClassificationAdapter):
    def __init__(self, model: LocalModel, backend: Callable):
        self.model, self.backend = model, backend

    def classify(self, article, node, context):
        return self.classify_batch([(article, node, context)])[0]

    def classify_batch(self, items):
        out = []
        for k in range(0, len(items), self.model.batch_size):
            part = items[k : k + self.model.batch_size]
            try:
                scores = self.scores([(a.text, c.labels()) for a, _, c in part])
                out += [NodeDecision(n.id, dict(zip((x.id for x in c.children), map(float, s), strict=True)), returned_version=self.model.version) for (_, n, c), s in zip(part, scores, strict=True)]
            except (ArithmeticError, ValueError, TypeError) as e:
                out += [NodeDecision(n.id, status=ModelError.status, error_code=type(e).__name__) for _, n, _ in part]
        return out

    def scores(self, pairs: list[tuple[str, list[str]]]) -> list[Sequence[float]]:
        raise NotImplementedError


class LabelEncoderAdapter(_Local):
    """backend([(text, labels)]) gives each label's score."""

    def scores(self, pairs):
        return self.backend(pairs)


class NliAdapter(_Local):
    """backend([(premise, hypothesis)]) gives probabilities of entailment; labels are hypotheses."""

    def scores(self, pairs):
        flat = iter(self.backend([(text, h) for text, labels in pairs for h in labels]))
        return [[next(flat) for _ in labels] for _, labels in pairs]


class EmbeddingAdapter(_Local):
    """backend([text]) gives vectors; a score is the cosine of text and label, 0 where it is negative.

    Vectors of labels, of which an ontology has a bounded number, are kept.
    """

    def __init__(self, model: LocalModel, backend: Callable):
        super().__init__(model, backend)
        self.known: dict[str, Sequence[float]] = {}

    def scores(self, pairs):
        labels = {x for _, ls in pairs for x in ls}
        texts = list(dict.fromkeys([*(text for text, _ in pairs), *sorted(labels - self.known.keys())]))
        at = self.known | dict(zip(texts, self.backend(texts), strict=True))
        self.known |= {x: at[x] for x in labels}
        return [[cosine(at[text], at[x]) for x in labels] for text, labels in pairs]


def cosine(a: Sequence[float], b: Sequence[float]) -> float:
    size = math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))
    return min(1.0, max(0.0, sum(x * y for x, y in zip(a, b, strict=True)) / size)) if size else 0.0


def hashed_words(texts: list[str], width: int = 256) -> list[list[float]]:
    """Counts of hashed words: a backend of the embedding adapter that needs no model."""
    out = []
    for text in texts:
        row = [0.0] * width
        for w in re.findall(r"\w+", text.lower()):
            row[int.from_bytes(hashlib.blake2b(w.encode(), digest_size=4).digest()) % width] += 1.0
        out.append(row)
    return out


class HashAdapter(ClassificationAdapter):
    """A deterministic stand-in for a model: scores are hashes of article and child."""

    def __init__(self, model: LocalModel):
        self.model = model

    def classify(self, article, node, context):
        return NodeDecision(node.id, {c.id: hashed(article.article_id, c.id) for c in context.children}, returned_version=self.model.version)


def offline(name: str, model: HostedModel | LocalModel) -> ClassificationAdapter:
    """Adapters that run without a network or a model file; a caller registers others."""
    if isinstance(model, LocalModel) and model.adapter == "hash":
        return HashAdapter(model)
    if isinstance(model, LocalModel) and model.adapter == "embedding" and model.model == "hashed-words-256":
        return EmbeddingAdapter(model, hashed_words)
    raise LookupError(f"model {name!r}: no backend is installed for adapter {model.adapter!r}; pass one to run()")
