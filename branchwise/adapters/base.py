"""The contract of classifiers: a text and a node in, a score for each child out."""

from __future__ import annotations

import functools
import queue
import random
import threading
import time
from abc import ABC, abstractmethod
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from branchwise.sources.ontology import Node
from branchwise.sources.templates import Template


@dataclass(frozen=True)
class ArticleInput:
    article_id: str
    text: str


@dataclass(frozen=True)
class ClassificationContext:
    """What every adapter is told alike: the children in canonical order, the template, how much of a node labels hold."""

    children: tuple[Node, ...]
    template: Template
    label_level: int

    @functools.cached_property
    def _labels(self) -> tuple[str, ...]:
        return tuple(self.template.render(c, self.label_level) for c in self.children)

    def labels(self) -> list[str]:
        return list(self._labels)


@dataclass(frozen=True)
class NodeDecision:
    node_id: str
    scores: dict[str, float] = field(default_factory=dict)
    status: str = "SUCCESS"
    error_code: str | None = None
    returned_version: str | None = None
    latency_ms: float | None = None
    input_tokens: int | None = None
    output_tokens: int | None = None
    provider_cost_usd: float | None = None
    retry_count: int = 0
    raw_response: str | None = None


class CallFailed(Exception):
    """A call that gave no scores: a status of its own, never a negative."""

    status, retryable = "PROVIDER_ERROR", True

    def __init__(self, code: str = "", retry_after: float | None = None):
        super().__init__(code)
        self.code, self.retry_after = code or self.status.lower(), retry_after


class TimedOut(CallFailed):
    status = "TIMEOUT"


class RateLimited(CallFailed):
    status = "RATE_LIMITED"


class ProviderError(CallFailed):
    status = "PROVIDER_ERROR"


class InvalidRequest(CallFailed):
    status, retryable = "INVALID_REQUEST", False


class ModelError(CallFailed):
    status, retryable = "MODEL_ERROR", False


class AuthenticationFailed(RuntimeError):
    """Ends the run: no other call could succeed."""


class ReturnedModelMismatch(RuntimeError):
    """Ends the run: another model than the pinned one has answered."""


class ClassificationAdapter(ABC):
    #: Logical calls that run at once in one worker.
    concurrency = 1
    #: Python packages whose versions the manifest names.
    libraries: tuple[str, ...] = ()

    @abstractmethod
    def classify(self, article: ArticleInput, node: Node, context: ClassificationContext) -> NodeDecision: ...

    def classify_batch(self, items: list[tuple[ArticleInput, Node, ClassificationContext]]) -> list[NodeDecision]:
        """A decision for each item, in order; batching never merges nodes."""
        if self.concurrency <= 1 or len(items) <= 1:
            return [self.classify(*x) for x in items]
        with ThreadPoolExecutor(self.concurrency) as pool:
            return list(pool.map(lambda x: self.classify(*x), items))


def within(seconds: float, call: Callable[[], NodeDecision]) -> NodeDecision:
    """The call's result; TimedOut if it has not come after so many seconds, whatever the call is waiting for.

    The call goes on in a thread that nobody waits for, as Python cannot end it.
    """
    answer: queue.SimpleQueue = queue.SimpleQueue()

    def run() -> None:
        try:
            answer.put((call(), None))
        except BaseException as e:  # handed to the caller
            answer.put((None, e))

    threading.Thread(target=run, daemon=True).start()
    try:
        done, error = answer.get(timeout=seconds)
    except queue.Empty:
        raise TimedOut("deadline") from None
    if error is not None:
        raise error
    return done


#: Seconds of the longest wait that a provider's Retry-After is believed for, and of the longest of our own.
LONGEST_ASKED, LONGEST_WAIT = 120.0, 30.0


def with_retries(call: Callable[[], NodeDecision], node_id: str, retries: int, wait: Callable[[float], None] = time.sleep, deadline: float | None = None, jitter: Callable[[], float] = random.random) -> NodeDecision:
    """The call's decision, or its last failure's status; only retryable failures are tried again.

    Waits double from half a second, each up to half as long again by `jitter`,
    and last at least as long as the provider asks. deadline: seconds of one attempt.
    """
    began = time.monotonic()
    for attempt in range(retries + 1):
        try:
            done = call() if deadline is None else within(deadline, call)
            return replace(done, retry_count=attempt, latency_ms=(time.monotonic() - began) * 1000 if done.latency_ms is None else done.latency_ms)
        except CallFailed as e:
            if not e.retryable or attempt == retries:
                return NodeDecision(node_id, status=e.status, error_code=e.code, retry_count=attempt, latency_ms=(time.monotonic() - began) * 1000)
            wait(max(min(LONGEST_WAIT, 0.5 * 2**attempt) * (1 + jitter() / 2), min(LONGEST_ASKED, e.retry_after or 0.0)))
    raise AssertionError("unreachable")
