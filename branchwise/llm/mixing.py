"""Soft-membership mixing: how often each document should be seen.

A softmax classifier of words and byte shares, fitted on a bounded
sample of labelled rows, gives each document posteriors p of the domains good,
low and toxic. Rates r >= 0 then minimize the squared distance between A r
(expected words of each domain; column a_d = words * posterior) and the
targets, by projected gradient from r = 1 in the metric that counts a word of
any document alike, in which a step moves r by p . w. Projection is lazy: the
steps so far sum to L, and r = max(floor, 1 - p . L), so no document carries a
state. Each step w is the gradient, the gap of the totals, scaled by the Gram
matrix of the documents that the floor leaves free, and shortened until it
descends. A step needs ten sums over the corpus and nothing else of it.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from branchwise.llm.common import frugal, need, spent, table, written
from branchwise.llm.words import word_hashes

DOMAINS = ("good", "low", "toxic")
#: Share of the good domain's present words that each domain should have.
TARGETS = {"good": 1.0, "low": 0.02, "toxic": 0.0}
#: The classifier sees at most this many labelled rows, those with the smallest hash of doc_id.
MAX_LABELLED = 3_000
EPOCHS, STEP = 200, 1 << 21
#: Most passes over the scores; a fit that needs more is reported as not converged.
STEPS = 60
#: Weight of the distance from rate 1 against that of the totals from the targets.
RIDGE = 1e-4
#: A word counts if it is this many standard errors too frequent in some class, in at least LEAST texts.
SCREEN, LEAST, MOST_WORDS = 4.0, 3, 50_000


def features(texts: list[str | None], vocabulary: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different words of each text (flat positions in the vocabulary, with bounds), shares of byte classes, numbers of words, vocabulary.

    Without a vocabulary (sorted word hashes) it is that of the texts.
    """
    hashes, bounds = word_hashes(texts)
    if vocabulary is None:
        vocabulary, at = np.unique(hashes, return_inverse=True)
        known = np.ones(len(at), bool)
    else:
        at = np.minimum(np.searchsorted(vocabulary, hashes), max(0, len(vocabulary) - 1))
        known = vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
    width = max(1, len(vocabulary))
    pairs = np.unique(np.repeat(np.arange(len(texts)), np.diff(bounds))[known] * width + at[known])
    dense = np.zeros((len(texts), 128))
    for k, t in enumerate(texts):
        raw = np.frombuffer((t or "").encode("utf-8", "surrogatepass"), np.uint8)
        dense[k] = np.bincount(raw & 127, minlength=128) / max(1, len(raw))
    return pairs % width, np.searchsorted(pairs // width, np.arange(len(texts) + 1)), np.sqrt(dense) * 4, np.diff(bounds), vocabulary


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    run = np.concatenate([np.zeros((1, values.shape[1])), np.cumsum(values, 0)])
    return run[bounds[1:]] - run[bounds[:-1]]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def predict(model: dict, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    words, bounds, dense, n, _ = features(texts, model["words"])
    return _softmax(_sums(model["w"][words], bounds) + dense @ model["v"] + model["b"]), n


def fit(texts: list[str | None], classes: np.ndarray, decay: float = 1e-4) -> dict:
    """Softmax regression by Adam over the whole sample; classes count as 0..2.

    Words are screened first, or else rare ones would be learnt by heart.
    """
    words, bounds, dense, _, vocabulary = features(texts)
    k, n = len(DOMAINS), len(texts)
    hot = np.eye(k)[classes]
    rows = np.repeat(np.arange(n), np.diff(bounds))
    seen = np.stack([np.bincount(words, hot[rows, c], len(vocabulary)) for c in range(k)], 1)
    expected = seen.sum(1, keepdims=True) * hot.mean(0)
    useful = (((seen - expected) / np.sqrt(expected * (1 - hot.mean(0)) + 1e-9) > SCREEN) & (seen >= LEAST)).any(1)
    if useful.sum() > MOST_WORDS:
        useful &= seen.sum(1) >= np.sort(seen.sum(1)[useful])[-MOST_WORDS]
    held = useful[words]
    words, rows = (np.cumsum(useful) - 1)[words[held]], rows[held]
    size = int(useful.sum())
    bounds = np.searchsorted(rows, np.arange(n + 1))
    scale = 1 / np.maximum(1, np.bincount(classes, minlength=k))[classes]
    scale = 0.5 / n + 0.5 * scale / k  # half the weight to each class alike, half to each row alike
    p = {"w": np.zeros((size, k)), "v": np.zeros((128, k)), "b": np.log(np.bincount(classes, minlength=k) + 1.0) - np.log(n + k)}
    m, s = {x: np.zeros_like(y) for x, y in p.items()}, {x: np.zeros_like(y) for x, y in p.items()}
    for t in range(1, EPOCHS + 1):
        gap = (_softmax(_sums(p["w"][words], bounds) + dense @ p["v"] + p["b"]) - hot) * scale[:, None]
        g = {"w": np.stack([np.bincount(words, gap[rows, c], size) for c in range(k)], 1) + decay / n * p["w"], "v": dense.T @ gap + decay * p["v"], "b": gap.sum(0)}
        for x in p:
            m[x], s[x] = 0.9 * m[x] + 0.1 * g[x], 0.99 * s[x] + 0.01 * g[x] ** 2
            p[x] = p[x] - 0.1 * m[x] / (1 - 0.9**t) / (np.sqrt(s[x] / (1 - 0.99**t)) + 1e-8)
    return {x: y.astype(np.float32) for x, y in p.items()} | {"words": vocabulary[useful]}


def classifier(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> dict:
    """Fitted on the labelled rows of docs with the smallest hashes of doc_id, `most` at the most.

    Toxic rows are toxic, others of quality 0 low, the rest good. Rows without
    an id or a label are not used; without any, all posteriors are equal.
    """
    named = need(labels, "doc_id", "quality", "toxic").na.drop().groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    sample = named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # At most `most` rows on either side; texts with one id are taken by their hash.
    found = need(docs, "doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text").limit(most).toPandas()
    if rows.empty:
        return {"words": np.empty(0, np.uint64), "w": np.zeros((0, 3), np.float32), "v": np.zeros((128, 3), np.float32), "b": np.zeros(3, np.float32)}
    classes = np.where(rows["toxic"] > 0, 2, np.where(rows["quality"] > 0, 0, 1))
    return fit(list(rows["text"]), classes)


def posteriors(docs: DataFrame, model: dict, *keep: str) -> DataFrame:
    """n_tokens (words) and the posterior p_<domain> of each row, with the columns keep."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MOST_WORDS
    kept = need(docs, *keep, "text") if "text" not in keep else need(docs, *keep)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            size = np.cumsum(frame["text"].str.len().fillna(0)) // STEP
            for _, part in frame.groupby(size.to_numpy(), sort=False):
                p, n = predict(shipped.value, list(part["text"]))
                out = part[list(keep)].assign(n_tokens=n)
                for k, name in enumerate(DOMAINS):
                    out[f"p_{name}"] = p[:, k].astype(float)
                yield out

    return kept.mapInPandas(frugal(score), ", ".join([*(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in keep), "n_tokens long", *(f"p_{d} double" for d in DOMAINS)]))


def _mass(name: str) -> Column:
    return F.col("n_tokens") * F.col(f"p_{name}")


def fit_rates(scored: DataFrame, targets: dict[str, float] = TARGETS, floor: Column | None = None, steps: int = STEPS, tolerance: float = 1e-4) -> tuple[Column, dict]:
    """The rate as an expression of scored's columns, and what was asked for and reached.

    targets are multiples of the first domain's expected words at rate 1; floor
    is the least rate of a row (0 where it is None). Where several rates are best,
    and against endless steps towards targets that cannot all be met, RIDGE of the
    squared distance from rate 1 is added. The fit has converged when the gradient
    is below `tolerance` of the largest target in each domain.
    """
    k, upper = len(DOMAINS), [(i, j) for i in range(len(DOMAINS)) for j in range(i, len(DOMAINS))]
    low = F.lit(0.0) if floor is None else floor

    def rate(at: np.ndarray) -> tuple[Column, Column]:
        moved = sum((F.col(f"p_{d}") * float(x) for d, x in zip(DOMAINS, at, strict=True)), F.lit(0.0))
        return F.greatest(low, 1 - moved), moved

    def sums(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Totals, Gram matrix of the free rows, and the function whose gradient is minus the totals."""
        r, moved = rate(at)
        free, edge = F.col("n_tokens") * (1 - moved >= low).cast("double"), 1 - low
        under = F.when(moved <= edge, moved - moved * moved / 2).otherwise(edge - edge * edge / 2 + low * (moved - edge))
        row = scored.agg(*[F.sum(r * _mass(d)) for d in DOMAINS], *[F.sum(free * F.col(f"p_{DOMAINS[i]}") * F.col(f"p_{DOMAINS[j]}")) for i, j in upper], F.sum(F.col("n_tokens") * under)).first()
        row = [x or 0.0 for x in row]
        gram = np.zeros((k, k))
        for (i, j), x in zip(upper, row[k:], strict=False):
            gram[i, j] = gram[j, i] = x
        return np.array(row[:k]), gram, -row[-1]

    first = scored.agg(*[F.sum(_mass(d)) for d in DOMAINS]).first()
    want = float(first[0] or 0.0) * np.array([targets[d] for d in DOMAINS])
    scale, at, taken = max(1.0, float(np.abs(want).max())), np.zeros(k), 0
    now, gram, value = sums(at)
    ridge = RIDGE * max(np.trace(gram), 1e-12) / k
    slope = now - want  # less the ridge's part: what a step descends along
    while not (converged := bool(np.abs(slope).max() <= tolerance * scale)) and taken < steps:
        move, share = np.linalg.solve(gram + ridge * np.eye(k), slope), 1.0
        while taken < steps:
            taken += 1
            there = at + share * move
            new, new_gram, new_value = sums(there)
            if new_value + there @ want + ridge / 2 * there @ there <= value + at @ want + ridge / 2 * at @ at - 1e-4 * share * (move @ slope) + 1e-12 * scale:
                at, now, gram, value = there, new, new_gram, new_value
                slope = now - want - ridge * at
                break
            share /= 4
    if not converged:
        warnings.warn(f"mixing: targets {want.tolist()} not fitted in {steps} steps, reached {now.tolist()}", stacklevel=2)
    named = lambda x: dict(zip(DOMAINS, x.tolist(), strict=True))
    return F.when(F.col("n_tokens") > 0, rate(at)[0]).otherwise(F.lit(1.0)), {"targets": named(want), "reached": named(now), "steps": taken, "converged": converged}


def copies(rate: Column, rounding: str, *by: Column) -> Column:
    """How often a row stays: "nearest" whole number, or "hash", which is right in expectation."""
    if rounding == "nearest":
        return F.floor(rate + 0.5).cast("int")
    share = F.pmod(F.xxhash64(F.lit("mix"), *by), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + share).cast("int")


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, rounding: str = "hash", report: dict | None = None) -> DataFrame:
    """A row a document: doc_id, n_tokens, p_good, p_low, p_toxic, rate, copies.

    Null and empty texts have no words: they bear on no target and keep rate 1.
    Repeated rows are rated alike. An empty table gives an empty one. Other
    columns are ignored. `report` receives targets, reached totals and steps.
    """
    scored = written(posteriors(docs, classifier(docs, labels), "doc_id"), "scored")
    rate, found = fit_rates(scored, targets)
    if report is not None:
        report.update(found)
    return scored.withColumn("rate", rate).withColumn("copies", copies(F.col("rate"), rounding, F.col("doc_id")))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, rounding: str = "hash", keep: str | None = "good", report: dict | None = None) -> DataFrame:
    """docs with each row as often as its rate says, right in expectation; the columns stay.

    A row whose likeliest domain is `keep` has a rate of 1 at least, which the
    fit knows, so it stays (None: no such rule). Null texts stay once, repeated
    rows are drawn alike, an empty table gives an empty one, and columns of docs
    may have any name. `report` receives targets, reached totals and steps.
    """
    ours = {"n_tokens", *[f"p_{d}" for d in DOMAINS]}
    names = [f"_bw_{k}" if c in ours else c for k, c in enumerate(docs.columns)]
    model, named = classifier(docs, labels), docs.toDF(*names)
    sums = written(posteriors(named, model), "scored")  # without the texts, which are scored again when they are drawn
    floor = None
    if keep:
        floor = F.when(F.col(f"p_{keep}") >= F.greatest(*[F.col(f"p_{d}") for d in DOMAINS]), 1.0).otherwise(0.0)
    rate, found = fit_rates(sums, targets, floor)
    spent(sums)
    if report is not None:
        report.update(found)
    times = copies(rate, rounding, F.col("doc_id"), F.col("text"))
    drawn = posteriors(named, model, *names).select(*names, times.alias("_bw_times")).where("_bw_times > 0").withColumn("_bw_times", F.explode(F.array_repeat(F.lit(1), F.col("_bw_times"))))
    return drawn.select(*names).toDF(*docs.columns)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
