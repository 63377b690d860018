"""Benchmark decontamination by spaced seeds.

An item is cut into blocks of three words. As many substitutions as the
threshold allows spoil at most one block each, and the blocks that stay whole
are so many that two of them lie near each other: a seed is such a pair, a mask
over the words between. Short items have blocks of two words or one, and more
to a seed. No place of the substitutions escapes all seeds. An item of more than
LONGEST words is cut into parts with seeds of their own: where the item is held,
one part is.

A seed that more than COMMON items share, as those of one template do, is no key
to join on: it is extended by one more word of the item, at a place of its own.
Of lost + 1 words outside the seed the substitutions leave one, so an item takes
that many extensions of it, those that the fewest items share. Texts that hold
the template's words alone meet none of its items.

Masked hashes of every window of a text first meet a Bloom filter of the
benchmark's (sized by it, of at most 32 MB, so it may go to every worker), then the hashes
themselves in an equi-join. A hit fixes how text and item lie against each
other; on that diagonal the item is compared word by word, and counts as leaked
where the share of equal words reaches the threshold.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from branchwise.llm.bloom import bloom, may_hold
from branchwise.llm.common import frugal, need, scratch, table, text_key, written
from branchwise.llm.words import mix, word_hashes

#: Words of a block and blocks of a seed; the first that an item's whole blocks suffice for, with at most MASKS masks.
SHAPES = ((3, 2), (2, 3), (1, 6), (1, 5), (1, 4), (1, 3), (1, 2), (1, 1))
MASKS = 16
#: MIN_WORDS: of the items for which a document is removed; every item is reported.
THRESHOLD, MIN_WORDS = 0.8, 5
STEP = 1 << 21
#: Words of an item, or part of one, with seeds of its own; items beyond which a seed is extended.
LONGEST, COMMON = 64, 8
_ODD = np.uint64(0x100000001B3)


def masked(h: np.ndarray, masks: list[str]) -> Iterator[np.ndarray]:
    """For each mask (1: the word counts) the hash of each window of word hashes h under it."""
    runs = [h]
    for mask in masks:
        n = max(0, len(h) - len(mask) + 1)
        out = np.full(n, int(mask, 2), np.uint64)
        for bit, places in itertools.groupby(range(len(mask)), mask.__getitem__):
            if bit == "1":
                first, *more = places
                while len(runs) <= len(more):  # runs[k]: of k + 1 words
                    runs.append(mix(runs[-1][: max(0, len(h) - len(runs))] * _ODD + h[len(runs) :]))
                out = mix(out * _ODD + runs[len(more)][first : first + n])
        yield out


def allowed(n: int, threshold: float) -> int:
    """How many of n words may be substituted."""
    return n - math.ceil(threshold * n - 1e-9)


def parts_of(n: int) -> list[tuple[int, int]]:
    """An item of n words, or the parts it is cut into, of half LONGEST words or more each."""
    k = max(1, n // (LONGEST // 2)) if n > LONGEST else 1
    return [(n * i // k, n * (i + 1) // k) for i in range(k)]


def extended(seed: np.ndarray, away: np.ndarray | int, word: np.ndarray) -> np.ndarray:
    """Seeds with one more word, so many words after the seed's first."""
    place = mix(np.atleast_1d(np.asarray(away, np.int64)).view(np.uint64))
    return mix(mix(seed ^ place) * _ODD + word)


@functools.lru_cache(4096)
def masks_for(n: int, threshold: float) -> tuple[tuple[str, ...], int, int]:
    """The masks of an item of n words, and size and number of its blocks; a mask begins where a block does.

    Of b blocks at least u stay whole, which make u - 1 gaps of b - 1 blocks in
    all. Some c successive ones so lie within (b - 1) // ((u - 1) // (c - 1)).
    """
    lost = allowed(n, threshold)
    for size, c in SHAPES:
        b = n // size
        u = b - lost
        if u >= c:
            reach = (b - 1) // ((u - 1) // (c - 1)) if c > 1 else 0
            if math.comb(reach, c - 1) <= MASKS:
                places = [(0, *p) for p in itertools.combinations(range(1, reach + 1), c - 1)]
                return tuple("".join(("1" if k in p else "0") * size for k in range(p[-1] + 1)) for p in places), size, b
    raise ValueError("the threshold must be above 0")


def _steps(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    size = np.cumsum(frame["text"].str.len().fillna(0)) // STEP
    for _, part in frame.groupby(size.to_numpy(), sort=False):
        yield part


def _items(frames: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        hashes, bounds = word_hashes(list(frame["text"]))
        words = [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        item = [hashlib.blake2b(w.tobytes(), digest_size=16).digest() for w in words]
        out = pd.DataFrame({"text_key": frame["text_key"].to_numpy(), "item": item, "words": [w.view(np.int64) for w in words], "n_words": [len(w) for w in words]})
        yield out[out["n_words"] >= max(1, least)]


def _seeds(frames: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for item, words in zip(frame["item"], frame["words"], strict=True):
            h = np.asarray(words, np.int64).view(np.uint64)
            for low, high in parts_of(len(h)):
                masks, size, b = masks_for(high - low, threshold)
                for mask, s in zip(masks, masked(h[low:high], list(masks)), strict=True):
                    at = np.arange(0, size * (b - len(mask) // size) + 1, size)
                    yield pd.DataFrame({"seed": s[at].view(np.int64), "item": item, "item_at": low + at, "mask": mask, "low": low, "high": high})


def _extensions(frames: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """For each seed of an item all its extensions within the part, and how many are needed; the seed itself where words are too few."""
    for frame in frames:
        for seed, item, at, mask, low, high, words in zip(*(frame[c] for c in ("seed", "item", "item_at", "mask", "low", "high", "words")), strict=True):
            lost = allowed(high - low, threshold)
            taken = at + np.flatnonzero(np.frombuffer(mask.encode(), np.uint8) == ord("1"))
            free = np.setdiff1d(np.arange(low, high), taken)
            base = np.array([seed], np.int64).view(np.uint64)
            if len(free) > lost:
                longer = extended(base, free - at, np.asarray(words, np.int64).view(np.uint64)[free])
                yield pd.DataFrame({"base": seed, "item": item, "item_at": at, "away": free - at, "seed": longer.view(np.int64), "needed": lost + 1})
            else:
                yield pd.DataFrame({"base": [seed], "item": [item], "item_at": [at], "away": [0], "seed": [seed], "needed": [1]})


def _keys(items: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, list[int]]:
    """Seeds to join on (seed, item, item_at), the seeds among which those were extended, and at which places."""
    every = written(items.mapInPandas(lambda frames: _seeds(frames, threshold), "seed long, item binary, item_at int, mask string, low int, high int"), "seeds")
    common = written(every.select("seed", "item").distinct().groupBy("seed").count().where(F.col("count") > COMMON).select("seed"), "common")
    if common.isEmpty():
        return every.select("seed", "item", "item_at"), common, []
    shared = every.join(common, "seed", "left_semi").join(items.select("item", "words"), "item")
    longer = written(shared.mapInPandas(lambda frames: _extensions(frames, threshold), "base long, item binary, item_at int, away int, seed long, needed int"), "extensions")
    spread = longer.select("seed", "item").distinct().groupBy("seed").agg(F.count("*").alias("spread"))
    order = Window.partitionBy("item", "base", "item_at").orderBy("spread", "away")
    chosen = longer.join(spread, "seed").withColumn("rank", F.row_number().over(order)).where("rank <= needed").select("seed", "item", "item_at", "away")
    kept = every.join(common, "seed", "left_anti").select("seed", "item", "item_at", F.lit(None).cast("int").alias("away"))
    keys = written(kept.unionByName(chosen), "keys")
    places = sorted(r[0] for r in keys.select("away").where("away IS NOT NULL").distinct().collect())  # within a part: fewer than 2 * LONGEST
    return keys.select("seed", "item", "item_at"), common, places


def candidates(docs: DataFrame, benchmark: DataFrame, threshold: float, least: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Texts and items that share a seed (key, part, item, start); the texts' stretches, the items, and the items' ids."""
    named = need(benchmark, "item_id", "text").select(F.col("item_id").cast("long").alias("item_id"), "text", text_key(F.col("text")).alias("text_key")).where("text IS NOT NULL")
    every = written(named.select("text_key", "text").dropDuplicates(["text_key"]).mapInPandas(lambda frames: _items(frames, least), "text_key binary, item binary, words array<long>, n_words int"), "texts")
    items = written(every.select("item", "words", "n_words").dropDuplicates(["item"]), "items")
    ids = named.select("item_id", "text_key").join(every.select("text_key", "item"), "text_key").select("item_id", "item").distinct()
    seeds, common, places = _keys(items, threshold)
    lengths = [r[0] for r in items.select("n_words").distinct().collect()]
    masks, widest = sorted({m for n in lengths for a, b in parts_of(n) for m in masks_for(b - a, threshold)[0]}), max(lengths, default=0)

    context = docs.sparkSession.sparkContext
    shipped, extend = context.broadcast(bloom(seeds, "seed")), context.broadcast(bloom(common, "seed") if places else b"")

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in _steps(frame) if masks else ():
                hashes, bounds = word_hashes(list(part["text"]))
                found = []
                for mask, s in zip(masks, masked(hashes, masks), strict=True):
                    def inside(at: np.ndarray, mask=mask) -> tuple[np.ndarray, np.ndarray]:
                        doc = np.searchsorted(bounds, at, "right") - 1
                        whole = at + len(mask) <= bounds[doc + 1]
                        return at[whole], doc[whole]

                    at, doc = inside(np.flatnonzero(may_hold(shipped.value, s)))
                    found.append(pd.DataFrame({"doc": doc, "at": at, "seed": s[at].view(np.int64)}))
                    if places:
                        at, doc = inside(np.flatnonzero(may_hold(extend.value, s)))
                        for away in places if len(at) else ():
                            there = (at + away >= bounds[doc]) & (at + away < bounds[doc + 1])
                            longer = extended(s[at[there]], away, hashes[at[there] + away])
                            may = may_hold(shipped.value, longer)
                            found.append(pd.DataFrame({"doc": doc[there][may], "at": at[there][may], "seed": longer[may].view(np.int64)}))
                hits = pd.concat(found).sort_values(["doc", "at"])
                rows = []
                for doc, group in hits.groupby("doc", sort=False):
                    # Around hits, as many words as the longest item may reach; overlapping stretches are one.
                    a, b = bounds[doc], bounds[doc + 1]
                    at = group["at"].to_numpy()
                    cut = np.concatenate([[0], np.flatnonzero(np.diff(at) > 2 * widest) + 1, [len(at)]])
                    for k, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
                        low, high = max(a, at[i] - widest), min(b, at[j - 1] + widest)
                        rows.append((part["key"].iloc[doc], k, low - a, hashes[low:high].view(np.int64), (at[i:j] - a).astype(np.int64), group["seed"].to_numpy()[i:j]))
                if rows:
                    yield pd.DataFrame(rows, columns=["key", "part", "first", "words", "at", "seeds"])

    keyed = need(docs, "text").select(text_key(F.col("text")).alias("key"), "text").where("text IS NOT NULL")
    stretches = written(keyed.mapInPandas(frugal(probe), "key binary, part int, first long, words array<long>, at array<long>, seeds array<long>"), "stretches")
    hits = stretches.select("key", "part", F.explode(F.arrays_zip("at", "seeds")).alias("h")).select("key", "part", F.col("h.at").alias("at"), F.col("h.seeds").alias("seed"))
    lain = hits.join(seeds, "seed").select("key", "part", "item", (F.col("at") - F.col("item_at")).alias("start")).distinct()
    return lain, stretches, items, ids


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: int = 1) -> DataFrame:
    """(key, item_id, n_words, n_matched, start_word): each text, by its text_key, and item of `least` words or more that it holds.

    An item is held if on one diagonal at least `threshold` of its words equal
    the text's; start_word is where it begins (negative: before the text).
    Items of fewer than five words so match exactly at 0.8. Null texts, and texts
    and items without words, never match. Equal texts and equal items are
    compared once each, and all are reported. Items with one id are one result,
    the best; each item without an id is one of its own. An empty benchmark or
    table gives no row. Other columns are ignored.
    """
    lain, stretches, items, ids = candidates(docs, benchmark, threshold, least)

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            matched = []
            for words, item, start, first in zip(frame["words"], frame["item_words"], frame["start"], frame["first"], strict=True):
                w, x, off = np.asarray(words), np.asarray(item), start - first
                a, b = max(0, -off), min(len(x), len(w) - off)
                matched.append(int((x[a:b] == w[a + off : b + off]).sum()) if b > a else 0)
            yield frame[["key", "item", "n_words"]].assign(n_matched=matched, start_word=frame["start"])

    held = lain.join(stretches.select("key", "part", "first", "words").dropDuplicates(["key", "part"]), ["key", "part"]).join(items.select("item", F.col("words").alias("item_words"), "n_words"), "item")
    judged = held.mapInPandas(frugal(compare), "key binary, item binary, n_words long, n_matched long, start_word long").where(F.col("n_matched") >= threshold * F.col("n_words"))
    nameless = F.when(F.col("item_id").isNull(), F.col("item")).alias("nameless")
    best = judged.join(ids, "item").groupBy("key", "item_id", nameless).agg(F.max(F.struct("n_matched", -F.col("start_word"), "n_words")).alias("b"))
    return best.select("key", "item_id", F.col("b.n_words").alias("n_words"), F.col("b.n_matched").alias("n_matched"), (-F.col("b.col2")).alias("start_word"))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: int = 1) -> DataFrame:
    """A row for each row of docs and item that it holds: doc_id (null or repeated: as it is), item_id, n_words, n_matched, start_word."""
    with scratch() as keep:
        found = keep(written(leaks(docs, benchmark, threshold, least), "leaks"))
    return need(docs, "doc_id", "text").select("doc_id", text_key(F.col("text")).alias("key")).join(found, "key").drop("key")


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: int = MIN_WORDS) -> DataFrame:
    """docs without the rows whose text holds a benchmark item of `least` words or more; rows with a null text stay.

    By default a document does not go for an item of one to four words, which `contaminated` reports: clean ones hold such words, too.
    """
    with scratch() as keep:
        found = keep(written(leaks(docs, benchmark, threshold, least).select(F.col("key").alias("_bw_leak")).distinct(), "leaks"))
    return docs.join(found, text_key(F.col("text")) == F.col("_bw_leak"), "left_anti")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
