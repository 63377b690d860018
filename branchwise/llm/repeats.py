"""Removal of repeated 100-byte strings by column-wise construction of a collection's suffix order.

Equal texts are one. Each 100-byte window has an anchor, the leftmost least
hash of its ANCHOR-byte strings, so equal windows have equal anchors at equal
offsets; successive windows with one anchor are a fragment. Fragments are first
known by two 64-bit hashes, anchor and mark, and equal ones merge: all but the
first are removed. Only anchors with several fragments can hide further
repeats; the bytes of those fragments are dealt by anchor to bounded buckets.
In a bucket, fragments that agree with no other near their anchor are left
aside, and the sorted suffixes of the others grow by one symbol a suffix
and round: the next order is the stable sort of the last one by the symbols
before its suffixes (its BWT), read and written front to back. Neighbours that
agree in 100 bytes repeat, and all but the earliest are removed.

Anchors with more than HOT fragments are cut to blocks of up to STEP windows, known
by two hashes too; equal ones merge, and the first ones are cut to single windows,
which merging settles alone, so no bucket holds a hot anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from branchwise.llm.common import need, spent, table, text_key, written
from branchwise.llm.words import mix, powers

LENGTH, ANCHOR = 100, 24
HOT, BUCKET = 1000, 4000
PIECE, BATCH, BLOCK, STEP = 1 << 20, 1 << 16, 500, 8
_TABLE, _MARKS = (np.random.default_rng(k).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1) for k in (11, 13))


def _sliding_least(v: np.ndarray, w: int) -> np.ndarray:
    n, k = len(v) - w + 1, 1
    while 2 * k <= w:
        v, k = np.minimum(v[:-k], v[k:]), 2 * k
    return np.minimum(v[:n], v[w - k : w - k + n])


def _sums(part: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[part] * _powers(len(part))[0][: len(part)])])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(max(2 * PIECE, 1 << n.bit_length()))


def _spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * _powers(len(sums))[1][starts] + (ends - starts).astype(np.uint64)).view(np.int64)


def _equal_spans(sums: np.ndarray, n: int) -> np.ndarray:
    """_spans of all stretches of n bytes."""
    return mix((sums[n:] - sums[:-n]) * _powers(len(sums))[1][: len(sums) - n] + np.uint64(n)).view(np.int64)


def _parts(raws: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts, first windows and bytes of parts, about BATCH bytes at once; a part has PIECE windows at most."""
    who, base, parts, held = [], [], [], 0
    for k, raw in enumerate(raws):
        for low in range(0, max(0, len(raw) - LENGTH + 1), PIECE):
            who.append(k)
            base.append(low)
            parts.append(raw[low : low + PIECE + LENGTH - 1])
            held += len(parts[-1])
            if held >= BATCH:
                yield who, base, parts
                who, base, parts, held = [], [], [], 0
    if parts:
        yield who, base, parts


def fragments(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, anchor, mark, first window and number of windows of each fragment, by text and first window."""
    out, low = [], np.int64((1 << 21) - 1)
    for who, base, parts in _parts(raws):
        flat, lengths = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts])
        begin = np.cumsum(lengths) - lengths
        stop = begin + lengths - LENGTH + 1
        sums = _sums(flat, _TABLE)
        h = _equal_spans(sums, ANCHOR)
        # Sorted as unsigned: the first bit is turned over for the quicker signed minimum.
        least = _sliding_least(((h ^ np.int64(-(2**63))) & ~low) | np.arange(len(h)), LENGTH - ANCHOR + 1) & low
        edge = np.concatenate([[True], least[1:] != least[:-1]])
        edge[begin] = edge[stop[:-1]] = True  # windows from stop on reach into the next part
        first = np.flatnonzero(edge)
        ends, part = np.concatenate([first[1:], [len(least)]]), np.searchsorted(begin, first, "right") - 1
        whole = first < stop[part]
        first, ends, part = first[whole], ends[whole], part[whole]
        place = least[first]
        marks = _spans(_sums(flat, _MARKS), first, ends + LENGTH - 1)
        out.append((np.array(who)[part], h[place], marks, first - begin[part] + np.array(base)[part], ends - first))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 5


def _first_in_text(who: np.ndarray, anchor: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Whether each fragment is the first of its text that is equal to it."""
    order = np.lexsort((mark, anchor, who))
    out = np.zeros(len(order), bool)
    if len(order):
        w, a, m = who[order], anchor[order], mark[order]
        out[order] = np.concatenate([[True], (w[1:] != w[:-1]) | (a[1:] != a[:-1]) | (m[1:] != m[:-1])])
    return out


def suffix_order(strings: list[bytes], least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(string, start) of all suffixes of at least `least` symbols in order (shorter first; ties by string).

    Each round puts one more symbol before every suffix. One that ends with t symbols
    enters t rounds before the last, as its string's empty suffix, which stands first.
    """
    flat, lengths = np.frombuffer(b"".join(s + b"\xff" for s in strings), np.uint8), np.array([len(s) for s in strings], np.int64)
    ends = (np.cumsum(lengths + 1) - 1).astype(np.int32)
    at = ends[:0]
    for t in range(lengths.max(initial=-1), -1, -1):
        at = at - np.int32(1)
        at = at[np.argsort(flat[at], kind="stable")]
        if t >= least:
            at = np.concatenate([ends[lengths >= t], at])
    who = np.searchsorted(ends, at)
    return who, at - (ends - lengths)[who]


def repeated_windows(strings: list[bytes], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(string, start) of the windows that also start earlier; place (string) gives (text, start), compared in order."""
    who, start = suffix_order(strings, LENGTH)
    flat, lengths = b"".join(strings), np.array([len(s) for s in strings], np.int64)
    eight = np.ndarray(max(0, len(flat) - 7), np.uint64, flat, strides=(1,)).copy()
    at = (np.cumsum(lengths) - lengths)[who] + start
    same = np.ones(max(0, len(at) - 1), bool)
    for k in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        part = eight[at + k]
        same &= part[1:] == part[:-1]
    group = np.concatenate([[0], np.cumsum(~same)])[: len(at)]
    shared = np.flatnonzero(np.concatenate([[False], same])[: len(at)] | np.concatenate([same, [False]])[: len(at)])
    group, who, start = group[shared], who[shared], start[shared]
    order = np.lexsort((place[who, 1] + start, place[who, 0], group))
    gone = order[1:][group[order[1:]] == group[order[:-1]]]
    return who[gone], start[gone]


def _runs(who: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of successive windows: string, start << 8 | length."""
    order = np.lexsort((start, who))
    who, start = who[order], start[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(who) != 0) | (np.diff(start) != 1)])[: len(start)])
    return who[first], start[first] << 8 | np.diff(np.concatenate([first, [len(start)]]))


def _anchors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each text's fragments, equal ones once."""
    for frame in frames:
        for low in range(0, len(frame), 200):
            part = frame.iloc[low : low + 200]
            who, anchor, mark, start, n = fragments([(t or "").encode() for t in part["text"]])
            first = _first_in_text(who, anchor, mark)
            yield pd.DataFrame({"id": part["id"].to_numpy(np.int64)[who[first]], "anchor": anchor[first], "mark": mark[first], "at": (start << 8 | n)[first]})


def _anchor_places(flat: np.ndarray, lengths: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Where in flat, the joined fragments, each one's anchor begins; a window's least hash is the leftmost, so it is the first of its kind."""
    hits = np.flatnonzero(_equal_spans(_sums(flat, _TABLE), ANCHOR) == np.repeat(anchors, lengths)[: len(flat) - ANCHOR + 1])
    who, first = np.unique(np.searchsorted(np.cumsum(lengths), hits, "right"), return_index=True)
    assert len(who) == len(lengths)
    return hits[first]


def _blocks_of(flat: np.ndarray, n: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, ...]:
    """Blocks of up to STEP successive windows of fragments with n windows: fragment, first window, number, and two hashes.

    They end at fixed distances from the anchor, so equal stretches of two fragments have equal blocks.
    """
    lengths = n + LENGTH - 1
    begin, who = np.cumsum(lengths) - lengths, np.repeat(np.arange(len(n)), n)
    ramp = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
    ahead = (_anchor_places(flat, lengths, anchors) - begin)[who] - ramp
    first = np.flatnonzero((ramp == 0) | (ahead % STEP == STEP - 1))
    size, who, ramp = np.diff(np.concatenate([first, [len(who)]])), who[first], ramp[first]
    low = begin[who] + ramp
    return who, ramp, size, *(_spans(_sums(flat, t), low, low + size + LENGTH - 1) for t in (_TABLE, _MARKS))


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of fragments; of hot ones, of their blocks of windows, with two hashes of each.

    Both kinds have frames of their own: a missing hash among others would make them floats and round them.
    """
    for frame in frames:
        for low in range(0, len(frame), 200):
            part = frame.iloc[low : low + 200]
            raws, ids = [t.encode() for t in part["text"]], part["id"].to_numpy(np.int64)
            every = np.repeat(np.arange(len(part)), [len(a) for a in part["at"]])
            cols = [np.concatenate(part[c].tolist()) for c in ("at", "anchor", "hot")]
            for k in range(0, len(every), 2000):
                who, at, anchor, hot = every[k : k + 2000], *(c[k : k + 2000] for c in cols)
                start, n, hot = at >> 8, at & 255, hot.astype(bool)
                pieces = [raws[w][s : s + c + LENGTH - 1] for w, s, c in zip(who.tolist(), start.tolist(), n.tolist(), strict=True)]
                if not hot.all():
                    yield pd.DataFrame({"anchor": anchor[~hot], "mark": np.int64(0), "bytes": [pieces[x] for x in np.flatnonzero(~hot)], "id": ids[who[~hot]], "start": start[~hot], "hot": False})
                if hot.any():
                    pieces, who, start, n = [pieces[x] for x in np.flatnonzero(hot)], who[hot], start[hot], n[hot]
                    of, first, size, one, two = _blocks_of(np.frombuffer(b"".join(pieces), np.uint8), n, anchor[hot])
                    blocks = [pieces[x][f : f + c + LENGTH - 1] for x, f, c in zip(of.tolist(), first.tolist(), size.tolist(), strict=True)]
                    yield pd.DataFrame({"anchor": one, "mark": two, "bytes": blocks, "id": ids[who[of]], "start": start[of] + first, "hot": True})


def _windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Two hashes of each window of blocks."""
    for frame in frames:
        flat, n = np.frombuffer(b"".join(frame["bytes"]), np.uint8), frame["bytes"].map(len).to_numpy(np.int64) - LENGTH + 1
        ramp = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(np.cumsum(n + LENGTH - 1) - n - LENGTH + 1, n) + ramp
        one, two = (_spans(_sums(flat, t), at, at + LENGTH) for t in (_TABLE, _MARKS))
        yield pd.DataFrame({"anchor": one, "mark": two, "id": np.repeat(frame["id"].to_numpy(np.int64), n), "start": np.repeat(frame["start"].to_numpy(np.int64), n) + ramp})


def _may_repeat(strings: list[bytes], anchors: np.ndarray) -> np.ndarray:
    """Fragments that agree with another of their anchor in 81 bytes about it, at one of four places.

    A window holds 76 bytes beside its anchor: 0 to 19, to 38, to 57 or to 76 of
    them before it, and so all of one of the four places. Fragments that agree
    with no other one share no window.
    """
    flat, lengths = np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings])
    end = np.cumsum(lengths)
    begin, place, sums, out = end - lengths, _anchor_places(flat, lengths, anchors), _sums(flat, _MARKS), np.zeros(len(strings), bool)
    steps = np.linspace(0, LENGTH - ANCHOR, 5).astype(int)
    for least, most in zip(steps[:-1], steps[1:], strict=True):
        low, high = place - least, place + LENGTH - most
        whole = np.flatnonzero((low >= begin) & (high <= end))
        near = _spans(sums, low[whole], high[whole])
        _, group, count = np.unique(mix(near.view(np.uint64) ^ mix(anchors[whole].view(np.uint64))), return_inverse=True, return_counts=True)
        out[whole[count[group] > 1]] = True
    return out


def _blocks(anchors: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of whole anchors, about BLOCK at once, so that a round's arrays stay in the cache."""
    order = np.argsort(anchors, kind="stable")
    edges = np.flatnonzero(np.diff(anchors[order])) + 1
    low = 0
    while low < len(order):
        k = np.searchsorted(edges, low + BLOCK)
        high = edges[k] if k < len(edges) else len(order)
        yield order[low:high]
        low = high


def _settle(frame: pd.DataFrame) -> pd.DataFrame:
    strings, anchors, place = [bytes(b) for b in frame["bytes"]], frame["anchor"].to_numpy(np.int64), frame[["id", "start"]].to_numpy(np.int64)
    may, ids, ats = np.flatnonzero(_may_repeat(strings, anchors)), [], []
    for block in _blocks(anchors[may]):
        own = place[may[block]]
        who, start = repeated_windows([strings[k] for k in may[block]], own)
        who, at = _runs(who, start)
        ids.append(own[who, 0])
        ats.append(at + (own[who, 1] << 8))
    return pd.DataFrame({"id": np.concatenate([np.empty(0, np.int64), *ids]), "at": np.concatenate([np.empty(0, np.int64), *ats])})


def _remove(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["doc_id", "key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "span_starts", "span_ends"]
    for frame in frames:
        for begin in range(0, len(frame), 200):
            part, rows = frame.iloc[begin : begin + 200], []
            raws = [(t or "").encode() for t in part["text"]]
            who, anchor, mark, start, n = fragments(raws)
            later = ~_first_in_text(who, anchor, mark)
            at, bounds = (start << 8 | n)[later], np.searchsorted(who[later], np.arange(len(raws) + 1))
            for k, (doc_id, key, raw, places) in enumerate(zip(part["doc_id"], part["key"], raws, part["at"], strict=True)):
                gone = np.concatenate([at[bounds[k] : bounds[k + 1]], np.asarray([] if places is None else places, np.int64)])
                gone.sort()
                low, reach = gone >> 8, np.maximum.accumulate((gone >> 8) + (gone & 255)) + LENGTH - 1
                first = np.flatnonzero(np.concatenate([[True], low[1:] > reach[:-1]])[: len(low)])
                starts, ends = low[first], reach[np.concatenate([first[1:], [len(low)]]) - 1] if len(low) else low
                kept = b"".join(raw[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(raw)], strict=True))
                rows.append((doc_id, key, len(raw), len(raw) - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), starts, ends))
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})


def repeats(docs: DataFrame) -> DataFrame:
    """A row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, span_starts, span_ends (byte offsets).

    A null text is empty. Rows that repeat an id and a text have equal results;
    of equal texts the smallest id stays, a missing id being the largest. Rows
    with one id but different texts are one after the other by a hash of the
    text. Other columns are ignored.
    """
    largest = F.lit(2**63 - 1)
    doc_id = F.col("doc_id").cast("long")
    base = need(docs, "doc_id", "text").select(doc_id.alias("doc_id"), "text", F.coalesce(doc_id, largest).alias("id"), text_key(F.col("text")).alias("key"))
    rows = base.groupBy("key", "id").agg(F.count("*").alias("c"))
    firsts = written(rows.groupBy("key").agg(F.min("id").alias("first"), F.max("c").alias("most")), "firsts")
    again = not firsts.where("most > 1").isEmpty()
    mixed = not firsts.groupBy("first").count().where("count > 1").isEmpty()
    heads = base.join(firsts.select("key", F.col("first").alias("id")), ["key", "id"], "left_semi")
    alone = heads.dropDuplicates(["key"]) if again else heads
    if mixed:  # several texts with one id: places in the order of id and hash stand for ids
        alone = alone.sort("id", "key").withColumn("id", F.monotonically_increasing_id())
    alone = written(alone, "texts")

    anchored = alone.mapInPandas(_anchors, "id long, anchor long, mark long, at long")
    merged = written(anchored.groupBy("anchor", "mark").agg(F.min("id").alias("first"), F.min_by("at", "id").alias("at"), F.count("*").alias("c")), "merged")
    several = merged.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor", (F.col("n") > HOT).alias("hot"))
    listed = merged.join(several, "anchor").groupBy(F.col("first").alias("id")).agg(*[F.collect_list(c).alias(c) for c in ("at", "anchor", "hot")])
    listed = written(listed, "listed")
    cut = written(alone.select("id", "text").join(listed, "id").mapInPandas(_cut, "anchor long, mark long, bytes binary, id long, start long, hot boolean"), "fragments")
    spent(listed)

    later = anchored.join(merged.where("c > 1").select("anchor", "mark", "first"), ["anchor", "mark"]).where("id <> first").select("id", "at")
    block, place = cut.where("hot"), F.struct("id", "start")
    blocks = written(block.groupBy("anchor", "mark").agg(F.min(F.struct("id", "start", "bytes")).alias("early"), F.count("*").alias("c")), "blocks")
    twice = blocks.where("c > 1").select("anchor", "mark", F.struct("early.id", "early.start").alias("early"))
    whole = block.join(twice, ["anchor", "mark"]).where(place != F.col("early")).select("id", (F.shiftleft("start", 8) + F.octet_length("bytes") - (LENGTH - 1)).alias("at"))
    window = written(blocks.select("early.*").mapInPandas(_windows, "anchor long, mark long, id long, start long"), "windows")
    early = window.groupBy("anchor", "mark").agg(F.min(place).alias("early"), F.count("*").alias("c")).where("c > 1")
    single = whole.unionByName(window.join(early, ["anchor", "mark"]).where(place != F.col("early")).select("id", (F.shiftleft("start", 8) + 1).alias("at")))
    shared = cut.where("NOT hot")
    buckets = max(1, shared.count() // BUCKET)
    settled = shared.select("anchor", "bytes", "id", "start", F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket")).groupBy("bucket").applyInPandas(_settle, "id long, at long")
    settled = written(single.unionByName(settled), "settled")
    spent(cut, blocks, window)
    gone = written(later.unionByName(settled).groupBy("id").agg(F.collect_list("at").alias("at")), "gone")
    spent(merged, settled)

    out = "doc_id long, key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, span_starts array<long>, span_ends array<long>"
    judged = alone.join(gone, "id", "left").select("doc_id", "key", "text", "at").mapInPandas(_remove, out)
    if again:
        judged = heads.select("doc_id", "key").join(judged.drop("doc_id"), "key").select(judged.columns)
    # Copies lose all if they are long enough, else nothing.
    n, long_ = F.octet_length("text").cast("long"), F.octet_length("text") >= LENGTH
    copies = base.withColumn("text", F.coalesce("text", F.lit(""))).select(
        "doc_id", "id", "key", n.alias("n_bytes"), F.when(long_, n).otherwise(0).alias("n_removed"), long_.cast("long").alias("n_spans"),
        F.sha2(F.when(long_, "").otherwise(F.col("text")), 256).alias("kept_sha256"),
        F.when(long_, F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<long>")).alias("span_starts"), F.when(long_, F.array(n)).otherwise(F.array().cast("array<long>")).alias("span_ends"),
    )
    copies = copies.join(firsts.select("key", "first"), "key").where("id > first").select(judged.columns)
    return judged.unionByName(copies).drop("key")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
