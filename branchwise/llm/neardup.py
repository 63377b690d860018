"""Near-duplicate classes by ProbMinHash, banding and exact verification.

Texts are weighted sets of five-word shingles (weight: occurrences). Each
shingle has a Poisson process with that rate; each arrival draws one of the
registers, which keeps the earliest. A shingle ends when its next arrival is
later than every register. Equal registers have the probability Jaccard
similarity J_P as their chance.

Equal texts are one node. Bands of registers make buckets; a bucket's members
are verified against its leader, never all against all. Those too far from the
leader, and not of its class by other links, form a bucket of their own with
next leaders, a few at a time. 1 - J_P is a metric, so a member of that rest
can only match one that is linked to the leader if their distances to it differ
by at most the limit: just such pairs of different classes are verified too.

Crowded band buckets, where about every text shares a band with every other,
are split first, by a bound that loses no link. If S are the shingles that x and
y share, and P and Q the shares of their weight that lie in S, each term of J_P
is at most 1 / (1/p + (1 - Q)/q), which is concave, so J_P <= PQ / (P + Q - PQ).
Order all shingles by how many texts hold them, the rarest first: P is at most
what x holds from the first shared shingle on, and at most (distinct shingles
that y holds from there on + repeats in x) / size of x; Q likewise. So x needs
only be met at the shingles before which it has lost at most 1 - threshold of
its weight, and only by partners for which the bound leaves room.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from branchwise.llm.bloom import bloom, may_hold
from branchwise.llm.common import frugal, need, scratch, spent, table, text_key, written
from branchwise.llm.words import mix, shingles, word_hashes

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 25, 5
#: Band buckets of more members are split by shared shingles.
CROWD = 8
#: Leaders of a bucket in the second round; four times as many in each further one.
LEADERS = 8
#: Keys of 16 bytes that may be broadcast.
MOST_SENT = 500_000
#: Bytes of text that one step of a Python worker takes.
STEP = 1 << 21
_WORDED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def _uniform(h: np.ndarray, salt: np.ndarray) -> np.ndarray:
    return ((mix(h + mix(salt.astype(np.uint64))) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(texts: list[str | None], m: int = BANDS * ROWS) -> np.ndarray:
    """ProbMinHash registers (texts x m) as shingle hashes; 0 for texts without words."""
    weighted = [np.unique(s, return_counts=True) for s in shingles(*word_hashes(texts), WORDS)]
    doc = np.repeat(np.arange(len(texts)), [len(h) for h, _ in weighted])
    h = np.concatenate([np.empty(0, np.uint64), *[h for h, _ in weighted]])
    w = np.concatenate([np.empty(0), *[c for _, c in weighted]])
    first, kept = np.full(len(texts) * m, np.inf), np.zeros(len(texts) * m, np.uint64)
    at, turn = np.zeros(len(h)), 0
    while len(h):
        at = at - np.log(_uniform(h, np.full(len(h), 2 * turn))) / w
        limit = first.reshape(-1, m).max(1)[doc] if turn else None
        if turn:
            alive = at <= limit
            doc, h, w, at = doc[alive], h[alive], w[alive], at[alive]
        slot = doc * m + (mix(h ^ mix(np.full(len(h), 2 * turn + 1, np.uint64))) % np.uint64(m)).astype(np.int64)
        np.minimum.at(first, slot, at)
        won = first[slot] == at
        kept[slot[won]] = h[won]
        turn += 1
    return kept.reshape(-1, m)


def band_hashes(registers: np.ndarray) -> np.ndarray:
    out = np.zeros((len(registers), BANDS), np.uint64)
    for k in range(ROWS):
        out = mix(out * np.uint64(31) + registers.reshape(-1, BANDS, ROWS)[:, :, k] + np.arange(BANDS, dtype=np.uint64))
    return out.view(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact J_P of two weighted sets (sorted elements, weights)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    every = np.union1d(a[0], b[0])
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a[0])], y[np.searchsorted(every, b[0])] = a[1] / a[1].sum(), b[1] / b[1].sum()
    with np.errstate(divide="ignore"):
        ratio = np.where(y > 0, x / np.where(y > 0, y, 1), np.inf)
    order = np.argsort(-ratio, kind="stable")
    ratio, x, y = ratio[order], x[order], y[order]
    last = np.searchsorted(-ratio, -ratio, "right")  # past the elements with at least this ratio
    above, below = np.concatenate([[0], np.cumsum(x)])[last], y.sum() - np.concatenate([[0], np.cumsum(y)])[last]
    both = (x > 0) & (y > 0)
    return float(np.sum(1 / (above[both] / x[both] + below[both] / y[both])))


def _steps(frame: pd.DataFrame, *columns: str) -> Iterator[pd.DataFrame]:
    size = np.cumsum(sum(frame[c].str.len().fillna(0) for c in columns)) // STEP
    for _, part in frame.groupby(size.to_numpy(), sort=False):
        yield part


def _sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for part in _steps(frame, "text"):
            yield pd.DataFrame({"key": part["key"].to_numpy(), "bands": list(band_hashes(signatures(list(part["text"]))))})


def _shared_bands(signed: DataFrame, sizes: DataFrame) -> DataFrame:
    """(bucket, key, size) of the bands that several texts have; a Bloom filter of them keeps most other bands from the shuffle."""
    shipped = signed.sparkSession.sparkContext.broadcast(bloom(sizes, "bucket"))

    def sift(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                bands, of = np.concatenate(list(frame["bands"])), np.repeat(np.arange(len(frame)), frame["bands"].str.len())
                stays = may_hold(shipped.value, bands.view(np.uint64))
                yield pd.DataFrame({"bucket": bands[stays], "key": frame["key"].to_numpy()[of[stays]]})

    return signed.mapInPandas(frugal(sift), "bucket long, key binary").join(sizes, "bucket")


def _spectra(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distinct shingles of each text (s) with their numbers (c), the size n and the repeats e = n - distinct."""
    for frame in frames:
        for part in _steps(frame, "text"):
            sets = [np.unique(x, return_counts=True) for x in shingles(*word_hashes(list(part["text"])), WORDS)]
            n = np.array([c.sum() for _, c in sets])
            yield pd.DataFrame({"key": part["key"].to_numpy(), "n": n, "e": n - np.array([len(c) for _, c in sets]), "s": [h.view(np.int64) for h, _ in sets], "c": [c for _, c in sets]})


def _verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for part in _steps(frame, "text_a", "text_b"):
            texts = list(dict.fromkeys([*part["text_a"], *part["text_b"]]))
            sets = {t: np.unique(s, return_counts=True) for t, s in zip(texts, shingles(*word_hashes(texts), WORDS), strict=True)}
            similar = [probability_jaccard(sets[a], sets[b]) for a, b in zip(part["text_a"], part["text_b"], strict=True)]
            yield pd.DataFrame({"a": part["a"].to_numpy(), "b": part["b"].to_numpy(), "similarity": similar})


def components(links: DataFrame) -> DataFrame:
    """(key, root): the smallest key of each component of links (a, b), by alternating stars."""
    orient = lambda e: e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, before = written(orient(links), "edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = orient(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges, old = written(orient(small), "edges"), edges
        spent(old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("key"), F.col("v").alias("root"))
        before = now


#: What the bound knows of a text at a bucket: share of its weight from there on, distinct shingles from there on, size, repeats.
AT = ["u", "k", "n", "e"]


def _possible(a: Callable[[str], Column], b: Callable[[str], Column], threshold: float) -> Column:
    """Whether the bound leaves room for a link of a and b, if they share nothing before this bucket's shingle."""
    p = F.least(a("u"), (b("k") + a("e")) / a("n"))
    q = F.least(b("u"), (a("k") + b("e")) / b("n"))
    return 1 / p + 1 / q <= 1 + 1 / threshold + 1e-6


def _split(texts: DataFrame, threshold: float) -> DataFrame:
    """(bucket, key, u, k, n, e) of crowded texts at the shingles that a link needs."""
    spectra = written(texts.mapInPandas(frugal(_spectra), "key binary, n long, e long, s array<long>, c array<long>"), "spectra")
    flat = spectra.select("key", "n", "e", F.explode(F.arrays_zip("s", "c")).alias("x")).select("key", "n", "e", "x.s", "x.c")
    shared = written(flat.groupBy("s").agg(F.count("*").alias("f")).where("f > 1"), "shared")
    order = Window.partitionBy("key").orderBy(F.desc("f"), "s")
    held = flat.join(shared, "s").withColumns({"u": F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, 0)) / F.col("n"), "k": F.row_number().over(order).cast("long")})
    met = written(held.where(F.col("u") >= threshold - 1e-6).select(F.xxhash64(F.lit("shingle"), "s").alias("bucket"), "key", *AT), "met")
    best = met.groupBy("bucket").agg(F.max("u").alias("bu"), F.max("k").alias("bk"), F.min("n").alias("bn"), F.max("e").alias("be"), F.count("*").alias("members")).where("members > 1")
    spent(spectra, shared)
    room = met.join(written(best, "best"), "bucket").where(_possible(F.col, lambda c: F.col(f"b{c}"), threshold))
    return room.select("bucket", "key", *AT)


def _led(buckets: DataFrame, threshold: float, leaders: int = 1) -> DataFrame:
    """(bucket, key, u, k, n, e, leader, open): all but the leader itself against each leader.

    Those that hold most lead; of equals, each bucket has its own order. open:
    the bound leaves room for a link of key and leader.
    """
    rank = F.struct((-F.col("u")).alias("d"), F.xxhash64("key", "bucket").alias("t"), "key", "k", "n", "e")
    if leaders == 1:
        heads = buckets.groupBy("bucket").agg(F.min(rank).alias("h"), F.count("*").alias("members")).where("members > 1")
    else:
        place = F.row_number().over(Window.partitionBy("bucket").orderBy(rank))
        heads = buckets.withColumns({"place": place, "h": rank}).where(F.col("place") <= leaders)
    heads = heads.select("bucket", F.col("h.key").alias("leader"), (-F.col("h.d")).alias("lu"), *[F.col(f"h.{c}").alias(f"l{c}") for c in AT[1:]])
    led = buckets.join(heads, "bucket").where("key <> leader").withColumn("open", _possible(F.col, lambda c: F.col(f"l{c}"), threshold))
    return led.select("bucket", "key", *AT, "leader", "open")


def _pairs(members: DataFrame) -> DataFrame:
    return members.withColumn("a", F.least("leader", "key")).withColumn("b", F.greatest("leader", "key"))


def _named(judged: DataFrame, roots: DataFrame) -> DataFrame:
    """judged with the classes of key (root) and leader (led)."""
    named = judged.join(roots, "key", "left").select("bucket", "leader", "key", *AT, "similarity", "round", F.coalesce("root", "key").alias("root"))
    return named.join(roots.toDF("leader", "led"), "leader", "left").withColumn("led", F.coalesce("led", "leader"))


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots of the classes after further links, found on the graph of the classes."""
    of = lambda c: F.coalesce(c, F.col("k")).alias("r")
    ends = links
    for side in ("a", "b"):
        ends = ends.withColumnRenamed(side, "k").join(roots.toDF("k", "found"), "k", "left").withColumn(side, of(F.col("found"))).drop("k", "found")
    merged = components(ends)
    return written(roots.join(merged.toDF("root", "over"), "root", "left").select("key", F.coalesce("over", "root").alias("root")).unionByName(merged), "roots")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id) for every row: texts that chains of J_P >= threshold connect.

    class_id is the smallest doc_id of the class (null if none has one). Texts
    without words are alone: their class is their own id. Fewer than five words
    count as one shingle. Repeated rows and equal texts share a class. Other
    columns are ignored.
    """
    keyed = need(docs, "doc_id", "text").withColumn("key", F.when(F.regexp("text", F.lit(_WORDED)), text_key(F.col("text"))))
    with scratch() as keep:
        roots = keep(_classes(keyed, threshold))
    placed = keyed.select("doc_id", "key").join(roots, "key", "left").select("doc_id", F.coalesce("root", "key").alias("root"))
    heads = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    return placed.join(heads, "root", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def _classes(keyed: DataFrame, threshold: float) -> DataFrame:
    """(key, root), written: the class of each text that is near another one; the smallest key is the root."""
    far = 1 - threshold
    signed = written(keyed.where("key IS NOT NULL").select("key", "text").mapInPandas(frugal(_sign), "key binary, bands array<long>").dropDuplicates(["key"]), "signatures")
    sizes = written(signed.select(F.explode("bands").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    banded = written(_shared_bands(signed, sizes), "banded")
    spent(signed, sizes)
    held = written(banded.select("key").distinct(), "held")
    # Texts of the few that share a band: up to MOST_SENT keys (8 MB) go to every task, beyond that all texts are shuffled.
    found = keyed.select("key", "text").join(F.broadcast(held) if held.count() <= MOST_SENT else held, "key", "left_semi")
    texts = written(found.dropDuplicates(["key"]), "texts")
    whole = {"u": F.lit(1.0), "k": F.lit(1).cast("long"), "n": F.lit(1).cast("long"), "e": F.lit(0).cast("long")}  # the bound says nothing of small buckets
    small = banded.where(F.col("size") <= CROWD).select("bucket", "key", *[v.alias(c) for c, v in whole.items()])
    crowd = texts.join(banded.where(F.col("size") > CROWD).select("key").distinct(), "key", "left_semi")
    buckets = written(small.unionByName(_split(crowd, threshold)), "buckets")
    members = written(_led(buckets, threshold).withColumn("open", F.lit(True)), "members")
    spent(banded, buckets)

    def verified(pairs: DataFrame) -> DataFrame:
        with_a = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
        with_b = with_a.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
        return written(with_b.select("a", "b", "text_a", "text_b").mapInPandas(frugal(_verify), "a binary, b binary, similarity double"), "verified")

    linked = F.coalesce(F.col("similarity") >= threshold, F.lit(False))  # null: the bound left no room, so it was not verified
    tested, later, roots, rounds = None, None, None, []
    while True:
        wanted = _pairs(members.where("open")).select("a", "b").distinct()
        new = verified(wanted if tested is None else wanted.join(tested, ["a", "b"], "left_anti"))
        tested = new if tested is None else tested.unionByName(new)
        links = new.where(linked).select("a", "b")
        later = links if later is None else later.unionByName(links)
        judged = written(_pairs(members).join(tested, ["a", "b"], "left").drop("a", "b", "open").withColumn("round", F.lit(len(rounds))), "judged")
        rounds.append(judged)
        # Who is linked to a leader, by the first round's chains or at once, needs no further test in its bucket.
        if roots is None:
            roots, later = components(links), None
        named = _named(judged, roots)
        settled = named.groupBy("bucket", "key", *AT).agg(F.max((F.col("root") == F.col("led")) | linked).alias("in")).where("NOT in")
        led = judged.select("bucket", F.col("leader").alias("key")).distinct()
        rest = written(settled.drop("in").join(led, ["bucket", "key"], "left_anti"), "rest")
        spent(members)
        members = written(_led(rest, threshold, LEADERS << 2 * (len(rounds) - 1)), "members")
        spent(rest)
        if members.isEmpty():
            break

    if later is not None:
        roots = _joined(roots, later)

    # What a leader could not rule out: x of its class and y of another one, in one bucket.
    named = written(_named(functools.reduce(DataFrame.unionByName, rounds), roots), "named")
    # One leader of x is enough, of the first round that has one: y was there too, or left before and has x against its own.
    own = F.min(F.struct("round", F.coalesce(-F.col("similarity"), F.lit(1.0)).alias("away"), "leader", "root")).alias("own")
    x = named.where("root = led").groupBy("bucket", F.col("key").alias("a"), *AT).agg(own)
    x = x.select("bucket", F.col("own.leader").alias("leader"), "a", F.when(F.col("own.away") <= 0, -F.col("own.away")).alias("sa"), F.col("own.root").alias("ra"), *[F.col(c).alias(f"x{c}") for c in AT])
    # Chains put x in the leader's class at any distance, so y is ruled out by the farthest x alone.
    reach = x.groupBy("bucket", "leader").agg(F.min(F.coalesce("sa", F.lit(0.0))).alias("least"))
    edge = named.where(~linked & (F.col("root") != F.col("led"))).join(reach, ["bucket", "leader"])
    edge = written(edge.where(F.coalesce(F.col("similarity") >= F.col("least") - far - 1e-9, F.lit(True))).drop("least"), "edge")
    if not edge.isEmpty():
        y = edge.select("bucket", "leader", F.col("key").alias("b"), F.col("similarity").alias("sb"), F.col("root").alias("rb"), *[F.col(c).alias(f"y{c}") for c in AT])
        near = F.coalesce(F.abs(F.col("sa") - F.col("sb")) <= far + 1e-9, F.lit(True))
        open_ = x.join(y, ["bucket", "leader"]).where(near & (F.col("ra") != F.col("rb")) & _possible(lambda c: F.col(f"x{c}"), lambda c: F.col(f"y{c}"), threshold))
        open_ = open_.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")
        more = verified(open_).where(linked).select("a", "b")
        if not more.isEmpty():
            roots = _joined(roots, more)
    return roots if hasattr(roots, "_bw_path") else written(roots, "roots")


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with one row of each class: that with the class's smallest id.

    Of rows that repeat this id and text one stays. Rows without an id cannot be
    told apart by it: they go if each of them is in a class that has an id, and
    else all stay.
    """
    stays = F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)) | F.col("class_id").isNull()
    gone = near_duplicates(docs, threshold).groupBy(F.col("doc_id").alias("_bw_id")).agg(F.max(stays).alias("stays")).where("NOT stays").drop("stays")
    # Those that go are fewer than those that stay, so their table is the likelier to be broadcast.
    kept = docs.join(written(gone, "gone"), F.col("doc_id").eqNullSafe(F.col("_bw_id")), "left_anti")
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    return kept.withColumn("_bw_key", text_key(F.col("text"))).dropDuplicates(["doc_id", "_bw_key"]).drop("_bw_key")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
