"""The prefix trie of conversations, as a Cartesian tree over the common prefixes of the sorted conversations.

A conversation is a string of fixed-width hashes of its turns, so sorting the
strings sorts the conversations and their common prefixes are whole turns. The
sorted rows are cut in blocks. Within a block the nearest smaller values of the
common prefix array l bound an interval [a, b) of rows for each l[k]; equal
ones with equal bounds are one node, and the depths from above
max(l[a], l[b]) up to l[k] are nodes over the same rows; so are the depths up
to a row's own length over that row alone. Everything about a node is a sum
over its rows, a minimum over them, or stands in its first row.

A node that crosses a block's edge is made of pieces. The nearest block before
whose smallest l is below the piece's depth owns it: the driver gets two
numbers a block for that. Only such pieces, a path at each edge of a block, are
joined by a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from branchwise.llm.common import frugal, need, spent, table, written

#: Characters that stand for a turn: 120 bits of a SHA-256, in base 64.
WIDTH = 20
#: Borrowed turns are fewer than this, and conversations that share a base.
BORROW, GROUP = 9, 5
#: Conversations, and characters, after which a block ends.
BLOCK_ROWS, BLOCK_CHARS = 16_384, 4 << 20
#: Lists in a block are strings of little-endian 64-bit numbers; ids: of each row, joined by commas.
BLOCK = "part int, chunk int, n_rows long, head string, tail string, before long, least long, lengths binary, common binary, sizes binary, counts binary, smallest binary, ids array<string>"
PIECE = "owner long, block long, depth int, conv_id long, parent_conv_id long, parent_owner long, size long, n_convs long, n_children long, n_leaves long, saved_tokens long, ids string, ends_sha256 string"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(f.split()[0], _ARROW[f.split()[1]]) for f in schema.split(", ")])


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): each conversation's borrowed and own turns, hashed, and their texts' bytes.

    Only hashes and sizes are shuffled. A conversation is one row, 30 bytes a turn.
    """
    role, words = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    code = F.base64(F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, words), 256)), 1, WIDTH * 3 // 4))
    turns = need(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    turns = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", code.alias("code"), F.octet_length(words).cast("long").alias("size"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "code")
    numbered = turns.withColumn("n", F.row_number().over(order)).drop("turn")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROW).cast("int")
    convs = numbered.where("n = 1").select("conv_id", h.alias("h"), (F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP))).alias("base"))
    lent = numbered.where(F.col("n") < BORROW).withColumnRenamed("conv_id", "base")
    parts = [
        convs.select("conv_id", F.lit(0).alias("n"), F.lit("").alias("code"), F.lit(0).cast("long").alias("size")),  # the root, so that none is left out
        convs.where("h > 0").join(lent, "base").where("n <= h").select("conv_id", "n", "code", "size"),
        numbered.where(F.col("n") > h).select("conv_id", "n", "code", "size"),
    ]
    listed = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "code", "size"))).alias("t"))
    return listed.select("conv_id", F.array_join("t.code", "").alias("path"), F.slice("t.size", 2, F.greatest(F.size("t") - 1, F.lit(1))).alias("sizes"))


def common(a: str, b: str) -> int:
    """Turns that two paths begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    x, y = (np.frombuffer(s[:n].encode(), np.uint8) for s in (a, b))
    return int(np.argmax(x != y)) // WIDTH


def _bytes(numbers) -> bytes:
    return np.asarray(numbers, np.int64).tobytes()


class _Blocks:
    """Gathers sorted rows to blocks; equal neighbours are one row."""

    def __init__(self, part: int, most: int):
        self.part, self.most, self.chunk, self.last = part, most, 0, None
        self.clear()

    def clear(self) -> None:
        self.paths, self.common, self.sizes, self.counts, self.smallest, self.ids, self.rows, self.held = [], [], [], [], [], [], 0, 0

    def add(self, conv: int, path: str, sizes: list[int]) -> None:
        if self.paths and self.paths[-1] == path:
            self.counts[-1] += 1
            self.smallest[-1] = min(self.smallest[-1], conv)
            self.ids[-1].append(str(conv))
        else:
            self.common.append(-1 if self.last is None else common(self.last, path))
            self.paths.append(path)
            self.sizes += sizes
            self.counts.append(1)
            self.smallest.append(conv)
            self.ids.append([str(conv)])
            self.held += len(path)
        self.last = path
        self.rows += 1
        self.held += 8

    def full(self) -> bool:
        return self.rows >= self.most or self.held >= BLOCK_CHARS

    def take(self) -> dict:
        row = {
            "part": self.part, "chunk": self.chunk, "n_rows": self.rows, "head": self.paths[0], "tail": self.paths[-1], "before": None if self.chunk == 0 else self.common[0], "least": min(self.common[1:], default=1 << 40),
            "lengths": _bytes([len(p) // WIDTH for p in self.paths]), "common": _bytes(self.common), "sizes": _bytes(self.sizes), "counts": _bytes(self.counts), "smallest": _bytes(self.smallest), "ids": [",".join(x) for x in self.ids],
        }
        self.chunk += 1
        self.clear()
        return row


def blocks(paths: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The sorted conversations, a block a row (BLOCK); common[0] and before say nothing of a partition's first block."""
    schema = _arrow(BLOCK)

    def gather(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state = _Blocks(TaskContext.get().partitionId(), block_rows)
        for frame in frames:
            for conv, path, sizes in zip(*[frame.column(k).to_pylist() for k in range(3)], strict=True):
                state.add(conv, path, sizes)
                if state.full():
                    yield pa.RecordBatch.from_pylist([state.take()], schema)
        if state.paths:
            yield pa.RecordBatch.from_pylist([state.take()], schema)

    dealt = paths.select("conv_id", "path", "sizes").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    return dealt.mapInArrow(frugal(gather), BLOCK)


def _edges(held: DataFrame) -> tuple[dict[tuple[int, int], int], np.ndarray, np.ndarray]:
    """Each block's place in the order, its first common prefix and its least one; -1 before the first block."""
    spark = held.sparkSession
    parts = sorted(r[0] for r in held.where("chunk = 0").select("part").collect())
    after = spark.createDataFrame([(a, b) for a, b in zip(parts, parts[1:], strict=False)], "part int, next int")
    tails = held.groupBy("part").agg(F.max_by("tail", "chunk").alias("tail")).join(F.broadcast(after), "part").select(F.col("next").alias("part"), "tail")

    def compare(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            made = [common(a, b) for a, b in zip(frame.column(1).to_pylist(), frame.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array(made, pa.int64())], ["part", "before"])

    first = {r[0]: r[1] for r in held.where("chunk = 0").select("part", "head").join(tails, "part").select("part", "tail", "head").mapInArrow(compare, "part int, before long").collect()}
    rows = sorted((r[0], r[1], r[2], r[3]) for r in held.select("part", "chunk", "before", "least").collect())  # two numbers a block
    before = np.array([first.get(p, -1) if c == 0 else b for p, c, b, _ in rows], np.int64)
    return {(p, c): k for k, (p, c, _, _) in enumerate(rows)}, before, np.minimum(before, np.array([x[3] for x in rows], np.int64))


def nearest_smaller(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest smaller value before and after each value between the ends, which are smaller than all these."""

    def before(numbers: list[int]) -> np.ndarray:
        out, stack = np.zeros(len(numbers), np.int64), [0]
        for k, v in enumerate(numbers[1:], 1):
            while len(stack) > 1 and numbers[stack[-1]] >= v:
                stack.pop()
            out[k] = stack[-1]
            stack.append(k)
        return out

    return before(values.tolist()), len(values) - 1 - before(values[::-1].tolist())[::-1]


def _owners(least: np.ndarray, smaller: np.ndarray, block: int, depths: np.ndarray) -> np.ndarray:
    """The nearest block before `block` whose least common prefix is below each depth, by way of the nearest smaller ones."""
    at, found = block - 1, {}
    for d in sorted(set(depths.tolist()), reverse=True):
        while least[at] >= d:
            at = int(smaller[at])
        found[d] = at
    return np.array([found[d] for d in depths.tolist()], np.int64)


def pieces(lengths: np.ndarray, shared: np.ndarray, sizes: np.ndarray, counts: np.ndarray, smallest: np.ndarray, ids: list[str], block: int, before: int, next_: int, edges: tuple[np.ndarray, np.ndarray]) -> dict[str, list]:
    """The nodes of a block, or their pieces (owner not null); before, next_: the common prefix at its first row and behind its last; edges: the least one of each block and the nearest block before with a smaller one."""
    m = len(lengths)
    local = np.concatenate([[-1], shared[1:], [-1]]).astype(np.int64)
    true = np.concatenate([[before], shared[1:], [next_]]).astype(np.int64)
    left, right = nearest_smaller(local)
    k = np.arange(1, m)
    group = np.lexsort((local[k], left[k]))
    a, v, b = left[k][group], local[k][group], right[k][group]
    head = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (v[1:] != v[:-1])])) if m > 1 else np.empty(0, np.int64)
    merged = np.diff(np.concatenate([head, [m - 1]]))
    a, b, v = (np.concatenate([x[head], y]) for x, y in ((a, np.arange(m)), (b, np.arange(1, m + 1)), (v, lengths)))
    merged = np.concatenate([merged, np.zeros(m, np.int64)])
    low = np.maximum(local[a], local[b])
    keep = v > low
    a, b, v, low, merged = a[keep], b[keep], v[keep], low[keep], merged[keep]

    # A node for each depth.
    many = v - low
    of = np.repeat(np.arange(len(a)), many)
    d = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + low[of] + 1
    a, b, last = a[of], b[of], d == v[of]
    sums = np.concatenate([[0], np.cumsum(sizes)])
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    upto = lambda row, depth: sums[begins[row] + np.maximum(depth, 0)] - sums[begins[row]]
    total = upto(np.arange(m), lengths)
    over = lambda x: (lambda c: c[b] - c[a])(np.concatenate([[0], np.cumsum(x)]))
    fresh = total - upto(np.arange(m), true[:-1])
    open_left, open_right = (a == 0) & (d <= before), (b == m) & (d <= next_)
    above = upto(a, d - 1)
    convs = over(counts)
    distinct = over(fresh) + np.where(open_left, 0, total[a] - above - fresh[a])  # bytes of the nodes below, each once
    minima = [smallest]
    while 2 << (len(minima) - 1) <= m:
        half, prior = 1 << (len(minima) - 1), minima[-1]
        minima.append(np.minimum(prior[:-half], prior[half:]))
    level = np.frexp((b - a).astype(np.float64))[1] - 1
    conv = np.array([min(minima[x][i], minima[x][j - (1 << x)]) for x, i, j in zip(level.tolist(), a.tolist(), b.tolist(), strict=True)], np.int64)

    # A parent has the same rows or is the smallest node about them at the depth above.
    edge = open_left | open_right
    number = {x: n for n, x in enumerate(zip(a.tolist(), d.tolist(), strict=True))}
    parent = np.array([number.get((i, j - 1), -1) for i, j in zip(a.tolist(), d.tolist(), strict=True)], np.int64)
    for n in np.flatnonzero((parent < 0) & (d > 0)).tolist():  # it begins before: at the nearest row whose common prefix is below its depth
        i, depth = int(a[n]), int(d[n]) - 1
        while local[i] >= depth:
            i = int(left[i])
        parent[n] = number[i, depth]
    owner = np.full(len(d), -1, np.int64)
    if open_left.any():
        owner[open_left] = _owners(*edges, block, d[open_left])
    owner[open_right & ~open_left] = block
    up = np.maximum(parent, 0)
    end = d == lengths[a]
    own = (lengths[a] > d) & ~((a == 0) & (before > d))
    known = (parent >= 0) & ~edge[up]
    held = [ids[i] if e else "" for i, e in zip(a.tolist(), end.tolist(), strict=True)]
    null = lambda x, keep: [y if q else None for y, q in zip(x.tolist(), keep.tolist(), strict=True)]
    return {
        "owner": null(owner, edge), "block": [block] * len(d), "depth": d.tolist(), "conv_id": conv.tolist(), "parent_conv_id": null(conv[up], known), "parent_owner": null(owner[up], (parent >= 0) & edge[up]),
        "size": (upto(a, d) - above).tolist(), "n_convs": convs.tolist(), "n_children": (own + np.where(last, merged[of], 0)).tolist(), "n_leaves": over((true[1:] < lengths).astype(np.int64)).tolist(),
        "saved_tokens": (over(counts * total) - convs * above - distinct).tolist(), "ids": [x if e else None for x, e in zip(held, edge.tolist(), strict=True)],
        "ends_sha256": [None if e else hashlib.sha256(x.encode()).hexdigest() for x, e in zip(held, edge.tolist(), strict=True)],
    }


def _streamed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each (owner, depth), whose rows follow each other in order of block."""
    key, digest, begun = None, None, False
    done: list[tuple] = []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.string()))], ["owner", "depth", "ends_sha256"])

    for frame in frames:
        for owner, depth, _, ids in zip(*[frame.column(k).to_pylist() for k in range(4)], strict=True):
            if (owner, depth) != key:
                if key:
                    done.append((*key, digest.hexdigest()))
                key, digest, begun = (owner, depth), hashlib.sha256(), False
            if ids:
                digest.update((b"," if begun else b"") + ids.encode())
                begun = True
        if done:
            yield out()
            done = []
    if key:
        done.append((*key, digest.hexdigest()))
        yield out()


def trie(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row a node (NODE) of the trie of the rebuilt conversations.

    Turns go by `turn`, null first; equal turns by a hash of role and text.
    A null role or text is empty. Rows without a conv_id belong to no
    conversation and are left out. Repeated rows are turns of their own. An
    empty table has no conversations and gives no node, not even a root. Other
    columns are ignored.
    """
    spark = conversations.sparkSession
    held = written(blocks(rebuilt(conversations), block_rows), "blocks")
    place, before, least = _edges(held)
    smaller = nearest_smaller(np.append(least, -1))[0] if len(least) else least
    shipped, schema = spark.sparkContext.broadcast((place, before, least, smaller)), _arrow(PIECE)  # a few numbers a block

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, before, least, smaller = shipped.value
        for frame in frames:
            for row in frame.to_pylist():
                at = place[row["part"], row["chunk"]]
                lists = [np.frombuffer(row[c], np.int64) for c in ("lengths", "common", "sizes", "counts", "smallest")]
                yield pa.RecordBatch.from_pydict(pieces(*lists, row["ids"], at, int(before[at]), int(before[at + 1]) if at + 1 < len(before) else -1, (least, smaller)), schema)

    made = written(held.mapInArrow(frugal(cut), PIECE), "pieces")
    spent(held)
    shared = made.where("owner IS NOT NULL")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    joined = shared.groupBy("owner", "depth").agg(F.min("conv_id").alias("conv_id"), F.min_by("parent_owner", "block").alias("parent_owner"), *sums)
    ends = shared.select("owner", "depth", "block", "ids").repartition("owner", "depth").sortWithinPartitions("owner", "depth", "block").mapInArrow(_streamed, "owner long, depth int, ends_sha256 string")
    joined = written(joined.join(ends, ["owner", "depth"]), "joined")
    nodes = made.where("owner IS NULL").select(*NODE, "parent_owner").unionByName(joined.withColumn("parent_conv_id", F.lit(None).cast("long")).select(*NODE, "parent_owner"))
    parents = joined.select(F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("found"))
    out = nodes.join(parents, ["parent_owner", "depth"], "left").withColumn("parent_conv_id", F.coalesce("found", "parent_conv_id"))
    return out.select(*[F.col(c).cast("long" if c != "ends_sha256" else "string") for c in NODE])


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))
