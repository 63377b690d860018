import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from branchwise.llm import trie as tr

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes as a dictionary of prefixes."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(set), defaultdict(set)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
        for d in range(len(made) + 1):
            members[made[:d]].add(c)
        ends[made].add(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        kids = children[p]
        size = len(p[-1][1].encode()) if p else 0
        leaves = sum(out[k][5] for k in kids) or 1
        saved = sum(out[k][6] for k in kids) + (len(members[p]) - 1) * size
        text = ",".join(map(str, sorted(ends.get(p, ()))))
        out[p] = (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids), leaves, saved, hashlib.sha256(text.encode()).hexdigest())
    return sorted(map(str, out.values()))


def rows_of(frame):
    return sorted(str(tuple(r)) for r in frame.select(tr.NODE).collect())


def some(n, seed, deep=6, words=3, tie=False):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-n, 3 * n), n):
        rows += [(c, t, rng.choice(["user", "bot"]), rng.choice("abcdé"[:words]) * rng.randrange(3)) for t in range(rng.randrange(1, deep))]
    return rows


@pytest.mark.parametrize(("limit", "deep", "words"), [(1, 12, 2), (3, 6, 1), (7, 12, 3), (16_384, 9, 2)])
def test_against_a_dictionary(spark, limit, deep, words):
    """Blocks of few rows: nodes cross many of them, and groups of equal conversations too."""
    rows = some(150, limit, deep, words)
    rows += [(1000 + k, t, "user", "same") for k in range(40) for t in range(10)]  # one large group of copies
    rows += [(2000, t, "bot", "ab" * (t % 3)) for t in range(120)]  # and a long one
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(tr.trie(frame, limit)) == brute(rows)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_whole_table(spark, sf):
    frame = spark.read.parquet(f"/root/testdata/sf{sf}/conversations.parquet")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(tr.op12_conversation_trie(spark, f"/root/testdata/sf{sf}")) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, 0, None, None), (1, None, "user", "first"), (2, 0, "user", ""), (2, 0, "user", ""), (None, 0, "user", "lost"), (3, 1, "user", "x" * 300_000), (3, 0, None, "é"), (4, None, None, None), (0, 2, "a", "b"), (-7, 0, "user", "q")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("path", "n", "owner", "depth", "block", "h", "base", "code")})
    assert rows_of(tr.trie(frame)) == brute(rows)
    assert tr.trie(frame.limit(0)).count() == 0 and tr.trie(frame.where("conv_id IS NULL")).count() == 0
    same = [(c, 0, "user", "a") for c in range(30)]
    assert rows_of(tr.trie(spark.createDataFrame(same, SCHEMA))) == brute(same)


def test_nearest_smaller():
    import numpy as np

    values = np.array([-1, 2, 2, 3, 0, 2, 1, 1, -1])
    before, after = tr.nearest_smaller(values)
    assert before[1:-1].tolist() == [0, 0, 2, 0, 4, 4, 4] and after[1:-1].tolist() == [4, 4, 4, 8, 6, 8, 8]
