import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from branchwise.llm import periods as pr


def brute_runs(w):
    """Stretches of each period by a scan; of equal stretches the smallest period."""
    best = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            s = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            if i > s and i - s + q >= max(6, 4 * q):
                best.setdefault((s, i - s + q), q)
            i += i == s
    return sorted((s, q, n) for (s, n), q in best.items())


def brute(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {i for s, q, m in found for i in range(s + q, s + m)}
    best = min(((-m, s, q) for s, q, m in found), default=None)
    top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{m},{q}\n" for s, q, m in found)
    return (doc_id, len(found), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def listed(frame):
    return sorted(str(tuple(r)) for r in frame.drop("n_words").collect())


def test_runs_of_many_texts_at_once():
    rng = random.Random(3)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 8)):
            n, k = rng.choice([0, 1, 5, 6, 7, 12, 40, 90]), rng.choice([1, 2, 3, 6])
            t = [rng.randrange(k) for _ in range(n)]
            if n > 10 and rng.random() < 0.5:
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 4))
                t = [t[i] if i < a else t[a + (i - a) % p] for i in range(n)]
            texts.append(t)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        got = pr.runs(np.array([x for t in texts for x in t], np.int64), bounds)
        for k, t in enumerate(texts):
            assert sorted((s, p, n) for i, s, n, p in got.tolist() if i == k) == brute_runs(t)


def test_grid_in_small_parts(monkeypatch):
    monkeypatch.setattr(pr, "GRID", 3)
    words = np.array([1, 2, 3] * 20 + [9] * 7 + [4, 5] * 6, np.int64)
    assert [(s, p, n) for _, s, n, p in pr.runs(words, np.array([0, len(words)])).tolist()] == brute_runs(words.tolist())


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert listed(pr.op13_periodic_runs(spark, "/root/testdata/sf0.001")) == sorted(str(brute(*r)) for r in docs)


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect() if len(r.text or "") < 10_000] + [(20, "a " * 3000), (21, " ".join(["x y z"] * 50 + ["x y"])), (30, "\x0b\x0c\r"), (31, "w w w w " * 6), (2**60, "b " * 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("start", "n_runs", "period")})
    assert listed(pr.periodic_runs(frame, plant=True)) == sorted(str(brute(*r)) for r in rows)
    assert pr.periodic_runs(odd_docs).count() == odd_docs.count()
    assert pr.periodic_runs(frame.limit(0)).count() == 0
    [row] = pr.periodic_runs(spark.createDataFrame([(7, "k " + "a b " * 30)], "doc_id long, text string")).collect()
    assert (row.n_words, row.n_runs, row.start, row.length, row.period) == (61, 1, 1, 60, 2)
    assert row.collapsed_sha256 == hashlib.sha256(b"k a b").hexdigest()
