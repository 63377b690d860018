import numpy as np
import pandas as pd
import pytest

from branchwise.llm import neardup
from branchwise.llm.words import shingles, word_hashes

SF = "/root/testdata/sf0.01"


def brute_classes(rows, threshold=0.8):
    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    sets = [np.unique(s, return_counts=True) for s in shingles(*word_hashes(texts))]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = {}
    for i, (h, _) in enumerate(sets):
        for x in h.tolist():
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for v in holders.values() for k, a in enumerate(v) for b in v[k + 1 :]}
    for a, b in pairs:
        if neardup.probability_jaccard(sets[a], sets[b]) >= threshold:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    least = {}
    for i in range(len(rows)):
        least.setdefault(find(i), []).append(ids[i])
    return {i: min(v) for v in least.values() for i in v}


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r[0]: r[1] for r in neardup.near_duplicates(docs).collect()}
    assert got == brute_classes(docs.select("doc_id", "text").orderBy("doc_id").collect())


def test_probability_jaccard_by_definition():
    rng = np.random.default_rng(1)
    for _ in range(30):
        a, b = (np.unique(rng.integers(0, 30, 25).astype(np.uint64), return_counts=True) for _ in range(2))
        x = dict(zip(a[0].tolist(), (a[1] / a[1].sum()).tolist(), strict=True))
        y = dict(zip(b[0].tolist(), (b[1] / b[1].sum()).tolist(), strict=True))
        want = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y}) for i in x if i in y)
        assert neardup.probability_jaccard(a, b) == pytest.approx(want)


def test_registers_estimate_similarity():
    words = [f"w{i}" for i in range(3000)]
    a, b = " ".join(words[:2000]), " ".join(words[:1900] + words[2900:])
    s = neardup.signatures([a, b], 2000)
    sets = [np.unique(x, return_counts=True) for x in shingles(*word_hashes([a, b]))]
    assert (s[0] == s[1]).mean() == pytest.approx(neardup.probability_jaccard(*sets), abs=0.04)


def test_chain_whose_ends_differ(spark):
    """Each link of a chain is found though its ends are far apart, whatever leads a bucket."""
    words = [f"w{i}" for i in range(700)]
    rows = [(k, " ".join(words[k * 12 : 400 + k * 12])) for k in range(14)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0}


def test_odd_rows(spark, odd_docs):
    got = neardup.near_duplicates(odd_docs).toPandas()
    assert len(got) == 10
    known = {int(d): c for d, c in zip(got.doc_id, got.class_id, strict=True) if not pd.isna(d)}
    assert known == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7}
    kept = neardup.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 7]
    assert neardup.near_duplicates(odd_docs.limit(0)).count() == 0


def classes_in_buckets(spark, monkeypatch, texts, bands, head):
    """class_id of each text where its buckets are as given; head leads bucket 0."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    turns = frame.crossJoin(spark.range(200).toDF("bucket")).select("doc_id", "bucket", F.xxhash64(neardup.text_key(F.col("text")), "bucket").alias("turn")).toPandas()
    least = turns[turns.doc_id.isin([k for k, b in enumerate(bands) if 0 in b])].sort_values("turn").drop_duplicates("bucket")
    names = {0: int(least[least.doc_id == head].bucket.iloc[0])}
    by_text = {t: [names.get(x, 1000 + x) for x in b] for t, b in zip(texts, bands, strict=True)}

    def sign(frames, real=neardup._sign):
        for f in frames:
            f = f.reset_index(drop=True)
            for part in real(iter([f])):
                text = dict(zip([bytes(k) for k in f["key"]], f["text"], strict=True))
                yield part.assign(bands=[by_text[text[bytes(k)]] for k in part["key"]])

    monkeypatch.setattr(neardup, "_sign", sign)
    return [r.class_id for r in neardup.near_duplicates(frame).orderBy("doc_id").collect()]


def test_far_member_by_a_chain_keeps_its_links(spark, monkeypatch):
    """x is at 0.64 of the leader and in its class through another bucket; y is at 0.51 of the leader and at 0.80 of x."""
    words = [f"w{i}" for i in range(1400)]
    texts = [" ".join(words[k * 109 : 1004 + k * 109]) for k in range(4)]
    assert classes_in_buckets(spark, monkeypatch, texts, [[0], [0, 1], [0, 1], [0]], 0) == [0, 0, 0, 0]


def test_pair_with_one_common_band_behind_another_leader(spark, monkeypatch):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(f"v{i}" for i in range(300)), " ".join(words[:300]), " ".join(words[10:310])]
    assert classes_in_buckets(spark, monkeypatch, texts, [[0], [0, 1], [0, 2]], 0) == [0, 1, 1]
