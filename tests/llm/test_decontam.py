import itertools
import math

import numpy as np

from branchwise.llm import decontam


def substituted(rng, lengths, copies):
    """Items, and texts that hold each with as many words substituted as the threshold allows: (doc_id, text, item_id, n_matched)."""
    items, docs = [], []
    for n in lengths:
        words = [f"i{n}w{k}" for k in range(n)]
        items.append((n, " ".join(words)))
        lost = n - math.ceil(decontam.THRESHOLD * n)
        for _ in range(copies):
            held = list(words)
            for k in rng.choice(n, lost, replace=False):
                held[k] = f"x{rng.integers(10**9)}"
            before, after = ([f"f{x}" for x in rng.integers(0, 10**9, rng.integers(0, 30))] for _ in range(2))
            docs.append((len(docs), " ".join([*before, *held, *after]), n, n - lost))
    return items, docs


def found(spark, items, docs):
    texts = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    rows = decontam.contaminated(texts, spark.createDataFrame(items, "item_id long, text string")).collect()
    return {(r.doc_id, r.item_id, r.n_matched) for r in rows}


def test_substitutions_at_the_threshold_hide_no_item(spark):
    items, docs = substituted(np.random.default_rng(3), range(12, 61), 40)
    assert found(spark, items, docs) == {(d, i, m) for d, _, i, m in docs}


def test_substitutions_hide_no_short_item(spark):
    items, docs = substituted(np.random.default_rng(4), range(5, 12), 60)
    assert found(spark, items, docs) == {(d, i, m) for d, _, i, m in docs}


def test_each_set_of_places_leaves_a_seed():
    for threshold, longest in ((0.8, 19), (0.6, 12), (0.9, 24), (1.0, 12)):
        for n in range(5, longest + 1):
            masks, size, b = decontam.masks_for(n, threshold)
            seeds = [{at + k for k, bit in enumerate(m) if bit == "1"} for m in masks for at in range(0, size * b - len(m) + 1, size)]
            for lost in itertools.combinations(range(n), n - math.ceil(threshold * n)):
                assert any(s.isdisjoint(lost) for s in seeds), (threshold, n, lost)


def test_items_without_an_id_are_found(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(20)) for k in "abc"}
    docs = [(1, f"x {texts['a']} y", None, 20), (2, f"x {texts['b']} {texts['c']} y", None, 20), (3, "x y", None, 0)]
    items = [(None, texts["a"]), (None, texts["a"]), (None, texts["b"]), (None, texts["c"]), (2**60 + 1, texts["c"])]
    assert found(spark, items, docs) == {(1, None, 20), (2, None, 20), (2, 2**60 + 1, 20)}
    docs = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.contaminated(docs, items).count() == 4
    assert [r.doc_id for r in decontam.decontaminate(docs, items).collect()] == [3]


def test_odd_rows(spark, odd_docs):
    bench = spark.createDataFrame([(1, "alpha3 alpha4 alpha5 alpha6 alpha7 alpha8"), (2, None), (3, ""), (4, "alpha1 alpha2"), (None, None)], "item_id long, text string").selectExpr("*", "'x' AS item", "'x' AS words")
    got = decontam.contaminated(odd_docs, bench, least=5).collect()
    assert sorted(map(str, ((r.doc_id, r.item_id) for r in got))) == sorted(map(str, [(1, 1), (1, 1), (2, 1), (None, 1)]))
    every = {(r.doc_id, r.item_id) for r in decontam.contaminated(odd_docs, bench).collect()}
    assert {i for _, i in every} == {1, 4} and {x for x in every if x[1] == 1} == {(1, 1), (2, 1), (None, 1)}
    assert decontam.decontaminate(odd_docs, bench).count() == 6
    assert decontam.contaminated(odd_docs.limit(0), bench).count() == decontam.contaminated(odd_docs, bench.limit(0)).count() == 0
    assert decontam.decontaminate(odd_docs, bench.limit(0)).count() == 10


def brute(items, docs):
    """Every text against every item on every diagonal: (doc_id, item_id, n_matched)."""
    out = set()
    for d, text, *_ in docs:
        w = np.array(text.split(), object)
        for i, item in items:
            x = np.array(item.split(), object)
            best = max((int((x[max(0, -s) : len(w) - s] == w[max(0, s) : max(0, s) + len(x[max(0, -s) : len(w) - s])]).sum()) for s in range(1 - len(x), len(w))), default=0)
            if best >= decontam.THRESHOLD * len(x):
                out.add((d, i, best))
    return out


def templated(rng, n_items, own, shared):
    """Items that are alike but for `own` words; texts that hold one with the substitutions allowed, or the words that all share alone."""
    n, items, docs = own + shared, [], []
    places = set(rng.choice(n, own, replace=False).tolist())
    for i in range(n_items):
        items.append((i, " ".join(f"own{i}x{k}" if k in places else f"t{k}" for k in range(n))))
    for i, item in items[::3]:
        held = item.split()
        for k in rng.choice(n, decontam.allowed(n, decontam.THRESHOLD), replace=False):
            held[k] = f"x{rng.integers(10**9)}"
        docs.append((2 * i, " ".join(["before"] * int(rng.integers(0, 5)) + held + ["after"] * int(rng.integers(0, 5)))))
    docs += [(2 * i + 1, " ".join(f"other{i}x{k}" if k in places else f"t{k}" for k in range(n))) for i in range(n_items)]
    return items, docs


def test_items_of_one_template_are_found_as_by_brute_force(spark):
    rng = np.random.default_rng(8)
    for own, shared in ((4, 6), (12, 18), (8, 32), (5, 35)):
        items, docs = templated(rng, 12, own, shared)
        want = brute(items, docs)
        assert {d for d, *_ in want} >= {2 * i for i, _ in items[::3]}
        assert found(spark, items, docs) == want, (own, shared)


def test_candidates_of_a_template_grow_with_texts_not_pairs(spark):
    items, docs = templated(np.random.default_rng(9), 200, 15, 15)
    texts, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    lain = decontam.candidates(texts, bench, decontam.THRESHOLD, 1)[0]
    assert len(items[::3]) <= lain.select("key", "item").distinct().count() <= len(docs)


def test_long_items_are_found_by_their_parts(spark):
    assert all(decontam.parts_of(n)[0][0] == 0 and decontam.parts_of(n)[-1][1] == n and (n <= 64 or all(32 <= b - a <= 64 for a, b in decontam.parts_of(n))) for n in range(1, 2000))
    items, docs = substituted(np.random.default_rng(5), (65, 95, 96, 200, 700), 25)
    assert found(spark, items, docs) == {(d, i, m) for d, _, i, m in docs}


def test_items_of_one_to_four_words_match_exactly(spark):
    items = [(n, " ".join(f"w{n}{k}" for k in range(n))) for n in range(1, 5)] + [(9, "...")]
    docs = [(n, f"x {t} y") for n, t in items] + [(10 + n, f"x {t.rpartition(' ')[0]} y {t.rpartition(' ')[2]}z") for n, t in items[1:4]]
    assert found(spark, items, docs) == {(n, n, n) for n in range(1, 5)}
    texts, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert decontam.decontaminate(texts, bench).count() == len(docs) and decontam.decontaminate(texts, bench, least=3).count() == len(docs) - 2
