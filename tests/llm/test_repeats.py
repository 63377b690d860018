import hashlib
import random

import numpy as np
import pandas as pd

from branchwise.llm import repeats as r


def brute(rows):
    """rows: (doc_id, text), ids different; brute force over all windows."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda x: x[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            w = raw[k : k + 100]
            if w in seen:
                gone[k : k + 100] = b"\x01" * 100
            seen.add(w)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest())
    return out


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}é" for i in range(400)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [line(n) for n in (15, 40, 120)]
    rows = [(k, " ".join(rng.choice([line(30), rng.choice(passages), passages[1][rng.randrange(60):]]) for _ in range(rng.randrange(1, 6)))) for k in range(150)]
    rows += [(200, rows[7][1]), (201, rows[7][1]), (202, "a" * 5000), (203, "ab" * 300), (204, None), (205, ""), (206, "x" * 99), (207, "x" * 99), (208, "a" * 100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: tuple(x)[1:5] for x in r.repeats(frame).collect()}
    assert got == brute(rows)
    monkeypatch.setattr(r, "HOT", 3)
    assert {x.doc_id: tuple(x)[1:5] for x in r.repeats(frame).collect()} == got


def test_suffix_order():
    strings = [b"banana", b"ana", b"", b"nab"]
    who, start = r.suffix_order(strings)
    assert [strings[w][s:] for w, s in zip(who, start)] == sorted(s[k:] for s in strings for k in range(len(s) + 1))


def test_odd_rows(spark, odd_docs):
    got = r.repeats(odd_docs).collect()
    assert len(got) == 10
    assert all(x.n_removed == x.n_bytes for x in got if x.doc_id == 2) and all(x.n_removed == 0 for x in got if x.doc_id in (1, 3, 4, 5))
    assert r.repeats(odd_docs.limit(0)).count() == 0


def test_one_id_with_several_texts(spark):
    """Each row is judged, whatever stands under its id; of two texts of one id one is the earlier."""
    rng = random.Random(9)
    a, b = ("".join(rng.choice("abcdefgh") for _ in range(300)) for _ in range(2))
    rows = [(1, a + b), (1, b + a), (1, b + a), (None, a), (None, b), (0, "x")]
    got = r.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 6
    assert all(x.n_removed == 300 for x in got if x.doc_id is None)
    assert sorted(x.n_removed > 0 for x in got if x.doc_id == 1) in ([False, False, True], [False, True, True])


def test_hashes_of_hot_windows_are_whole_beside_other_fragments():
    """Windows of one text have the same 64-bit hashes, whatever else stands in their frame."""
    text = "".join(random.Random(3).choices("abcdefgh", k=400))
    _, anchor, _, start, n = r.fragments([text.encode()])

    def hashes(hot):
        frame = pd.DataFrame({"id": [5], "text": [text], "at": [start[:2] << 8 | n[:2]], "anchor": [anchor[:2]], "hot": [np.array(hot)]})
        cut = pd.concat(list(r._cut(iter([frame]))))
        blocks = cut[cut["hot"]]
        windows = pd.concat(list(r._windows(iter([blocks]))))
        return [list(zip(*[f[c].tolist() for c in ("start", "anchor", "mark")])) for f in (blocks, windows)], int((~cut["hot"]).sum())

    (blocks, windows), others = hashes([True, True])
    assert others == 0 and [w[0] for w in windows] == list(range(n[0] + n[1])) and len(set(windows)) == len(windows)
    (some, first), others = hashes([True, False])
    assert others == 1 and first == windows[: n[0]] and some == [b for b in blocks if b[0] < n[0]]


def test_only_suffixes_that_hold_a_window_are_sorted(monkeypatch):
    """Suffixes too short for a window are never built: each of the others enters as many rounds before the last as it has symbols."""
    rng = random.Random(4)
    strings = ["".join(rng.choices("ab", k=rng.randrange(90, 177))).encode() for _ in range(40)]
    every = [(w, s) for w, s in zip(*(x.tolist() for x in r.suffix_order(strings))) if len(strings[w]) - s >= 100]
    sorted_symbols, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, **kw: sorted_symbols.append(len(x)) or argsort(x, **kw))
    assert list(zip(*(x.tolist() for x in r.suffix_order(strings, 100)))) == every
    assert sum(sorted_symbols) == sum(len(strings[w]) - s for w, s in every)


def test_fragments_of_several_texts_are_those_of_each(monkeypatch):
    rng = random.Random(6)
    raws = ["".join(rng.choices("abcdé ", k=rng.randrange(700))).encode() for _ in range(60)] + [b"a" * 5000, b"ab" * 300, b"", b"x" * 99, b"a" * 100]
    for batch, piece in ((1 << 16, 1 << 20), (500, 1 << 20), (2000, 150)):
        monkeypatch.setattr(r, "BATCH", batch)
        monkeypatch.setattr(r, "PIECE", piece)
        got = r.fragments(raws)
        alone = [r.fragments([raw]) for raw in raws]
        assert got[0].tolist() == [k for k, a in enumerate(alone) for _ in a[1]]
        for column in range(1, 5):
            assert got[column].tolist() == [x for a in alone for x in a[column].tolist()]
        anchors = {}
        for text, anchor, start, n in zip(got[0].tolist(), got[1].tolist(), got[3].tolist(), got[4].tolist()):
            assert 1 <= n <= r.LENGTH - r.ANCHOR + 1
            assert all(anchors.setdefault(raws[text][k : k + 100], anchor) == anchor for k in range(start, start + n))
        assert sum(got[4].tolist()) == sum(max(0, len(raw) - 99) for raw in raws)


def test_hot_fragments_repeat_in_blocks():
    """Fragments that share most windows share most blocks, wherever they begin: few windows are left to compare singly."""
    text = "".join(random.Random(8).choices("abcdefgh", k=3000)).encode()
    _, anchor, _, start, n = r.fragments([text])
    k = int(np.argmax(n))
    whole = [(text[start[k] + i : start[k] + n[k] + 99], n[k] - i) for i in range(0, 30, 3)]
    of, first, size, one, two = r._blocks_of(np.frombuffer(b"".join(p for p, _ in whole), np.uint8), np.array([m for _, m in whole]), np.full(len(whole), anchor[k]))
    assert all(size[of == f].sum() == m for f, (_, m) in enumerate(whole)) and size.max() == r.STEP
    different = len({(a, b) for a, b in zip(one.tolist(), two.tolist())})
    assert different <= -(-n[k] // r.STEP) + 1 + len(whole)
