import re

import numpy as np

from branchwise.llm import words
from branchwise.llm.words import shingles, word_hashes


def test_equal_words_and_only_they_have_equal_hashes(monkeypatch):
    rng = np.random.default_rng(3)
    letters = list("abcdefghiXYZé ,.\n0189")
    texts = ["".join(rng.choice(letters, n)) for n in rng.integers(0, 300, 300)] + [None, "", "..."]
    for chunk in (64, 1 << 20):
        monkeypatch.setattr(words, "CHUNK", chunk)
        hashes, bounds = word_hashes(texts)
        known, back = {}, {}
        for k, t in enumerate(texts):
            want = re.findall(r"[a-z0-9é]+", (t or "").lower())
            got = hashes[bounds[k] : bounds[k + 1]].tolist()
            assert len(want) == len(got)
            for w, h in zip(want, got, strict=True):
                assert known.setdefault(w, h) == h and back.setdefault(h, w) == w


def test_shingles():
    hashes, bounds = word_hashes(["a b c d e f a b c d e", "x y", "", "y x"])
    s = shingles(hashes, bounds)
    assert [len(x) for x in s] == [7, 1, 0, 1]
    assert s[0][0] == s[0][6] and len(set(s[0].tolist())) == 6 and s[1][0] != s[3][0]
