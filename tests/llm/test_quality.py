import re
from collections import Counter

import numpy as np

from branchwise.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of rows (doc_id, text, lang, source)."""
    found, groups = [], {}
    for doc, text, lang, source in rows:
        t = text or ""
        words, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        often = Counter(grams)
        held = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
        m = [len(words), len("".join(words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(held)]
        failed = m[0] < 10 or 100 * m[4] > 20 * m[0]
        ratios = (m[2] / max(1, m[0]), m[3] / max(1, len(lines)))
        found.append((doc, *m, failed, (lang, source), ratios))
        if m[0] >= 10:
            groups.setdefault((lang, source), []).append(ratios)
    limit = {}
    for g, r in groups.items():
        q = np.quantile(np.array(r), [0.25, 0.75], axis=0, method="inverted_cdf")
        limit[g] = q[1] + 3 * np.maximum(q[1] - q[0], [0.05, 0.2])
    return sorted(((*f[:7], not f[6] and bool((np.array(f[8]) <= limit[f[7]]).all())) for f in found), key=str)


OUT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def test_odd_rows(spark, odd_docs):
    want = brute([(r.doc_id, r.text, r.lang, r.source) for r in odd_docs.collect()])
    assert sorted(map(tuple, quality.judge(odd_docs).select(*OUT).collect()), key=str) == want
    assert sorted(map(tuple, quality.verdicts(odd_docs, "doc_id").select(*OUT).collect()), key=str) == want
    assert quality.judge(odd_docs.limit(0)).count() == quality.verdicts(odd_docs.limit(0), "doc_id").count() == 0


def test_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()])
    assert sorted(map(tuple, quality.verdicts(docs, "doc_id").select(*OUT).collect()), key=str) == want
    assert [r[0] for r in want if r[7]] and [r[0] for r in want if not r[7]]


def test_filter_does_not_copy_the_tokenizer(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for condition in ("kept", "NOT kept", "base_failed"):
        plan = quality.judge(docs).where(condition).select(docs.columns)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all") <= 4 and len(plan) < 10_000
