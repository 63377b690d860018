import pytest

from branchwise.llm import tokencount as tc


def brute(text, rule, spans=None):
    """Tokens of each section by a loop over tokens and characters."""
    encoding, _ = tc.encoder(tc.TOKENIZERS)
    if spans is None:
        lines = text.split("\n")
        at = [sum(len(x) + 1 for x in lines[:k]) for k in range(len(lines) + 1)]
        spans = [(a, min(b, len(text))) for a, b in zip(at, at[1:])]
    owner = {b: k for k, c in enumerate(text) for b in range(len(text[:k].encode()), len(text[:k].encode()) + len(c.encode()))}
    counts, byte = [0] * (len(spans) + 1), 0
    for token in encoding.encode_ordinary(text):
        n = len(encoding.decode_single_token_bytes(token))
        chars = sorted({owner[b] for b in range(byte, byte + n)})
        byte += n
        inside = [sum(a <= c < z for c in chars) for a, z in spans]
        if rule == "start":
            k = next((i for i, (a, z) in enumerate(spans) if a <= chars[0] < z), -1)
        else:
            k = inside.index(max(inside)) if inside and max(inside) else -1
        counts[k] += 1
    return spans, counts


TEXTS = ["", "\n", "a\n\nb  \n c", "  \n\n\n  tail", "né\nü ö\r\nemoji 🙂🙂 line\n", "word " * 30 + "\n" * 5 + "end", None]


@pytest.mark.parametrize("rule", ["majority", "start"])
def test_against_brute_force(spark, rule):
    rows = [(k, t) for k, t in enumerate(TEXTS)]
    rows += [(100 + r[0], r[1][:1500]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(12).collect()]
    got = tc.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), rule).collect()
    for k, t in rows:
        spans, counts = brute(t or "", rule)
        mine = sorted((r.section, r.start_char, r.end_char, r.n_tokens) for r in got if r.doc_id == k)
        assert mine == [(i, a, z, c) for i, ((a, z), c) in enumerate(zip(spans, counts))], (k, t)
        assert sum(counts) == len(tc.encoder(tc.TOKENIZERS)[0].encode_ordinary(t or ""))


def test_given_sections(spark):
    text, spans = "alpha beta gamma delta", [(2, 8), (8, 9), (13, 20)]
    frame = spark.createDataFrame([(1, text, [{"start": a, "end": z} for a, z in spans]), (2, text, None)], "doc_id long, text string, parts array<struct<start:long,end:long>>")
    for rule in ("majority", "start"):
        got = {(r.doc_id, r.section): r.n_tokens for r in tc.count_tokens(frame, rule, sections="parts").collect()}
        counts = brute(text, rule, spans)[1]
        assert got == {(1, -1): counts[-1], **{(1, k): c for k, c in enumerate(counts[:-1])}, (2, -1): sum(counts)}


def test_odd_rows(spark, odd_docs):
    clash = odd_docs.selectExpr("*", "'x' AS sections", "'x' AS section")
    got = tc.count_tokens(clash).collect()
    assert sum(r.doc_id is None for r in got) == 2 and sum(r.doc_id == 1 for r in got) == 2
    assert tc.count_tokens(clash.limit(0)).count() == 0
