import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyarrow import fs as arrow_fs
from pyspark.sql import functions as F

from branchwise.llm import bpe, rans

WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "it's DON'T we'll 'SUN <|endoftext|>x a<|startoftext|> b\x01c \x1c x\x1fy é̀ ΑΣ Σ. ـ١٢٣ x y z w 𝔘 ﬁ ̈a İstanbul ''s 's't", "a\x0bb\x0cc\rd\te",
    "日本語 テスト ½ ² Ⅷ‍́ 힣ﾠ É́ ǅ ĲĿ ª² ¼x", "x" * 5000 + " " + "9" * 300 + "!" * 300 + " _a_b_ À \x85 q\x85r",
]


def whole(texts):
    return [[*e.ids, rans.END] for e in bpe.encoder(WORDS).library.encode_batch_fast(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_whole_texts(spark, name):
    coder = bpe.Encoder(public_tokenizers.path(name))
    assert bool(coder.pattern) == name.startswith("word")
    texts = ODD + [r[0] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    want = [[*e.ids, 1] for e in coder.library.encode_batch_fast(texts, add_special_tokens=False)]
    for cut in (1, 7, len(texts)):  # met words are taken from the table
        ids, lengths = zip(*[coder(pa.array(texts[k : k + cut]), 1) for k in range(0, len(texts), cut)], strict=True)
        assert np.concatenate(ids).tolist() == [i for x in want for i in x] and np.concatenate(lengths).tolist() == [len(x) for x in want]


def test_words_kept_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_KEPT", 50)
    coder = bpe.Encoder(WORDS)
    for k in range(40):
        coder(pa.array([" ".join(f"w{k}x{i}" for i in range(30))]), 1)
        assert len(coder.words.number) <= 50 + 31 and len(coder.pieces.number) <= 50 + 61


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, rans.BLOCK - 1, rans.BLOCK, rans.BLOCK + 1, 3 * rans.BLOCK + 77])
@pytest.mark.parametrize("kind", ["one", "two", "zipf", "flat"])
def test_coder_round_trip(n, kind):
    rng = np.random.default_rng(n)
    ids = {"one": np.full(n, 5), "two": rng.choice([0, 999], n, p=[0.999, 0.001]), "zipf": np.minimum(rng.zipf(1.3, n), 999), "flat": rng.integers(0, 1000, n)}[kind].astype(np.int64)
    seen, counts = np.unique(ids, return_counts=True)
    model = rans.Model.from_bytes(rans.Model(seen, counts, 1000).to_bytes())
    blocks = rans.encode(ids, model)
    assert (rans.decode(blocks, model, model.slots()) == ids).all()
    for k, block in enumerate(blocks):  # each by itself
        assert (rans.decode([block], model, model.slots()) == ids[k * rans.BLOCK : (k + 1) * rans.BLOCK]).all()
    if n > rans.BLOCK:
        p = counts / n
        assert sum(len(b) for _, b in blocks) <= -(p * np.log2(p)).sum() * n / 8 * 1.01 + len(blocks) * (8 * rans.LANES + 64)
        broken = [(blocks[0][0], blocks[0][1][:40] + bytes([blocks[0][1][40] ^ 1]) + blocks[0][1][41:]), *blocks[1:]]
        with pytest.raises(ValueError, match="end"):
            rans.decode(broken, model, model.slots())


def test_table_sums_to_its_power():
    for counts in ([1], [1] * 40_000, [10**12, *[1] * 30_000], list(range(1, 5000))):
        scaled = rans._scaled(np.array(counts), 1 << 20)
        assert scaled.sum() == 1 << 20 and scaled.min() >= 1


def brute(rows):
    start, out = 0, []
    for i, ids in rows:
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.orderBy("doc_id").select("doc_id", "text").collect()
    want = brute(zip([r[0] for r in rows], whole([r[1] or "" for r in rows]), strict=True))
    assert [tuple(r) for r in rans.op11_rans_ids(spark, "/root/testdata/sf0.01").orderBy("start").collect()] == want
    manifest = rans.write_ids(docs.repartition(3), f"file://{tmp_path}", WORDS)
    assert sum(f["docs"] for f in manifest["files"]) == len(rows) and sum(f["ids"] for f in manifest["files"]) == sum(w[2] for w in want)
    assert sorted(p.name for p in (tmp_path / "files").iterdir()) == [f["file"] for f in manifest["files"]] and not (tmp_path / "tmp").exists()
    again = tmp_path / "again"
    again.mkdir()
    assert rans.write_ids(docs.repartition(3), f"file://{again}", WORDS) == manifest  # files are a function of the table
    # One segment by its checkpoint alone.
    local = arrow_fs.LocalFileSystem()
    first = manifest["files"][0]
    model = rans.Model.from_bytes((tmp_path / "table.bin").read_bytes())
    place = rans.checkpoints(local, f"{tmp_path}/files/{first['file']}")[-1]
    ids, _, lengths, tokens = rans.read_segment(local, f"{tmp_path}/files/{first['file']}", place, model, model.slots())
    assert ids.tolist() == [w[0] for w in want][first["docs"] - place["docs"] : first["docs"]] and lengths.sum() == len(tokens) == place["ids"]
    # Damage is seen.
    path = tmp_path / "files" / first["file"]
    raw = bytearray(path.read_bytes())
    raw[len(raw) // 2] ^= 1
    path.write_bytes(raw)
    with pytest.raises(Exception, match="damaged"):
        rans.read_ids(spark, f"file://{tmp_path}").collect()


def test_odd_rows(spark, odd_docs, tmp_path):
    clash = odd_docs.withColumns({c: F.lit("x") for c in ("tie", "part", "seq", "start")})
    rows = [(r.doc_id, r.text) for r in clash.collect()]
    rans.write_ids(clash, f"file://{tmp_path}", WORDS)
    got = rans.read_ids(spark, f"file://{tmp_path}").orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    ids = whole([t or "" for _, t in rows])
    assert sorted(str((r.doc_id, r.n_tokens, r.ids_crc32)) for r in got) == sorted(str((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))) for (i, _), x in zip(rows, ids, strict=True))
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    empty = tmp_path / "empty"
    empty.mkdir()
    assert rans.write_ids(clash.limit(0), f"file://{empty}", WORDS)["files"] == [] and rans.read_ids(spark, f"file://{empty}").count() == 0
    assert json.loads((tmp_path / "manifest.json").read_text())["format"] == "rans"
