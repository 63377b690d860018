import base64
import gzip
import hashlib
import io
import json

from branchwise.llm import warc

PAGES = "page_id long, url string, html string"
ODD = [(5, "http://a/", "same"), (3, "http://b/", "same"), (3, "http://b/", "same"), (None, None, "same"), (7, None, None), (8, "x\r\ny", ""), (9, "u", "é" * 70_000), (None, "n", "lone"), (None, "n", "lone"), (2**60, "u", "big id")]


def expected(rows, least=0):
    """(page_id, bytes, digest, type, refers_to) of each row, sorted."""
    first = {}
    for i, _, html in rows:
        p = (html or "").encode()
        if i is not None and len(p) >= least:
            first[p] = min(i, first.get(p, i))
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        to = first.get(p)
        to = to if to is not None and i != to and sum((h or "").encode() == p for _, _, h in rows) > 1 else None
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if to is not None else "response", to))
    return sorted(out, key=str)


def result(spark, rows, tmp_path, **how):
    frame = spark.createDataFrame(rows, PAGES)
    warc.write_warc(frame.selectExpr("*", "'x' AS sha", "'x' AS first", "'x' AS payload"), f"file://{tmp_path}", **how)
    got = warc.read_warc(spark, f"file://{tmp_path}").collect()
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str)


def test_odd_rows(spark, tmp_path):
    assert result(spark, ODD, tmp_path / "a") == expected(ODD)
    assert result(spark, ODD, tmp_path / "b", revisit_from=5) == expected(ODD, 5)
    assert result(spark, [], tmp_path / "c") == []


def test_whole_table_and_payloads(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").collect()]
    assert result(spark, rows, tmp_path, roll_bytes=4000, shard_bytes=20_000) == expected(rows)
    files = json.loads((tmp_path / "manifest.json").read_text())["files"]
    assert len(files) > 3 and sum(f["records"] for f in files) == len(rows)
    want, held = {r[0]: (r[2] or "").encode() for r in rows}, {}
    for f in files:
        raw = (tmp_path / "archives" / f["file"]).read_bytes()
        assert hashlib.sha256(raw).hexdigest() == f["sha256"] and len(raw) == f["bytes"]
        for h, body in warc.parse(io.BytesIO(gzip.decompress(raw))):
            if h["WARC-Type"] == "response":
                held[int(h["X-Page-ID"])] = body
    assert held == {k: want[k] for k in held}


def test_files_do_not_depend_on_partitions(spark, tmp_path):
    frame = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    a = warc.write_warc(frame.repartition(7), f"file://{tmp_path}/a", roll_bytes=4000, shard_bytes=20_000)
    assert a == warc.write_warc(frame.coalesce(1), f"file://{tmp_path}/b", roll_bytes=4000, shard_bytes=20_000)
