"""A deterministic, sharded WARC writer, and its reader.

Range bounds come from an exact histogram of ids weighted by bytes, so equal
tables give equal files whatever the partitioning was. Each task sorts its
ranges, regenerates headers and digests, writes one gzip member a record and
rolls to the next file when the compressed size reaches the limit. A file is
written under a temporary name and moved when whole; a task that runs again
makes the same bytes. The manifest, of a row a file, comes last.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from branchwise.llm.common import need, shared_dir, table, written

BUCKETS = 8192
#: The form of a record; fixed by the WARC format.
VERSION, EOL = b"WARC/1.0\r\n", b"\r\n"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
FILES = "file string, shard int, records long, bytes long, sha256 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string"


def _shards(rows: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """rows with _shard, in order of page_id; and how many shards there are.

    Equal-width buckets of ids are gathered to ranges of about shard_bytes. A
    bucket above that is cut in equal sub-ranges or, if it holds one id only,
    by a hash of the row. Null ids come first. The histogram has 8192 rows at
    most, whatever the table's size.
    """
    spark = rows.sparkSession
    low, high = rows.agg(F.min("page_id"), F.max("page_id")).first()
    low, high = (0, 0) if low is None else (low, high)
    width = (high - low) // BUCKETS + 1
    bucket = F.coalesce(F.floor((F.col("page_id").cast("decimal(20,0)") - F.lit(low)) / F.lit(width)), F.lit(-1)).cast("int")
    found = sorted(rows.groupBy(bucket.alias("b")).agg(F.sum(F.octet_length("payload") + F.lit(400)).alias("n")).collect())
    placed, shard, held = [], 0, 0
    for b, n in found:
        if held and held + n > shard_bytes:
            shard, held = shard + 1, 0
        cuts = max(1, -(-n // shard_bytes))
        placed.append((b, shard, cuts, low + b * width, max(1, -(-width // cuts)), bool(b < 0 or width < cuts)))
        held += n
        if cuts > 1:
            shard, held = shard + cuts, 0
    places = spark.createDataFrame(placed, "_b int, _first int, _cuts int, _low long, _step long, _mixed boolean")
    within = F.when(F.col("_mixed"), F.pmod(F.xxhash64("sha", "url"), F.col("_cuts"))).otherwise(F.least(F.floor((F.col("page_id") - F.col("_low")) / F.col("_step")), F.col("_cuts") - 1))
    out = rows.withColumn("_b", bucket).join(F.broadcast(places), "_b").withColumn("_shard", (F.col("_first") + F.coalesce(within, F.lit(0))).cast("int"))
    return out.drop("_b", "_first", "_cuts", "_low", "_step", "_mixed"), max(1, shard + 1)


def record_bytes(page_id, url: str | None, payload: bytes, refers_to, date: str = DATE) -> bytes:
    """One record, headers and digests made anew from the payload."""
    sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    revisit = refers_to is not None
    body = b"" if revisit else payload
    name = lambda i: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{i}/{sha1}')}>"
    lines = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name(page_id)), ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")), ("WARC-Payload-Digest", f"sha1:{sha1}"),
        ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(body).digest()).decode()}"),
        ("WARC-Refers-To", name(refers_to) if revisit else None), ("WARC-Profile", PROFILE if revisit else None),
        ("X-Page-ID", None if page_id is None else str(page_id)), ("X-Refers-To-Page-ID", str(refers_to) if revisit else None), ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body))),
    ]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None).encode() + EOL + body + EOL + EOL


class _Roller:
    """The open archive of one shard."""

    def __init__(self, root: str, limit: int, level: int):
        self.fs, self.root = arrow_fs.FileSystem.from_uri(root)
        self.limit, self.level, self.shard, self.seq, self.out = limit, level, None, 0, None

    def add(self, shard: int, record: bytes) -> Iterator[tuple]:
        if self.out and (shard != self.shard or self.size >= self.limit):
            yield self.close()
        if shard != self.shard:
            self.shard, self.seq = shard, 0
        if not self.out:
            self.name, self.temporary = f"part-{shard:06d}-{self.seq:05d}.warc.gz", f"{self.root}/tmp/{uuid.uuid4().hex}"
            self.out, self.size, self.records, self.sha = self.fs.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
            self.seq += 1
        member = gzip.compress(record, self.level, mtime=0)
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.records += 1

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        final = f"{self.root}/archives/{self.name}"
        if self.fs.get_file_info(final).type != arrow_fs.FileType.NotFound:
            self.fs.delete_file(final)  # an earlier try of this task; the bytes are the same
        self.fs.move(self.temporary, final)
        return self.name, self.shard, self.records, self.size, self.sha.hexdigest()


def write_warc(pages: DataFrame, root: str, roll_bytes: int = 1 << 30, shard_bytes: int = 4 << 30, revisit_from: int = 0, level: int = 6) -> dict:
    """Archives of pages (page_id, url, html) under root; returns the manifest.

    A null html is an empty payload. Of records with equal payloads of at least
    revisit_from bytes, those with the smallest page_id are responses (several
    if that id is repeated) and the others revisits of it; a group without any
    id is all responses, and a row without an id revisits. Other columns are
    ignored. An empty table makes a manifest without files.
    """
    rows = need(pages, "page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("long"))
    rows = rows.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).withColumn("sha", F.unhex(F.sha2("payload", 256)))  # SHA-1, of the headers, collides
    first = rows.where(F.octet_length("payload") >= revisit_from).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = written(first, "repeated")  # its size is known then: small, it is broadcast and payloads move once
    rows = rows.join(first, "sha", "left").withColumn("refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))).drop("first")
    rows, shards = _shards(rows, shard_bytes)
    spark = pages.sparkSession
    filesystem, base = arrow_fs.FileSystem.from_uri(root)
    for name in ("tmp", "archives"):
        filesystem.create_dir(f"{base}/{name}")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roller = _Roller(root, roll_bytes, level)
        columns = [x.split()[0] for x in FILES.split(", ")]
        for frame in frames:
            done = []
            for shard, page_id, url, payload, refers in zip(*[frame[c] for c in ("_shard", "page_id", "url", "payload", "refers_to")], strict=True):
                done += roller.add(int(shard), record_bytes(None if pd.isna(page_id) else int(page_id), url, bytes(payload), None if pd.isna(refers) else int(refers)))
            if done:
                yield pd.DataFrame(done, columns=columns)
        if roller.out:
            yield pd.DataFrame([roller.close()], columns=columns)

    dealt = rows.repartitionByRange(shards, "_shard").sortWithinPartitions("_shard", "page_id", "sha", "url")
    # One row a file: as many as the archives' bytes over roll_bytes, and one for each shard.
    # Ids go as strings: pandas would turn longs with nulls into floats.
    made = dealt.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")}).mapInPandas(write, FILES).collect()
    manifest = {"format": "warc", "date": DATE, "roll_bytes": roll_bytes, "shard_bytes": shard_bytes, "files": sorted((r.asDict() for r in made), key=lambda r: r["file"])}
    with filesystem.open_output_stream(f"{base}/tmp/manifest") as out:
        out.write(json.dumps(manifest, indent=1, sort_keys=True).encode())
    filesystem.move(f"{base}/tmp/manifest", f"{base}/manifest.json")
    filesystem.delete_dir(f"{base}/tmp")
    return manifest


def parse(stream) -> Iterator[tuple[dict, bytes]]:
    """Headers and body of each record of an uncompressed stream, which is read in order."""
    while line := stream.readline():
        if line != VERSION:
            raise ValueError(f"not a record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (EOL, b""):
            k, _, v = line.decode().rstrip("\r\n").partition(": ")
            headers[k] = v
        body = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != EOL + EOL:
            raise ValueError(f"no end: {headers}")
        yield headers, body


def read_warc(spark: SparkSession, root: str) -> DataFrame:
    """A row a record of the archives that the manifest lists; digests are checked."""
    filesystem, base = arrow_fs.FileSystem.from_uri(root)
    with filesystem.open_input_stream(f"{base}/manifest.json") as f:
        names = [x["file"] for x in json.loads(f.read())["files"]]
    files = spark.createDataFrame([(x,) for x in names], "file string").repartition(max(1, len(names)))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = arrow_fs.FileSystem.from_uri(root)
        columns = [x.split()[0] for x in RECORDS.split(", ")]
        whole = lambda rows: pd.DataFrame(rows, columns=columns).astype({"page_id": "Int64", "refers_to": "Int64"})
        for frame in frames:
            for file in frame["file"]:
                rows = []
                with filesystem.open_input_stream(f"{base}/archives/{file}", compression=None) as raw, gzip.GzipFile(fileobj=io.BufferedReader(raw, 1 << 20)) as plain:
                    for h, body in parse(plain):
                        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        own = base64.b32encode(hashlib.sha1(body).digest()).decode()
                        if h["WARC-Block-Digest"] != f"sha1:{own}" or h["WARC-Type"] == "response" and digest != own:
                            raise ValueError(f"{file}: digest of {h['WARC-Record-ID']}")
                        number = lambda k, h=h: int(h[k]) if k in h else None
                        rows.append((number("X-Page-ID"), h.get("WARC-Target-URI"), int(h["X-Payload-Length"]), digest, h["WARC-Type"], number("X-Refers-To-Page-ID"), file))
                        if len(rows) == 5000:
                            yield whole(rows)
                            rows = []
                if rows:
                    yield whole(rows)

    return files.mapInPandas(read, RECORDS)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), root, roll_bytes=16 << 20, shard_bytes=32 << 20)
    return read_warc(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "file")
