"""Token ids in files of interleaved range asymmetric numeral systems under one static frequency table.

One pass encodes the texts in order of doc_id to segments of about a million
ids and counts these; the counts are added up and scaled to a power of two, and that table
is shared by all files. A segment is coded as blocks of BLOCK ids, each over
LANES states that take turns, in 64 bits with 32-bit renormalization, so that a
block can be decoded by itself, and all blocks of a segment at a time. A file is

    MAGIC, segments, footer (JSON), length and CRC-32 of the footer, MAGIC

and a segment its compressed document index (ids, nulls, lengths) and, for each
block, lane states and words. The footer is a list of checkpoints: of each
segment its place, documents and ids, and of each block its place, ids and
CRC-32. Files are written under temporary names and moved when whole; a
manifest with the files in order, their ids and the table's CRC-32 comes last.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from branchwise.llm import bpe
from branchwise.llm.common import frugal, need, shared_dir, spent, table, written

MAGIC = b"BWRANS1\n"
BLOCK, LANES, SEGMENT = 1 << 16, 128, 1 << 20
#: The least state of a lane.
LOW = 1 << 31
#: Bits of the scaled frequencies' sum: at least so many, and so many above those that number the distinct ids.
LEAST_BITS, SPARE_BITS = 20, 4
#: Bytes of text that are encoded at once.
STEP = 6 << 20
END = 1
SEGMENTS = "part int, seq int, n_docs long, n_ids long, doc_ids binary, nulls binary, lengths binary, ids binary, counts binary"
FILES = "file string, n_docs long, n_ids long, bytes long"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"
_TAIL = struct.Struct("<QI")


class Model:
    """The table that all files share."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, size: int):
        self.bits = max(LEAST_BITS, max(len(ids) - 1, 1).bit_length() + SPARE_BITS)
        if self.bits > 30:
            raise ValueError(f"{len(ids)} distinct ids are too many")
        self.ids, self.scaled = np.asarray(ids, np.int64), _scaled(np.asarray(counts, np.int64), 1 << self.bits)
        self.freq, self.below = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq[self.ids] = self.scaled
        self.below[self.ids] = np.cumsum(self.scaled) - self.scaled
        self.common = int(self.ids[np.argmax(self.scaled)]) if len(self.ids) else 0

    def to_bytes(self) -> bytes:
        head = struct.pack("<QQ", len(self.ids), len(self.freq))
        body = head + self.ids.astype("<u4").tobytes() + self.scaled.astype("<u4").tobytes()
        return MAGIC + body + struct.pack("<I", zlib.crc32(body))

    @classmethod
    def from_bytes(cls, raw: bytes) -> Model:
        body = raw[len(MAGIC) : -4]
        if raw[: len(MAGIC)] != MAGIC or zlib.crc32(body) != struct.unpack("<I", raw[-4:])[0]:
            raise ValueError("the frequency table is damaged")
        n, size = struct.unpack("<QQ", body[:16])
        numbers = np.frombuffer(body[16:], "<u4").astype(np.int64)
        return cls(numbers[:n], numbers[n:], size)  # what is scaled already stays as it is

    def slots(self) -> np.ndarray:
        return np.repeat(self.ids, self.scaled)


def _scaled(counts: np.ndarray, total: int) -> np.ndarray:
    """Counts in proportion, each at least 1, that sum to `total`."""
    if not len(counts):
        return counts
    if counts.sum() == total:
        return counts
    out = np.maximum(1, (counts / counts.sum() * total).astype(np.int64))
    while (over := int(out.sum()) - total) > 0:
        k = int(np.argmax(out))
        out[k] -= min(over, max(1, out[k] // 2))
    out[int(np.argmax(out))] -= over
    return out


def encode(ids: np.ndarray, model: Model) -> list[tuple[int, bytes]]:
    """(ids in it, bytes) of each block; the last may be short."""
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return []
    last = len(ids) - (blocks - 1) * BLOCK
    steps, short = BLOCK // LANES if blocks > 1 else -(-last // LANES), -(-last // LANES)
    grid = np.full((blocks, steps * LANES), model.common, np.int64)  # the last step is filled up
    grid.reshape(-1)[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(blocks, steps, LANES).transpose(1, 0, 2))
    state, bits = np.full((blocks, LANES), LOW, np.uint64), np.uint64(model.bits)
    sent, words = np.zeros(grid.shape, bool), np.zeros(grid.shape, np.uint32)
    for s in range(steps - 1, -1, -1):
        n = blocks if s < short else blocks - 1
        freq, x = model.freq[grid[s, :n]], state[:n]
        full = x >= freq << np.uint64(63 - model.bits)
        sent[s, :n], words[s, :n] = full, x.astype(np.uint32)
        x = np.where(full, x >> np.uint64(32), x)
        q = x // freq
        state[:n] = (q << bits) + (x - q * freq) + model.below[grid[s, :n]]
    out = []
    for b in range(blocks):
        out.append((BLOCK if b < blocks - 1 else last, state[b].astype("<u8").tobytes() + words[:, b][sent[:, b]].astype("<u4").tobytes()))
    return out


def decode(blocks: list[tuple[int, bytes]], model: Model, slots: np.ndarray) -> np.ndarray:
    """The ids of blocks of one segment, or of one block; all but the last are full."""
    if not blocks:
        return np.empty(0, np.int64)
    states = [np.frombuffer(raw[: 8 * LANES], "<u8") for _, raw in blocks]
    words = [np.frombuffer(raw[8 * LANES :], "<u4") for _, raw in blocks]
    begins = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    stream, at, state = np.concatenate([*words, np.zeros(1, np.uint32)]).astype(np.uint64), begins[:-1].copy(), np.stack(states).astype(np.uint64)
    counts = [-(-n // LANES) for n, _ in blocks]
    steps, mask, bits = counts[0], np.uint64((1 << model.bits) - 1), np.uint64(model.bits)
    out = np.zeros((steps, len(blocks), LANES), np.int64)
    for s in range(steps):
        n = len(blocks) if s < counts[-1] else len(blocks) - 1
        x = state[:n]
        slot = x & mask
        found = slots[slot.astype(np.int64)]
        x = model.freq[found] * (x >> bits) + slot - model.below[found]
        empty = x < LOW
        turn = np.cumsum(empty, 1)
        word = stream[np.minimum(at[:n, None] + turn - 1, len(stream) - 1)]
        state[:n] = np.where(empty, x << np.uint64(32) | word, x)
        at[:n] += turn[:, -1]
        out[s, :n] = found
    if (state != LOW).any() or (at != begins[1:]).any():
        raise ValueError("a block does not end where its coding began")
    return np.concatenate([out[:, b].reshape(-1)[:n] for b, (n, _) in enumerate(blocks)])


class _File:
    """A file that is being written."""

    def __init__(self, root: str, name: str):
        self.fs, self.base = arrow_fs.FileSystem.from_uri(root)
        self.name, self.temporary, self.size, self.segments = name, f"{self.base}/tmp/{uuid.uuid4().hex}", 0, []
        self.out = self.fs.open_output_stream(self.temporary, compression=None)
        self._put(MAGIC)

    def _put(self, raw: bytes) -> int:
        self.out.write(raw)
        self.size += len(raw)
        return self.size - len(raw)

    def add(self, docs: int, index: bytes, blocks: list[tuple[int, bytes]]) -> None:
        place = {"at": self._put(index), "index": len(index), "index_crc32": zlib.crc32(index), "docs": docs, "ids": sum(n for n, _ in blocks), "blocks": []}
        for n, raw in blocks:
            place["blocks"].append([self._put(raw), len(raw), n, zlib.crc32(raw)])
        self.segments.append(place)

    def close(self) -> tuple[str, int, int, int]:
        footer = json.dumps({"segments": self.segments, "block": BLOCK, "lanes": LANES}).encode()
        self._put(footer + _TAIL.pack(len(footer), zlib.crc32(footer)) + MAGIC)
        self.out.close()
        final = f"{self.base}/files/{self.name}"
        if self.fs.get_file_info(final).type != arrow_fs.FileType.NotFound:
            self.fs.delete_file(final)  # of an earlier try of this task; the bytes are the same
        self.fs.move(self.temporary, final)
        return self.name, sum(s["docs"] for s in self.segments), sum(s["ids"] for s in self.segments), self.size


def checkpoints(filesystem: arrow_fs.FileSystem, path: str) -> list[dict]:
    """The footer's segments, each with the documents and ids before it in the file."""
    with filesystem.open_input_file(path) as f:
        size = f.size()
        f.seek(size - _TAIL.size - len(MAGIC))
        tail = f.read(_TAIL.size + len(MAGIC))
        length, crc = _TAIL.unpack(tail[: _TAIL.size])
        if tail[_TAIL.size :] != MAGIC:
            raise ValueError(f"{path} has no end")
        f.seek(size - _TAIL.size - len(MAGIC) - length)
        footer = f.read(length)
    if zlib.crc32(footer) != crc:
        raise ValueError(f"{path}: the footer is damaged")
    said = json.loads(footer)
    if (said["block"], said["lanes"]) != (BLOCK, LANES):
        raise ValueError(f"{path} has blocks of another shape")
    before = 0
    for s in said["segments"]:
        s["before"] = before
        before += s["ids"]
    return said["segments"]


def read_segment(filesystem: arrow_fs.FileSystem, path: str, place: dict, model: Model, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, nulls, lengths and ids of a segment; all checksums are compared."""
    last = place["blocks"][-1] if place["blocks"] else [place["at"], place["index"]]
    with filesystem.open_input_file(path) as f:
        f.seek(place["at"])
        raw = f.read(last[0] + last[1] - place["at"])
    index = raw[: place["index"]]
    blocks = [(n, raw[at - place["at"] : at - place["at"] + size]) for at, size, n, _ in place["blocks"]]
    if zlib.crc32(index) != place["index_crc32"] or any(zlib.crc32(b) != p[3] for (_, b), p in zip(blocks, place["blocks"], strict=True)):
        raise ValueError(f"{path}: a segment is damaged")
    plain, n = zlib.decompress(index), place["docs"]
    ids = decode(blocks, model, slots)
    return np.frombuffer(plain[: 8 * n], "<i8"), np.frombuffer(plain[8 * n : 9 * n], np.uint8).astype(bool), np.frombuffer(plain[9 * n :], "<i8"), ids


def _segments(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The ids of texts in order of doc_id, a segment a row (SEGMENTS); repeated ids go by a hash of the text."""
    schema = pa.schema([(f.split()[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in SEGMENTS.split(", ")])

    def make(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, part, seq, held = bpe.encoder(tokenizer), TaskContext.get().partitionId(), 0, []
        kind = "<u2" if coder.size <= 1 << 16 else "<u4"

        def take() -> pa.RecordBatch:
            doc_ids, lengths, ids = pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            row = (part, seq, len(doc_ids), len(ids), doc_ids.fill_null(0).to_numpy().astype("<i8").tobytes(), doc_ids.is_null().to_numpy(zero_copy_only=False).tobytes(), lengths.astype("<i8").tobytes(), ids.astype(kind).tobytes(), np.bincount(ids, minlength=coder.size).astype("<i8").tobytes())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for frame in frames:
            texts = frame.column(1).fill_null("")
            steps = np.cumsum(pc.binary_length(texts).to_numpy()) // STEP
            for k in np.unique(steps):
                a, b = np.searchsorted(steps, [k, k + 1]).tolist()
                ids, lengths = coder(texts[a:b], END)
                held.append((frame.column(0)[a:b], lengths, ids))
                if sum(len(h[2]) for h in held) >= SEGMENT:
                    yield take()
                    seq += 1
        if held:
            yield take()

    rows = need(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("tie", F.xxhash64("text"))
    return rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text").mapInArrow(frugal(make), SEGMENTS)


def _counts(segments: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and how often each occurs: as many rows as the vocabulary has at most."""

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size, np.int64)
        for frame in frames:
            for raw in frame.column(0):
                out += np.frombuffer(raw.as_py(), "<i8")
        seen = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(out[seen])], ["id", "n"])

    found = sorted(tuple(r) for r in segments.select("counts").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n")).collect())
    return np.array([x for x, _ in found], np.int64), np.array([x for _, x in found], np.int64)


def write_ids(docs: DataFrame, root: str, tokenizer: str) -> dict:
    """Files of docs' ids under root, the table and the manifest, which is returned.

    doc_id may be null (these rows come first) or repeated; a null text is
    empty and has the end id only; other columns are ignored; an empty table
    makes a manifest without files. `tokenizer` is a file that every worker can read.
    """
    spark, size = docs.sparkSession, bpe.encoder(tokenizer).size
    segments = written(_segments(docs, tokenizer), "segments")
    model = Model(*_counts(segments, size), size)
    filesystem, base = arrow_fs.FileSystem.from_uri(root)
    for name in ("tmp", "files"):
        filesystem.create_dir(f"{base}/{name}")
    with filesystem.open_output_stream(f"{base}/table.bin") as out:
        out.write(model.to_bytes())
    shared = spark.sparkContext.broadcast(model)  # bounded by the vocabulary
    kind = "<u2" if size <= 1 << 16 else "<u4"

    def write(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, last, done = None, None, []
        for frame in frames:
            for part, seq, n, _, doc_ids, nulls, lengths, ids in zip(*[c.to_pylist() for c in frame.columns], strict=True):
                if out and last != (part, seq - 1):  # a split of the input may hold parts that do not follow each other
                    done.append(out.close())
                    out = None
                out, last = out or _File(root, f"ids-{part:06d}-{seq:06d}.rans"), (part, seq)
                out.add(n, zlib.compress(doc_ids + nulls + lengths, 1), encode(np.frombuffer(ids, kind).astype(np.int64), shared.value))
        if out:
            done.append(out.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["file", "n_docs", "n_ids", "bytes"])

    files = sorted(tuple(r) for r in segments.drop("counts").mapInArrow(frugal(write), FILES).collect())  # a row a file
    spent(segments)
    starts = np.cumsum([0, *[n for _, _, n, _ in files]]).tolist()
    manifest = {"format": "rans", "table_crc32": zlib.crc32(model.to_bytes()), "files": [{"file": f, "docs": d, "ids": n, "bytes": b, "start": s} for (f, d, n, b), s in zip(files, starts, strict=False)]}
    with filesystem.open_output_stream(f"{base}/tmp/manifest") as out:
        out.write(json.dumps(manifest, indent=1, sort_keys=True).encode())
    filesystem.move(f"{base}/tmp/manifest", f"{base}/manifest.json")
    filesystem.delete_dir(f"{base}/tmp")
    return manifest


def read_ids(spark: SparkSession, root: str) -> DataFrame:
    """A row a document (RESULT) from the files that the manifest lists; each segment is decoded from its checkpoint."""
    filesystem, base = arrow_fs.FileSystem.from_uri(root)
    with filesystem.open_input_stream(f"{base}/manifest.json") as f:
        manifest = json.loads(f.read())
    with filesystem.open_input_stream(f"{base}/table.bin") as f:
        raw = f.read()
    if zlib.crc32(raw) != manifest["table_crc32"]:
        raise ValueError("the frequency table is not the manifest's")
    model = Model.from_bytes(raw)
    shared = spark.sparkContext.broadcast((model, model.slots().astype(np.int32)))
    files = spark.createDataFrame([(x["file"], x["start"]) for x in manifest["files"]], "file string, start long").repartition(max(1, len(manifest["files"])))

    def plan(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = arrow_fs.FileSystem.from_uri(root)
        for frame in frames:
            for name, start in zip(*[c.to_pylist() for c in frame.columns], strict=True):
                places = checkpoints(filesystem, f"{base}/files/{name}")
                if places:
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(places)), pa.array([start + p["before"] for p in places]), pa.array([json.dumps(p) for p in places])], ["file", "start", "place"])

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = arrow_fs.FileSystem.from_uri(root)
        model, slots = shared.value
        for frame in frames:
            for name, start, place in zip(*[c.to_pylist() for c in frame.columns], strict=True):
                doc_ids, nulls, lengths, ids = read_segment(filesystem, f"{base}/files/{name}", json.loads(place), model, slots)
                ends = np.cumsum(lengths)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, mask=nulls), pa.array(start + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    parts = sum(-(-x["ids"] // SEGMENT) for x in manifest["files"])
    planned = files.mapInArrow(plan, "file string, start long, place string").repartition(max(1, min(parts, 4 * spark.sparkContext.defaultParallelism)), "file", "start")
    return planned.mapInArrow(frugal(read), RESULT)


def op11_rans_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    root = shared_dir(spark, "rans")
    write_ids(table(spark, sf_dir, "documents"), root, public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(spark, root)
