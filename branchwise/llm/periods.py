"""Runs of words that repeat with a period, by longest common extensions on a harmonic grid.

For each period p, the places jp and (j + 1)p of a text are compared: the
words that agree from there on (forward) and before (backward) give the one
stretch of period p about them. Both lengths are range minima of a common
prefix array, over the suffix array of the text and that of the reversed text.
A run of at least four periods holds two neighbouring pairs of the grid, the
first with the words behind each place equal, too; where these words differ, no
extension is asked for, and a text without any such place needs no suffix array.
A multiple of a run's period gives the same stretch, so of each the smallest
period stays.

The texts of a batch share their arrays: a word's first rank has its text in
it, and an end mark follows each text, so no extension leaves a text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from branchwise.llm.common import frugal, need, table

LEAST_LENGTH, LEAST_PERIODS = 6, 4
#: Bytes of text of a batch, and grid places that are compared at once.
STEP, GRID = 1 << 21, 1 << 20
SCHEMA = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


class Extensions:
    """Longest common extensions of places in `ranks` (int64, dense): suffix array by doubling, common prefixes, range minima."""

    def __init__(self, first: np.ndarray):
        n = len(first)
        levels, k = [self._ranked(first)], 1
        order = np.argsort(levels[0], kind="stable")
        while True:
            rank = levels[-1]
            sizes = np.bincount(rank, minlength=n)
            tied = order[sizes[rank[order]] > 1]  # by rank; a tied place is followed by k words and a mark at least
            if not len(tied):
                break
            second = rank[tied + k]
            place = np.lexsort((second, rank[tied]))
            new, own, second = tied[place], rank[tied][place], second[place]
            starts = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (second[1:] != second[:-1])]))
            groups = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            at = np.arange(len(new))
            head = starts[np.searchsorted(starts, at, "right") - 1]
            group = groups[np.searchsorted(groups, at, "right") - 1]
            rank = rank.copy()
            rank[new] = own + head - group
            order[own + at - group] = new
            levels.append(rank)
            k *= 2
        self.rank = levels[-1]
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(n, np.int64)
        for k in range(len(levels) - 2, -1, -1):  # the last level has no ties
            same = levels[k][a] == levels[k][b]
            step = np.where(same, 1 << k, 0)
            common[1:] += step
            a += step
            b += step
        self.minima = [common]

    @staticmethod
    def _ranked(first: np.ndarray) -> np.ndarray:
        """Each value as the number of smaller ones."""
        values, where, counts = np.unique(first, return_inverse=True, return_counts=True)
        return (np.cumsum(counts) - counts)[where]

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extension of a and b, which differ."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        while len(self.minima) <= level.max(initial=0):
            half, prior = 1 << (len(self.minima) - 1), self.minima[-1]
            self.minima.append(np.minimum(prior[:-half], prior[half:]))
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            here = level == k
            out[here] = np.minimum(self.minima[k][low[here]], self.minima[k][high[here] - (1 << k) + 1])
        return out


def grid(words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the grid where a run may be; text t is words[bounds[t] : bounds[t + 1]]."""
    n = np.diff(bounds)
    most = n // LEAST_PERIODS
    text = np.repeat(np.arange(len(n)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    points = (n[text] - 1) // period - 1  # j with (j + 2)p inside the text
    total = np.cumsum(points)
    cut = 0
    while cut < len(text):
        end = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + GRID, "right")))
        p, many, base = period[cut:end], points[cut:end], bounds[text[cut:end]]
        j = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        p = np.repeat(p, many)
        at = np.repeat(base, many) + j * p
        for shift in (0, None, 1):  # None: by the period
            left = at + (p if shift is None else shift)
            same = words[left] == words[left + p]
            at, p = at[same], p[same]
        yield at, p
        cut = end


def runs(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(text, start in the text, length, period) of all runs, in this order."""
    found = [x for x in grid(words, bounds) if len(x[0])]
    if not found:
        return np.empty((0, 4), np.int64)
    at, p = (np.concatenate([x[k] for x in found]) for k in (0, 1))
    text = np.searchsorted(bounds, at, "right") - 1
    held = np.unique(text)
    # The texts with places to ask for, each with an end mark.
    size = np.diff(bounds)[held]
    moved = np.concatenate([[0], np.cumsum(size + 1)])
    flat = np.full(moved[-1], -1, np.int64)
    inner = np.concatenate([np.arange(s) + m for s, m in zip(size, moved, strict=False)])
    flat[inner] = np.concatenate([words[bounds[t] : bounds[t + 1]] for t in held])
    of = np.repeat(np.arange(len(held)), size + 1)
    first = of * (int(words.max()) + 2) + flat + 1
    own = moved[np.searchsorted(held, text)]
    x = own + at - bounds[text]
    forward = Extensions(first)(x, x + p)
    last = len(flat) - 1
    turned = np.concatenate([first[::-1], [-1]])  # the mark of the first text comes before its words, so one more ends the last
    inside = x > own  # a place before which the text has a word
    backward = np.zeros(len(x), np.int64)
    backward[inside] = Extensions(turned)(last - x[inside] + 1, (last - x - p)[inside] + 1)
    start, length = at - backward - bounds[text], p + backward + forward
    good = length >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * p)
    rows = np.stack([text, start, length, p], 1)[good]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    if len(rows):
        rows = rows[np.concatenate([[True], (rows[1:, :3] != rows[:-1, :3]).any(1)])]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a contract's text: of one id in ten the end repeats with a period that the id gives."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def _judged(ids: list[int | None], texts: list[list[bytes]]) -> dict[str, list]:
    known: dict[bytes, int] = {}
    numbers = [known.setdefault(w, len(known)) for words in texts for w in words]
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
    every = runs(np.asarray(numbers, np.int64), bounds)
    edges = np.searchsorted(every[:, 0], np.arange(len(texts) + 1))
    out: dict[str, list] = {f.split()[0]: [] for f in SCHEMA.split(", ")}
    for k, (i, words) in enumerate(zip(ids, texts, strict=True)):
        own, kept, best = every[edges[k] : edges[k + 1]], words, (None,) * 4
        if len(own):
            start, length, period = own[:, 1], own[:, 2], own[:, 3]
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, start + period, 1)
            np.add.at(cover, start + length, -1)
            kept = [words[j] for j in np.flatnonzero(np.cumsum(cover)[:-1] == 0)]
            m = np.lexsort((period, start, -length))[0]
            best = (int(start[m]), int(length[m]), int(period[m]), int(1000 * length[m] // period[m]))
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in own[:, 1:].tolist())
        row = (i, len(words), len(own), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())
        for c, v in zip(out, row, strict=True):
            out[c].append(v)
    return out


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """A row a row of docs: its runs (the longest in columns, all in a hash) and the hash of the text without their repeats.

    Words are parted by ASCII white space. A run is a stretch of at least
    max(6, 4 * period) words, as long as the period holds; of a run all but the
    first period goes. A null or empty text has no words and no runs; a null id
    stays null; repeated rows are judged alike; other columns are ignored; an
    empty table gives an empty one. `plant` first repeats the end of some texts,
    as the contract says (never of a row without an id).
    """
    fields = [x.split()[0] for x in SCHEMA.split(", ")]
    schema = pa.schema([(c, pa.string() if c.endswith("sha256") else pa.int64()) for c in fields])

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            ids, texts, held = [], [], 0
            for i, text in zip(frame.column(0), frame.column(1), strict=True):
                i, text = i.as_py(), text.as_py() or ""
                words = text.encode("utf-8", "surrogatepass").split()
                ids.append(i)
                texts.append(planted(words, i) if plant else words)
                held += len(text)
                if held >= STEP:
                    yield pa.RecordBatch.from_pydict(_judged(ids, texts), schema)
                    ids, texts, held = [], [], 0
            if ids:
                yield pa.RecordBatch.from_pydict(_judged(ids, texts), schema)

    return need(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(frugal(batches), SCHEMA)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True).drop("n_words")
