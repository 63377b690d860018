"""64-bit hashes of a batch of texts' words, without a loop over words.

A word is a run of ASCII letters and digits and of characters beyond ASCII,
in lower case. Hashes are differences of prefix sums of table[byte] * P^i, all
modulo 2^64, shifted to one origin and mixed.
"""

from __future__ import annotations

import functools

import numpy as np

CHUNK = 1 << 20
_P = 0x9E3779B97F4A7C15 | 1
_WORD = np.array([chr(b).isalnum() and b < 128 or b >= 128 for b in range(256)])
_TABLE = np.random.default_rng(7).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    run = lambda p: np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, p, np.uint64)]))
    return run(np.uint64(_P)), run(np.uint64(pow(_P, -1, 2**64)))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of raw[s:e] for sorted, disjoint spans, in chunks of about CHUNK bytes."""
    out = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        base = starts[k]
        stop = max(k + 1, int(np.searchsorted(ends, base + CHUNK, "right")))
        n = int(ends[stop - 1] - base)
        up, down = powers(max(CHUNK, 1 << (n - 1).bit_length()))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[raw[base : base + n]] * up[:n])])
        s, e = starts[k:stop] - base, ends[k:stop] - base
        out[k:stop] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        k = stop
    return out


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's begin; one more bound ends the last."""
    raws = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    edge = np.diff(np.concatenate([[False], _WORD[raw]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begins = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws])])
    return span_hashes(raw, starts, ends), np.searchsorted(starts, begins)


def shingles(hashes: np.ndarray, bounds: np.ndarray, n: int = 5) -> list[np.ndarray]:
    """Each text's hashed n-word shingles, with repeats; of fewer words, all words as one shingle."""
    def runs(h: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(max(0, len(h) - k + 1), np.uint64)
        for i in range(k):
            out = mix(out * np.uint64(_P) + h[i : i + len(out)])
        return out

    every = runs(hashes, n)
    return [every[a : b - n + 1] if b - a >= n else runs(hashes[a:b], b - a) if b > a else every[:0] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
