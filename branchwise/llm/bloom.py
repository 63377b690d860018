"""A Bloom filter of 64-bit hashes, small enough to go to every worker."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

#: Bits for each hash, and the least and the most that a filter has; beyond the most it lets more through, and loses nothing.
BITS_A_HASH, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 28
_SHIFTS = (0, 33)


def bloom(hashes: DataFrame, column: str) -> bytes:
    """The filter of a long column of even hashes without nulls; bits are merged by aggregation, the driver gets 32 MB at most."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_HASH * hashes.count()).bit_length()))
    at = F.explode(F.array(*[F.shiftrightunsigned(column, s).bitwiseAND(F.lit(size - 1)) + 1 for s in _SHIFTS])).alias("at")
    parts = hashes.select(at).groupBy(F.bitmap_bucket_number("at").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    field = np.zeros(size // 8, np.uint8)
    for k, bits in parts.collect():
        field[(k - 1) * len(bits) : k * len(bits)] = np.frombuffer(bits, np.uint8)
    return field.tobytes()


def may_hold(field: bytes, h: np.ndarray) -> np.ndarray:
    """Whether each of the hashes (uint64) may be in the filter: true for all that are."""
    bits, found = np.frombuffer(field, np.uint8), np.ones(len(h), bool)
    for s in _SHIFTS:
        at = (h >> np.uint64(s)) & np.uint64(8 * len(bits) - 1)
        found &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return found
