"""A 64-bit content fingerprint: three-byte shingles with their position, hashed, voting on each bit."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The multipliers of the shingle hash.
FIRST, SECOND = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53
#: Shingles hashed at once: their scratch arrays stay in a core's cache.
_SLICE = 1 << 14
#: The bits of each byte value.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def simhash_bytes(raw: bytes) -> int:
    """As a signed 64-bit integer; 0 below three bytes."""
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint64)
    n = len(b) - 2
    if n < 1:
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _SLICE):  # scratch memory stays bounded
        end = min(n, at + _SLICE)
        h = (b[at:end] << np.uint64(32)) ^ (b[at + 1 : end + 1] << np.uint64(16)) ^ b[at + 2 : end + 2] ^ np.arange(at + 1, end + 1, dtype=np.uint64)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(FIRST)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(SECOND)
        h ^= h >> np.uint64(33)
        # Votes are counted by byte value, then by the bits of each value.
        columns = h.astype("<u8").view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
        ones += (np.bincount(columns.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


@F.arrow_udf(T.LongType())
def _simhash(raw: pa.Array) -> pa.Array:
    return pa.array([None if x is None else simhash_bytes(x) for x in raw.to_pylist()], pa.int64())


def simhash(content: Column) -> Column:
    """Fingerprint of a string's or binary's bytes."""
    return _simhash(content.cast("binary"))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
