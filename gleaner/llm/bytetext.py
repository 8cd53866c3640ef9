"""Whole-text tokenising and hashing with numpy over the UTF-8 bytes of an Arrow batch.

Every function works on whole texts. A batch of texts is one byte array plus document offsets; word hashes are
polynomial hashes modulo 2**64 read off one prefix sum, so that the cost is a few vector passes whatever the words are.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Odd, so that its powers have inverses modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes of text handled at once, few enough for scratch arrays to stay in a cache; a longer text makes a block of its own.
BLOCK_BYTES = 1 << 17

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
LOWER = _lower

#: Word separators of the shingle contract: space and the five ASCII controls from tab to carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Letters and digits of ASCII and every byte of a longer sequence are word bytes; the rest separates.
NON_WORD = np.ones(256, dtype=bool)
NON_WORD[48:58] = NON_WORD[65:91] = NON_WORD[97:123] = NON_WORD[128:] = False

_powers: dict[str, np.ndarray] = {}

#: What each operator does to drop its tables from a worker that goes on to serve another.
leaving: dict[str, Callable[[], None]] = {}


def enter(owner: str) -> None:
    for name, drop in leaving.items():
        if name != owner:
            drop()


def trim() -> None:
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


def lean(owner: str, run: Callable) -> Callable:
    """run (batches in, batches out) in a worker that keeps little afterwards: other operators' tables go first, and freed
    memory goes back to the system at the end, as the worker lives on beside an executor that wants it."""

    def whole(batches):
        enter(owner)  # functions of this module are the worker's own; its tables must not travel
        try:
            yield from run(batches)
        finally:
            trim()

    return whole


#: Bytes that a worker's allocator may keep between blocks, and the size from which it asks the system for a piece of its own.
KEPT_BYTES, OWN_BYTES = 16 << 20, 8 << 20


def keeping(run: Callable) -> Callable:
    """run in a worker whose allocator keeps what a block frees for the next one; to fault the same pages in again and again
    takes as long as hashing. It is for use inside lean, which gives all back at the end."""

    def whole(batches):
        tune = getattr(ctypes.CDLL(None), "mallopt", None)
        if tune is not None:  # glibc's M_TRIM_THRESHOLD and M_MMAP_THRESHOLD
            tune(-1, KEPT_BYTES)
            tune(-3, OWN_BYTES)
        yield from run(batches)

    return whole


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n at least."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            out = np.ones(size, dtype=np.uint64)
            done = 1
            while done < size:
                step = np.uint64(pow(base, done, 1 << 64))
                out[done : 2 * done] = out[:done] * step
                done *= 2
            _powers[name] = out
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    """An order-dependent hash of two 64-bit hashes."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + mix(b + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & MASK)))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows, offsets of the rows' starts and ends) of a string or binary array."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    body = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, dtype=np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows' ends and starts) over runs of rows of about limit bytes."""
    if not len(texts):
        return
    body, offsets = flat(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, end, body[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word with A-Z lower-cased, its byte start, first word of each row plus the total).

    A block far over BLOCK_BYTES holds one very long text; it is cut between words, so that scratch memory stays bounded.
    """
    found, at = [], 0
    while len(raw) - at > 4 * BLOCK_BYTES:
        gaps = np.flatnonzero(separators[raw[at + 1 : at + 4 * BLOCK_BYTES]])
        if not len(gaps):
            break
        cut = at + 1 + int(gaps[-1])
        found.append(_words(raw[at:cut], np.clip(offsets - at, 0, cut - at), separators, at))
        at = cut
    found.append(_words(raw[at:], np.clip(offsets - at, 0, len(raw) - at), separators, at))
    hashes, starts = (np.concatenate(x) for x in zip(*found))
    return hashes, starts, np.searchsorted(starts, offsets)


def _words(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # Tables of bytes as bytes.translate has them: numpy's own indexing makes eight bytes of each first.
    plain = raw.tobytes()
    inside = np.frombuffer(plain.translate((~separators).tobytes()), dtype=bool)
    edge = np.empty(len(raw) + 1, dtype=bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[0], edge[-1] = inside[0], inside[-1]
    inner = np.unique(offsets[(offsets > 0) & (offsets < len(raw))])
    joined = inner[inside[inner] & inside[inner - 1]]  # a word ends at its row's end even where the next row goes on
    marks = np.flatnonzero(edge)
    if len(joined):
        marks = np.sort(np.concatenate([marks, joined, joined]))
    starts, ends = marks[0::2], marks[1::2]
    up, down = powers(len(raw))
    prefix = np.empty(len(raw) + 1, dtype=np.uint64)
    prefix[0] = 0
    values = np.add(np.frombuffer(plain.translate(LOWER.tobytes()), dtype=np.uint8), np.uint64(1))
    values *= up
    np.cumsum(values, out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts]), starts + base


def segment_ids(bounds: np.ndarray) -> np.ndarray:
    """Row of each element, for rows that end at bounds[1:]."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
