"""Bounded-space online best-fit packing of tokenised documents (operator 2).

Documents become token ids plus a closing id; only those longer than a sequence are cut. Pieces are written to the
shared folder and dealt to groups of bounded size by a hash that takes in the piece's place in that table, so that equal
rows spread out, arrival order is random, and it is the same after a lost executor. Each group is packed online: at most
OPEN_BINS bins are open, filed by free space, and a bitset of the free spaces in use finds the tightest fit in one
shift. When one more bin would have to open, the fullest one closes.

Tokenising goes by chunk. Latin-1 texts are lower-cased and split into the tokenizer's parts (runs of letters, digits,
other signs) over their bytes; what isn't in the cache goes through the tokenizer's merges. Other texts are split at
white space, which the tokenizer's pattern never spans, and go through the whole tokenizer. Chunks are told apart by
Arrow; each distinct one is looked up once a block in a bounded cache, and ids are laid out by array operations.

Edge cases: null or empty texts are the closing id alone; pieces of repeated rows are packed like any others; an empty
table gives no rows; further columns are ignored; a very long text is a block of its own.
"""

from __future__ import annotations

import array
import functools
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm import bytetext
from gleaner.llm.common import spread, stage

OPEN_BINS = 1024
#: Pieces that one group packs, on average.
GROUP_PIECES = 32_768
#: Chunks whose ids a worker keeps, and chunks that are encoded at once.
CACHE_CHUNKS, MISSES_AT_ONCE = 200_000, 4096
#: Bytes of text encoded at once.
BLOCK_BYTES = 1 << 20


# The tokenizer's split pattern for Latin-1 text. What is no letter, digit or space is a sign; a digit is a part
# of its own, and an apostrophe alone takes one of these endings along.
SPACES = "\t\n\v\f\r \x85\xa0"
DIGITS = "0123456789\u00b2\u00b3\u00b9\u00bc\u00bd\u00be"
FEMININE, MICRO, MASCULINE, TIMES, DIVIDED = "\u00aa", "\u00b5", "\u00ba", "\u00d7", "\u00f7"
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]

SPACE, LETTER, DIGIT, SIGN = range(4)


def _kind(char: str) -> int:
    if char in SPACES:
        return SPACE
    if char in DIGITS:
        return DIGIT
    return LETTER if char in (FEMININE, MICRO, MASCULINE) or char.isalpha() and char not in (TIMES, DIVIDED) else SIGN


#: The kind of each ASCII byte, and of a continuation byte behind each of the two bytes that begin the rest of Latin-1.
_ONE = np.array([_kind(chr(i)) if i < 128 else SPACE for i in range(256)], dtype=np.uint8)
_TWO = np.array([[_kind(chr(64 * (lead & 3) + (i & 63))) for i in range(256)] for lead in (0xC2, 0xC3)], dtype=np.uint8)


def latin_parts(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(parts of all rows, bounds of the rows) of lower-cased Latin-1 text in UTF-8; offsets bound its rows."""
    low = bytetext.LOWER[raw]
    kind = _ONE[raw]
    lead = np.flatnonzero(raw >= 0xC2)
    follows = lead + 1
    kind[lead] = kind[follows] = _TWO[raw[lead] - 0xC2, raw[follows]]
    # Capitals of the second block are 32 places before their small letters.
    capital = follows[(raw[lead] == 0xC3) & (raw[follows] < 0x9F) & (raw[follows] != 0x97)]
    low[capital] += 32
    starts = np.empty(len(raw), dtype=bool)
    starts[:1] = True
    starts[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    starts[offsets[:-1][offsets[:-1] < len(raw)]] = True
    starts[follows] = False
    mark = np.flatnonzero(low == ord("'"))
    mark = mark[starts[mark] & (mark + 1 < len(raw))]
    mark = mark[starts[mark + 1] & (kind[mark + 1] == LETTER)]
    mark = mark[~np.isin(mark + 1, offsets)]
    row_end = offsets[np.searchsorted(offsets, mark, side="right")]
    for ending in ENDINGS:
        spot = mark + 1
        fits = spot + len(ending) <= row_end
        for k, char in enumerate(ending.encode()):
            fits &= low[np.minimum(spot + k, len(raw) - 1)] == char
        spot = spot[fits]
        starts[spot] = False
        after = spot + len(ending)
        after = after[after < row_end[fits]]
        starts[after[kind[after] == LETTER]] = True
    inside = kind != SPACE
    starts &= inside
    at = np.flatnonzero(starts)
    place = np.cumsum(inside, dtype=np.int32)
    data = low[inside]
    bounds = np.append(place[at] - 1, len(data)).astype(np.int32)
    parts = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    return parts, np.searchsorted(at, offsets)


class _Cache:
    """Chunks in Arrow, and the bounds of their ids, which stand one after the other: a tenth of what Python strings take."""

    def __init__(self):
        self.names = pa.array([], pa.string())
        self.ids, self.bounds = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def places(self, names: pa.Array) -> np.ndarray:
        """The place of each chunk, -1 for those that aren't here."""
        return pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy()

    def add(self, names: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        """The chunks that come first are the frequent ones; a full cache stays as it is."""
        room = min(CACHE_CHUNKS - len(self.names), len(names))
        if room > 0:
            self.names = pa.concat_arrays([self.names, names.slice(0, room)])
            self.bounds = np.concatenate([self.bounds, ends[1 : room + 1] + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids[: ends[room]]])


class ChunkEncoder:
    """Token ids of texts through a bounded cache of white-space-free chunks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.path = path
        # The merges alone, for parts that are normalised and split already; bytes still stand for themselves.
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer, self.merges.pre_tokenizer = None, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.caches = {True: _Cache(), False: _Cache()}

    @functools.cached_property
    def whole(self):
        """All of the tokenizer, for texts beyond Latin-1."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def learn(self, chunks: list[str], tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks in a row, where each chunk's end) of chunks that aren't in the cache."""
        ids, ends = array.array("I"), array.array("q", [0])
        for at in range(0, len(chunks), MISSES_AT_ONCE):
            for e in tokenizer.encode_batch_fast(chunks[at : at + MISSES_AT_ONCE], add_special_tokens=False):
                ids.extend(e.ids)
                ends.append(len(ids))
        return np.frombuffer(ids, np.uint32), np.frombuffer(ends, np.int64)

    def _looked_up(self, chunks: pa.Array, plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks in a row, bounds of the chunks). Parts of plain texts and chunks of others have caches of their own."""
        cache = self.caches[plain]
        told = chunks.dictionary_encode()
        place = cache.places(told.dictionary)
        old, new = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
        fresh = told.dictionary.take(pa.array(new))
        ids, ends = self.learn(fresh.to_pylist(), self.merges if plain else self.whole) if len(fresh) else (cache.ids[:0], np.zeros(1, np.int64))
        starts, sizes = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
        starts[old], sizes[old] = cache.bounds[place[old]], cache.bounds[place[old] + 1] - cache.bounds[place[old]]
        starts[new], sizes[new] = ends[:-1] + len(cache.ids), np.diff(ends)
        codes = told.indices.to_numpy()
        counts = sizes[codes]
        edge = np.concatenate([[0], np.cumsum(counts)])
        spots = np.repeat(starts[codes] - edge[:-1], counts)
        spots += np.arange(edge[-1])
        out = np.concatenate([cache.ids, ids])[spots]
        cache.add(fresh, ids, ends)
        return out, edge

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, bounds of the texts)."""
        raw, offsets = bytetext.flat(texts)
        # In UTF-8 only what is beyond Latin-1 begins with a byte of 0xC4 or more.
        odd = np.flatnonzero(raw >= 0xC4)
        plain = np.ones(len(texts), dtype=bool)
        plain[np.searchsorted(offsets, odd, side="right") - 1] = False
        plain &= ~pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        if plain.all():
            parts, rows = latin_parts(raw, offsets)
            ids, edge = self._looked_up(parts, True)
            return ids, edge[rows]
        own = []
        for which in (True, False):
            some = texts.filter(pa.array(plain == which))
            if which:
                parts, rows = latin_parts(*bytetext.flat(some))
            else:
                lists = pc.split_pattern(pc.replace_substring(some, "\n", " "), " ")
                parts, rows = lists.flatten(), lists.offsets.to_numpy()
            ids, edge = self._looked_up(parts, which)
            own.append((ids, edge[rows]))
        # Back in the order of the texts.
        sizes, starts = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
        for which, (_, bounds) in zip((True, False), own):
            sizes[plain == which] = np.diff(bounds)
            starts[plain == which] = bounds[:-1] + (0 if which else len(own[0][0]))
        edge = np.concatenate([[0], np.cumsum(sizes)])
        return np.concatenate([own[0][0], own[1][0]])[np.repeat(starts - edge[:-1], sizes) + np.arange(edge[-1])], edge

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        ids, bounds = self.encode_array(pa.array(texts, pa.string()))
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:])]


_encoders: dict[str, ChunkEncoder] = {}
bytetext.leaving["packing"] = _encoders.clear


def encoder(path: str) -> ChunkEncoder:
    """One for each Python worker and tokenizer file."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def _pieces(path: str, capacity: int, closing: int):
    def run(batches):
        made = encoder(path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at, end, _, _ in bytetext.blocks(texts, BLOCK_BYTES):
                tokens, bounds = made.encode_array(texts.slice(at, end - at))
                # Each text's ids and the closing one.
                closed = np.insert(tokens, bounds[1:], closing).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                sizes = np.diff(bounds)
                count = -(-sizes // capacity)
                row = np.repeat(np.arange(end - at), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(capacity, sizes[row] - start)
                low = bounds[row] + start
                view = memoryview(closed).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(low.tolist(), (low + length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, end - at).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return bytetext.lean("packing", run)


def best_fit(lengths, capacity: int, open_bins: int = OPEN_BINS):
    """(bin, offset) of each length in turn, by bounded-space online best fit.

    free holds a bit for each free space that an open bin has; the lowest bit from the length up is the tightest fit,
    and the lowest bit of all belongs to the fullest bin, which closes when a further bin must open.
    """
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    at: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, opened, count = 0, 0, 0
    for i, n in enumerate(lengths):
        fits = free >> n
        if fits:
            space = (fits & -fits).bit_length() - 1 + n
            bin_ = at[space].pop()
            if not at[space]:
                free &= ~(1 << space)
            count -= 1
        else:
            if count >= open_bins:
                fullest = (free & -free).bit_length() - 1
                at[fullest].pop()
                if not at[fullest]:
                    free &= ~(1 << fullest)
                count -= 1
            bin_, space = opened, capacity
            opened += 1
        bins[i], offsets[i] = bin_, capacity - space
        left = space - n
        if left:  # a full bin is closed at once
            at[left].append(bin_)
            free |= 1 << left
            count += 1
    return bins, offsets


def _pack(capacity: int, open_bins: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = best_fit(table.column("length").to_pylist(), capacity, open_bins)
        first = key[0].as_py() << 32
        return table.drop_columns(["bin_group", "order"]).append_column("sequence_id", pa.array(bins + first)).append_column("offset", pa.array(offsets))

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, closing: int = 0, id_col: str = "doc_id", text_col: str = "text", open_bins: int = OPEN_BINS) -> DataFrame:
    """Pieces with doc_id, piece, start, length, ids_crc32, and their sequence_id and offset."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = stage(spread(texts).mapInArrow(_pieces(tokenizer_path, capacity, closing), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"), "pieces")
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    # The place in the written table tells equal pieces apart.
    order = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())
    dealt = pieces.withColumn("order", order).withColumn("bin_group", F.pmod(F.xxhash64("order", F.lit(7)), F.lit(groups)))
    return dealt.groupBy("bin_group").applyInArrow(_pack(capacity, open_bins), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
