"""Benchmark decontamination by latent semantic retrieval (operator 3).

Passages are WINDOW words of a document, a new one every STRIDE words. TF-IDF uses hashed words; document frequencies
are counted over all passages' stretches of the corpus. A randomised SVD of the TF-IDF matrix A of passages gives the
latent space, over every passage of every document and item: the pass that counts also sketches the rows (each stretch
goes, with a sign, to a few columns that its words' hash names), a second one multiplies A with the sketch's basis Q and
with its transposed self, only features x rank sums come back, and a Rayleigh-Ritz step (the eigenvectors of
Q^T A^T A Q) turns the basis into right singular vectors, of which the RANK strongest stay, each divided by its singular
value: on large corpora the few topics fill the space otherwise. A word adds its row of them, at length one, times its
squared inverse frequency: without that length the few common words fill the space (invented or rare words have a flat
spectrum). Words that no item has add nothing: they can't speak for a leak, only hide one. Each core sums in one task,
and executors add these sums up by slices of features.

Items are cut into windows of a passage's length. Each passage is compared with all windows of the items by cosine in
the latent space, the items (a stated query set) in blocks of bounded size, one search for each block. A window shorter
than a passage can't reach cosine 1, so its bound is lower by the root of the ratio of the lengths. Candidates are then
settled on words: the longest common subsequence of the item and the words around the passage (the item's length).
`contained` of the item's words in order there is a leak; a share of at least `paraphrased` is one if the answer, the
item's last words, is there as well. Items of LEAST_WORDS to MIN_WORDS - 1 words are too short for paraphrases and
match by their exact words in sequence.

Edge cases: null and empty texts match nothing; items under LEAST_WORDS words match nothing, as do items without an id;
equal items are found alike, the smallest item_id wins ties; a text's length and the number of items have no bound; an
empty benchmark or corpus gives no rows; repeated rows give a row each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm import bytetext
from gleaner.llm.common import spread, stage

BITS = 14
FEATURES = 1 << BITS
WINDOW, STRIDE = 24, 8
#: Windows of an item begin at most this many words apart.
ITEM_STRIDE = 16
RANK, EXTRA = 192, 16
COSINE = 0.5
CONTAINED, PARAPHRASED, ANSWER_WORDS, ANSWER_SHARE = 0.8, 0.6, 6, 0.8
MIN_WORDS, LEAST_WORDS = 8, 3
#: Columns of the sketch that a stretch goes to: enough for the sketch of few stretches to keep their rank.
SPOTS = 4
#: UTF-8 bytes of the items that one search takes, on average over the blocks; an item is never cut.
ITEM_BYTES = 1 << 19
BLOCKS = WINDOW // STRIDE
#: Rows of the vectors that are compared at once, and values of them that are summed: they stay in a core's cache.
SOME, SUMMED = 256, 1 << 16
#: Features whose sums travel in one row.
SLICE = 128
#: Words of short texts and stretches of a long one that are multiplied at once: a feature's rows are then added in few runs.
GATHERED, PART = 60_000, 16384
#: Columns that are multiplied at once: what a part needs of them stays nearer to a core than whole rows would.
COLUMNS = 52
#: Rows that are added in one run, halved down to one for what is left of a feature's rows.
RUN = 64


def _words(texts: pa.Array):
    """(first row, end row, word hashes, first word of each row) block by block."""
    for at, end, raw, offsets in bytetext.blocks(texts):
        hashes, _, first = bytetext.words(raw, offsets, bytetext.NON_WORD)
        yield at, end, hashes, first


def _gathered(texts: pa.Array):
    """(word hashes, first word of each row) of several blocks together."""
    some, first = [], [0]
    for _, _, hashes, starts in _words(texts):
        some.append(hashes)
        first += (starts[1:] + first[-1]).tolist()
        if first[-1] >= GATHERED:
            yield np.concatenate(some), np.array(first)
            some, first = [], [0]
    if some:
        yield np.concatenate(some), np.array(first)


def feature(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def stretches(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of each stretch of STRIDE words, first stretch of each row): the last of a row may be shorter."""
    counts = -(-np.diff(first) // STRIDE)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(np.arange(len(counts)), counts)
    return first[:-1][row] + (np.arange(bounds[-1]) - bounds[:-1][row]) * STRIDE, bounds


def windows(sums: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Passage vectors: each stretch with the following ones of its row, up to BLOCKS."""
    out = sums.copy()
    row_end = np.repeat(bounds[1:], np.diff(bounds))
    for k in range(1, min(BLOCKS, len(sums))):
        _add_inside(out[:-k], sums[k:], np.arange(len(sums) - k) + k < row_end[:-k])
    return out


def _add_inside(out: np.ndarray, more: np.ndarray, inside: np.ndarray) -> None:
    """out += more in the rows inside; the few others are put back, which is faster than to mask all."""
    others = np.flatnonzero(~inside)
    kept = out[others]
    out += more
    out[others] = kept


def _sketched(batches):
    """How many stretches hold each feature, and how many there are (at -1); the sketch of the stretches' rows of counts, a
    row for each SLICE features."""
    total = np.zeros(FEATURES + 1, dtype=np.int64)
    sketch = np.zeros((FEATURES, RANK + EXTRA), dtype=np.float32)
    for batch in batches:
        for _, _, hashes, first in _words(batch.column(0)):
            starts, _ = stretches(first)
            if len(starts):
                ids = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(hashes))))
                words = feature(hashes)
                key = np.sort(ids << BITS | words)
                new = np.concatenate([[True], key[1:] != key[:-1]])
                total[:FEATURES] += np.bincount(key[new] & (FEATURES - 1), minlength=FEATURES)
                total[FEATURES] += len(starts)
                own = np.add.reduceat(hashes, starts)
                row = words * sketch.shape[1]
                for spot in range(SPOTS):
                    draw = bytetext.mix(own + np.uint64(spot))
                    column = ((draw >> np.uint64(1)) % np.uint64(sketch.shape[1])).astype(np.int64)
                    sign = np.where(draw & np.uint64(1), np.float32(1), np.float32(-1))
                    np.add.at(sketch.reshape(-1), row + column[ids], sign[ids])
    yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["at", "sums"])
    yield from _slices(sketch)


def _slices(*columns: np.ndarray):
    """A row for each SLICE features of the matrix that has these columns."""
    for at in range(0, FEATURES, SLICE):
        rows = np.concatenate([c[at : at + SLICE] for c in columns], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([rows.astype("<f4").tobytes()], pa.binary())], names=["at", "sums"])


def _laid_out(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature of word k of each stretch in row k, bounds of the rows); a short one is filled up with FEATURES, which adds nothing."""
    starts, bounds = stretches(first)
    if not len(starts):
        return np.zeros((STRIDE, 0), np.int64), bounds
    lengths = np.minimum(STRIDE, np.repeat(first[1:], np.diff(bounds)) - starts)
    spots = starts + np.arange(STRIDE)[:, None]
    return np.where(np.arange(STRIDE)[:, None] < lengths, feature(hashes)[np.minimum(spots, len(hashes) - 1)], FEATURES), bounds


def _taken(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of the table's rows that each column of rows names."""
    out = np.empty((rows.shape[1], table.shape[1]), dtype=np.float32)
    step = max(1, SUMMED // max(1, table.shape[1]))
    more = np.empty((step, table.shape[1]), dtype=np.float32)
    for at in range(0, len(out), step):
        some = out[at : at + step]
        table.take(rows[0, at : at + step], axis=0, out=some, mode="clip")
        for k in range(1, len(rows)):
            some += table.take(rows[k, at : at + step], axis=0, out=more[: len(some)], mode="clip")
    return out


def _vectors(hashes: np.ndarray, first: np.ndarray, table: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit latent vector of each passage, bounds of the rows); table holds in a feature's place what it adds."""
    words, bounds = _laid_out(hashes, first)
    out = windows(_taken(table, place[words]), bounds)
    out /= np.maximum(np.sqrt(np.einsum("ij,ij->i", out, out)), 1e-9)[:, None]
    return out, bounds


def _squared_lengths(words: np.ndarray, bounds: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Of each passage's TF-IDF row, for the words of its stretches; squares holds the squared weight of a feature, and zeros behind."""
    n = words.shape[1]
    row_end = np.repeat(bounds[1:], np.diff(bounds))
    held = np.full((n, WINDOW), FEATURES, dtype=np.int16)
    held[:, :STRIDE] = words.T
    for k in range(1, min(BLOCKS, n)):
        inside = np.arange(n - k) + k < row_end[:-k]
        held[: n - k, k * STRIDE : (k + 1) * STRIDE] = np.where(inside, words[:, k:], FEATURES).T
    gaps = held == FEATURES
    if gaps.any():
        held += gaps * np.arange(WINDOW, dtype=np.int16)  # they equal nothing
    held.sort(axis=1)
    weights = squares[held]
    out = weights.sum(axis=1)
    # A word that is there c times counts c * c: itself, and twice each pair of its places.
    some = np.arange(n)
    for k in range(1, WINDOW):
        same = held[:, k:] == held[:, :-k]
        more = np.flatnonzero(same.any(axis=1))
        if not len(more):
            break
        held, some, weights = held[more], some[more], weights[more]
        out[some] += 2 * (weights[:, k:] * same[more]).sum(axis=1)
    return out


def _runs(words: np.ndarray) -> list[tuple]:
    """(length, features, columns of words that hold them in runs of that length, first run of each feature), from RUN down."""
    flat = words.astype(np.int16).reshape(-1)
    order = np.argsort(flat, kind="stable")
    order = order[: np.searchsorted(flat, FEATURES, sorter=order)]
    flat, of, out = flat[order], order % words.shape[1], []
    if not len(flat):
        return out
    spot = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    counts = np.diff(np.append(spot, len(flat)))
    named = flat[spot].astype(np.int64)
    for size in (RUN >> k for k in range(RUN.bit_length())):
        runs = counts // size
        before = np.cumsum(runs) - runs
        begin = np.repeat(spot, runs) + (np.arange(runs.sum()) - np.repeat(before, runs)) * size
        if len(begin):
            own = np.flatnonzero(runs)
            out.append((size, named[own], of[begin + np.arange(size)[:, None]], before[own]))
        spot, counts = spot + runs * size, counts % size
    return out


def _add_rows(total: np.ndarray, runs: list[tuple], rows: np.ndarray) -> None:
    """Adds row s of rows to the total of each word in column s of the words that runs were made of."""
    for size, named, of, firsts in runs:
        sums = _taken(rows, of)
        # Only of the longest runs may a feature have several.
        total[named] += np.add.reduceat(sums, firsts, axis=0) if size == RUN else sums


def _products(idf: np.ndarray, right: np.ndarray):
    """Each task's sum of A^T (A right) over its unit TF-IDF passages A, a row for each SLICE features."""

    def run(batches):
        spans = [slice(at, at + COLUMNS) for at in range(0, right.shape[1], COLUMNS)]
        weighted = [np.append(right[:, c] * idf[:, None], np.zeros_like(right[:1, c]), axis=0) for c in spans]
        totals = [np.zeros_like(w[:-1]) for w in weighted]
        squares = np.append(idf * idf, np.zeros(WINDOW, np.float32))
        for batch in batches:
            for hashes, first in _gathered(batch.column(0)):
                words, bounds = _laid_out(hashes, first)
                for low in range(0, words.shape[1], PART):
                    # The passages that begin in a part reach into the stretches behind it.
                    high = min(low + PART, words.shape[1])
                    last = min(high + BLOCKS - 1, words.shape[1])
                    part, inner = words[:, low:last], np.clip(bounds, low, last) - low
                    n, row_end = high - low, np.repeat(inner[1:], np.diff(inner))
                    lengths = np.maximum(_squared_lengths(part, inner, squares)[:n], 1e-18)[:, None]
                    runs = _runs(part)
                    for table, total in zip(weighted, totals):
                        along = windows(_taken(table, part), inner)[:n]
                        along /= lengths
                        back = np.zeros((last - low, table.shape[1]), dtype=np.float32)
                        back[:n] = along
                        for k in range(1, BLOCKS):
                            some = min(n, last - low - k)
                            if some > 0:
                                _add_inside(back[k : k + some], along[:some], np.arange(some) + k < row_end[:some])
                        _add_rows(total, runs, back)
        for total in totals:
            total *= idf[:, None]
        yield from _slices(*totals)

    return run


def _added(batches):
    """The sum of one slice over its tasks, in the order of their numbers: floats add up alike in every run."""
    rows = sorted((task, at, sums) for b in batches for task, at, sums in zip(*(b.column(n).to_pylist() for n in ("task", "at", "sums"))))
    at = rows[0][1]
    total = sum(np.frombuffer(sums, dtype="<i8" if at < 0 else "<f4") for _, _, sums in rows)
    return pa.table({"at": pa.array([at], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})


def _summed(texts: DataFrame, run) -> dict[int, bytes]:
    """What run gives over all texts, by slices. A task for each core: every task's sums are as large as the result."""
    parts = texts.coalesce(texts.sparkSession.sparkContext.defaultParallelism).mapInArrow(bytetext.lean("decontaminate", bytetext.keeping(run)), "at int, sums binary")
    numbered = parts.withColumn("task", F.spark_partition_id())
    return {r.at: r.sums for r in numbered.groupBy("at").applyInArrow(lambda t: _added(t.to_batches()), "at int, sums binary").toLocalIterator()}


def _matrix(sums: dict[int, bytes]) -> np.ndarray:
    out = np.zeros((FEATURES, RANK + EXTRA), dtype=np.float32)
    for at in [at for at in sums if at >= 0]:
        out[at : at + SLICE] = np.frombuffer(sums.pop(at), dtype="<f4").reshape(-1, out.shape[1])
    return out


def orthonormal(columns: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns' span, by Cholesky factors of their small product, twice; in single precision, as
    double copies of all rows are what the driver would need most memory for."""
    for _ in range(2):
        gram = sum((x.T @ x for x in (columns[at : at + 1024].astype(np.float64) for at in range(0, len(columns), 1024))), np.zeros((columns.shape[1],) * 2))
        gram[np.diag_indices_from(gram)] += 1e-10 * np.trace(gram) + 1e-30
        columns = columns @ np.linalg.inv(np.linalg.cholesky(gram)).T.astype(np.float32)
    return columns


def rayleigh_ritz(basis: np.ndarray, product: np.ndarray, rank: int) -> np.ndarray:
    """The strongest right singular vectors of A in the span of A^T A basis; product is A^T A basis, basis is orthonormal."""
    return _ritz(basis, product, rank)[0]


def _ritz(basis: np.ndarray, product: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """These vectors and their squared singular values."""
    inner = (basis.T @ product).astype(np.float64)
    values, rotation = np.linalg.eigh((inner + inner.T) / 2)
    strongest = np.argsort(-values)[:rank]
    # A^T A (basis v) / value is the Ritz vector after one more power step.
    return orthonormal(product @ (rotation[:, strongest] / np.maximum(values[strongest], 1e-12)).astype(np.float32)), values[strongest]


def latent_table(docs: DataFrame, items: DataFrame, text_col: str) -> np.ndarray:
    """(features + 1) x rank: what a word adds to a passage's latent vector; the last row is zero."""
    texts = spread(docs.select(F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text")))
    found, own = _summed(texts, _sketched), _summed(items.select("text"), _sketched)
    counts = np.frombuffer(found[-1], dtype="<i8") if found else np.zeros(FEATURES + 1)
    idf = np.log((counts[FEATURES] + 1) / (counts[:FEATURES] + 1)).astype(np.float32) + np.float32(0.1)
    held = np.frombuffer(own[-1], dtype="<i8")[:FEATURES] > 0
    basis = _matrix(found)
    basis += _matrix(own)
    basis *= idf[:, None]
    basis = orthonormal(basis)
    product = _matrix(_summed(texts.union(items.select("text")), _products(idf, basis)))
    vectors, values = _ritz(basis, product, RANK)
    del basis, product
    vectors /= np.sqrt(np.maximum(values, 1e-6 * values[0]) + 1e-30).astype(np.float32)
    table = np.zeros((FEATURES + 1, RANK), dtype=np.float32)
    np.divide(vectors, np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9), out=table[:-1])
    table[:-1] *= np.where(held, idf**2, 0)[:, None]
    return table


def common_subsequence(masks: dict, words: list) -> int:
    """Length of the longest common subsequence, bit-parallel over the item's words."""
    v = masks["all"]
    for w in words:
        m = masks.get(w)
        if m:
            u = v & m
            v = (v + u) | (v - u)
            v &= masks["all"]
    return masks["n"] - v.bit_count()


def _masks(words: list) -> dict:
    out: dict = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out | {"n": len(words), "all": (1 << len(words)) - 1}


def item_windows(n: int) -> list[tuple[int, int]]:
    """(start, end) of an item's windows: all of a short one, else windows of a passage's length, evenly spaced."""
    if n <= WINDOW:
        return [(0, n)]
    steps = -(-(n - WINDOW) // ITEM_STRIDE)
    return [(start, start + WINDOW) for start in (round(i * (n - WINDOW) / steps) for i in range(steps + 1))]


def _sequence(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words."""
    out = hashes
    for i in range(1, n):
        out = bytetext.pair(out[:-1], hashes[i:], i)
    return out


class _Items:
    """A block of items, made ready for the search in one task."""

    def __init__(self, table: np.ndarray, ids: list[int], texts: pa.Array, cosine: float):
        self.ids, self.words = ids, []
        for _, _, hashes, first in _words(texts):
            self.words += [hashes[a:b] for a, b in zip(first[:-1], first[1:])]
        long = [i for i, w in enumerate(self.words) if len(w) >= MIN_WORDS]
        spans = [(i, a, b) for i in long for a, b in item_windows(len(self.words[i]))]
        self.owner = np.array([i for i, _, _ in spans], dtype=np.int64)
        vectors = np.stack([table[feature(self.words[i][a:b])].sum(axis=0) for i, a, b in spans]) if spans else np.zeros((0, table.shape[1]), np.float32)
        self.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        self.bound = (cosine * np.sqrt(np.array([(b - a) / WINDOW for _, a, b in spans]))).astype(np.float32)
        self.lists = {i: self.words[i].tolist() for i in long}
        self.masks = {i: _masks(w) for i, w in self.lists.items()}
        self.answers = {i: _masks(w[-ANSWER_WORDS:]) for i, w in self.lists.items()}
        self.distinct = {i: set(w) for i, w in self.lists.items()}
        self.short: dict[int, dict[int, int]] = {}  # by length: sequence hash to the smallest item
        for i, w in enumerate(self.words):
            if LEAST_WORDS <= len(w) < MIN_WORDS:
                self.short.setdefault(len(w), {}).setdefault(int(_sequence(w, len(w))[0]), i)

    def confirmed(self, i: int, around: list, contained: float, paraphrased: float) -> float:
        """The share of item i's words that are in order in around, 0 where that is no leak."""
        n, there = len(self.lists[i]), set(around)
        if len(self.distinct[i] & there) + n - len(self.distinct[i]) < paraphrased * n:
            return 0.0  # no order of these words could do
        share = common_subsequence(self.masks[i], around) / n
        if share < paraphrased:
            return 0.0
        if share < contained and common_subsequence(self.answers[i], around) / self.answers[i]["n"] < ANSWER_SHARE:
            return 0.0
        return share


def _search(table: np.ndarray, item_ids: list, item_texts: pa.Array, cosine: float, contained: float, paraphrased: float):
    def run(batches):
        items = _Items(table, item_ids, item_texts, cosine)
        # The rows that add something, together and before one of zeros for all others: so they stay in a core's cache.
        held = table.any(axis=1)
        dense = np.concatenate([table[held], np.zeros((1, table.shape[1]), np.float32)])
        place = np.where(held, np.cumsum(held) - 1, len(dense) - 1)
        # Made once: fresh memory of this size costs a third of the product again.
        room = np.empty((SOME, len(items.owner)), dtype=np.float32)
        for batch in batches:
            for at, end, hashes, first in _words(batch.column(1)):
                best: dict[int, tuple] = {}

                def offer(r: int, found: tuple) -> None:
                    if r not in best or found > best[r]:
                        best[r] = found

                passages, bounds = _vectors(hashes, first, dense, place)
                row_of = np.repeat(np.arange(end - at), np.diff(bounds))
                for low in range(0, len(passages), SOME) if len(items.owner) else ():
                    part = passages[low : low + SOME]
                    like = np.matmul(part, items.vectors.T, out=room[: len(part)])
                    hits = np.flatnonzero(like >= items.bound)  # of one axis, which is far faster where few are true
                    done = set()
                    at_p, at_q = np.divmod(hits, like.shape[1])
                    for p, i, like_pq in zip(at_p.tolist(), items.owner[at_q].tolist(), like.reshape(-1)[hits].tolist()):
                        if (p, i) in done:
                            continue
                        done.add((p, i))
                        r, reach = int(row_of[low + p]), len(items.lists[i]) + STRIDE
                        spot = int(first[r]) + (low + p - int(bounds[r])) * STRIDE
                        around = hashes[max(int(first[r]), spot - reach) : min(int(first[r + 1]), spot + WINDOW + reach)].tolist()
                        share = items.confirmed(i, around, contained, paraphrased)
                        if share:
                            offer(r, (share, like_pq, -i))
                for n, known in items.short.items():
                    runs = _sequence(hashes, n) if len(hashes) >= n else hashes[:0]
                    for p in np.flatnonzero(np.isin(runs, np.array(list(known), dtype=np.uint64))).tolist():
                        r = int(np.searchsorted(first, p, side="right")) - 1
                        if p + n <= first[r + 1]:
                            offer(r, (1.0, 1.0, -known[int(runs[p])]))
                rows = sorted(best)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at).take(pa.array(rows, pa.int64())), pa.array([item_ids[-best[r][2]] for r in rows], pa.int64()), pa.array([best[r][0] for r in rows], pa.float64()), pa.array([best[r][1] for r in rows], pa.float64())],
                    names=["row", "item_id", "share", "cosine"],
                )

    return bytetext.lean("decontaminate", bytetext.keeping(run))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", cosine: float = COSINE, contained: float = CONTAINED, paraphrased: float = PARAPHRASED) -> DataFrame:
    """doc_id, item_id, share (of the item's words found in order), cosine: a row for each document that leaks an item, with its best one."""
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    # Equal items are one query, and so can't fill a block.
    items = stage(benchmark.select("item_id", F.lower(F.coalesce(F.col("text"), F.lit(""))).alias("text")).where("item_id is not null").groupBy("text").agg(F.min("item_id").alias("item_id")), "items")
    size = items.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    parts = -(-size // ITEM_BYTES)
    block = lambda b: sorted(items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == b).select("item_id", "text").collect())
    blocks = (x for x in map(block, range(parts)) if x)
    first = next(blocks, None)
    if first is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, share double, cosine double")
    texts_of = lambda rows: pa.array([r.text for r in rows], pa.string())
    table = latent_table(docs, items, text_col)
    search = lambda keyed, rows: spread(keyed).mapInArrow(_search(table, [r.item_id for r in rows], texts_of(rows), cosine, contained, paraphrased), f"row {keyed.schema[0].dataType.simpleString()}, item_id bigint, share double, cosine double")
    named = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    if parts == 1:
        return search(named, first).withColumnRenamed("row", "doc_id")
    # Several blocks of items: a row's finds meet by its id and text.
    keyed = named.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("row"), "text")
    found = search(keyed, first)
    for rows in blocks:
        found = found.union(stage(search(keyed, rows), "leaks"))
    best = found.groupBy("row", "item_id").agg(F.max("share").alias("share"), F.max("cosine").alias("cosine"), F.count(F.lit(1)).alias("copies"))
    top = best.groupBy("row").agg(F.max(F.struct("share", "cosine", (-F.col("item_id")).alias("least"), "copies")).alias("top"))
    # Rows that are equal in id and text have a row each.
    return top.select(F.explode(F.sequence(F.lit(1), F.col("top.copies"))), "row", "top").select("row.doc_id", (-F.col("top.least")).alias("item_id"), "top.share", "top.cosine")
