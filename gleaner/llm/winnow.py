"""Document fingerprints by winnowing (operator 7).

Every gram of GRAM code points has a rolling polynomial hash; of each WINDOW consecutive grams the smallest hash is kept,
the rightmost on ties, with its position. Texts that share a run of WINDOW + GRAM - 1 code points share a fingerprint.
A fingerprint is the comma-joined list of position:hash (eight hex digits) in order of position; equal texts have equal
ones. Likeness is the Jaccard similarity of two fingerprints' hash sets.

Edge cases: null is the empty text; an empty text has the empty fingerprint; a text shorter than a gram is one gram;
one with fewer grams than a window is one window; two empty fingerprints are alike (1), an empty one and another aren't (0);
rows of one id, or without an id, follow each other by a hash of their texts and are cut into ranges like any others; rows
that are equal in both stay together; an empty table gives no rows; long texts are hashed in parts.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm import bytetext
from gleaner.llm.common import stage

GRAM, WINDOW = 16, 48
#: Code points hashed at once.
PART = 1 << 20


def gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """A 32-bit hash of each run of gram code points, from rolling sums modulo 2**64."""
    gram = min(gram, len(codes))
    up, down = bytetext.powers(len(codes) + 1)
    prefix = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=prefix[1:])
    sums = (prefix[gram:] - prefix[: len(prefix) - gram]) * down[: len(codes) - gram + 1]
    return bytetext.mix(sums) >> np.uint64(32)


def selected(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of each window's smallest hash, rightmost on ties, without repetition.

    Hash and reversed position are packed into one number, so that one minimum settles both; minima over a window come
    from minima over powers of two.
    """
    n = len(hashes)
    window = min(window, n)
    packed = (hashes << np.uint64(31)) | (np.uint64((1 << 31) - 1) - np.arange(n, dtype=np.uint64))
    low, size = packed, 1
    while 2 * size <= window:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < window:
        low = np.minimum(low[: n - window + 1], low[window - size :])
    low = low[np.concatenate([[True], low[1:] != low[:-1]])]
    return (np.uint64((1 << 31) - 1) - (low & np.uint64((1 << 31) - 1))).astype(np.int64)


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(positions, 32-bit hashes) of the text's fingerprint."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    positions, kept = [], []
    step = PART
    for at in range(0, max(1, len(codes) - gram - window + 2), step):  # parts overlap by a window, so none is lost
        hashes = gram_hashes(codes[at : at + step + gram + window - 2], gram)
        own = selected(hashes, window)
        positions.append(own + at)
        kept.append(hashes[own])
    positions, kept = np.concatenate(positions), np.concatenate(kept)
    new = np.concatenate([[True], positions[1:] != positions[:-1]])
    return positions[new], kept[new]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def as_text(positions: np.ndarray, hashes: np.ndarray) -> str:
    return ",".join([f"{p}:{h:08x}" for p, h in zip(positions.tolist(), hashes.tolist())])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, fingerprint of every row, without any exchange."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([len(text)], pa.int64()), pa.array([as_text(*winnow(text))])], names=["id", "n_chars", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(bytetext.lean("winnow", run), f"id {docs.schema[id_col].dataType.simpleString()}, n_chars bigint, fingerprint string")


_PAIRS = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _pairs(batches):
    """Rows come by bucket in descending id; each waits for the next one. A ghost ends its bucket and gives no row."""
    out: list[tuple] = []
    last = None  # (bucket, id, text, positions, hashes)
    for batch in batches:
        buckets, ghosts, ids = (batch.column(i).to_pylist() for i in (0, 1, 2))
        texts = batch.column(3)
        for i, (bucket, ghost, doc) in enumerate(zip(buckets, ghosts, ids)):
            text = texts[i].as_py()
            own = winnow(text)
            if last is not None and last[0] == bucket:
                _, last_id, before, fp = last
                m = len(before) // 3
                edited = before[: len(before) - m] + text[:m]
                changed = winnow(edited)
                digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((last_id, len(before), digest, as_text(*fp), as_text(*changed), likeness(fp[1], changed[1]), likeness(fp[1], own[1])))
                if len(out) >= 256:
                    yield _rows(out)
                    out = []
            last = None if ghost else (bucket, doc, text, own)
    if out:
        yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in _PAIRS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


#: Rows of a range of ids, on average, up to MAX_BUCKETS ranges. A task streams its range, so a longer one takes more time
#: and no more memory.
BUCKET_ROWS = 4_096
MAX_BUCKETS = 65_536
#: Keys that are sampled for each cut between ranges.
SAMPLED = 20


def _order_key(k: Column, h: Column) -> Column:
    """(k, h) as text of one length, in their order."""
    unsigned = lambda x: F.lpad(F.hex(x.bitwiseXOR(F.lit(-(1 << 63)).cast("bigint"))), 16, "0")
    return F.concat(unsigned(k), unsigned(h))


def _cuts_above(key: Column, cuts: list[str]) -> Column:
    """How many of the ascending cuts are above key: first among every width-th cut, then inside one stretch of that width."""
    if not cuts:
        return F.lit(0)
    width = math.isqrt(len(cuts)) + 1
    listed = lambda values: F.split(F.lit(",".join(values)), ",")  # noqa: E731  one literal
    stretch = F.array_size(F.filter(listed(cuts[::width]), lambda c: c <= key))
    inside = F.array_size(F.filter(F.slice(listed(cuts), F.greatest((stretch - 1) * width + 1, F.lit(1)), F.lit(width)), lambda c: c <= key))
    return F.lit(len(cuts)) - F.when(stretch == 0, F.lit(0)).otherwise((stretch - 1) * width + inside)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text and the next document in descending id (after the last: the first).

    Ids, and hashes of texts within an id, are cut into ranges; a range's task sees its documents in order, and the first
    document of the range below as a ghost, so that texts move once and no task sees more than its range. Rows of one id
    follow each other in the order of their texts' hashes; rows without an id come last.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = rows.withColumn("k", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("bigint"))).withColumn("h", F.xxhash64("text"))
    total = rows.count()
    if not total:
        return docs.sparkSession.createDataFrame([], _PAIRS)
    parts = min(MAX_BUCKETS, max(1, round(total / BUCKET_ROWS)))
    cuts: list[str] = []
    if parts > 1:
        share = min(1.0, SAMPLED * parts / total)
        some = sorted(r[0] for r in keyed.sample(fraction=share, seed=20240313).select(_order_key(F.col("k"), F.col("h"))).collect())
        cuts = sorted({some[i * len(some) // parts] for i in range(1, parts)}) if some else []
    keyed = keyed.withColumn("bucket", _cuts_above(_order_key(F.col("k"), F.col("h")), cuts))
    heads = stage(keyed.groupBy("bucket").agg(F.max(F.struct("k", "h")).alias("head")).select("bucket", "head.k", "head.h"), "heads")
    order = [r.bucket for r in heads.select("bucket").orderBy("bucket").collect()]
    before = {b: order[i - 1] for i, b in enumerate(order)}  # the range above; the first range's head ends the last one
    to = docs.sparkSession.createDataFrame([(b, before[b]) for b in order], "bucket int, target int")
    ghost_keys = F.broadcast(heads.join(F.broadcast(to), "bucket"))
    ghosts = keyed.join(ghost_keys.withColumnRenamed("bucket", "b"), (F.col("bucket") == F.col("b")) & (keyed.k == ghost_keys.k) & (keyed.h == ghost_keys.h)).select(F.col("target").alias("bucket"), F.lit(True).alias("ghost"), "doc_id", "text", keyed.k.alias("k"), keyed.h.alias("h"))
    ghosts = ghosts.dropDuplicates(["bucket"])
    real = keyed.select("bucket", F.lit(False).alias("ghost"), "doc_id", "text", "k", "h")
    dealt = real.unionByName(ghosts).repartitionById(len(cuts) + 1, F.col("bucket")).sortWithinPartitions("bucket", "ghost", F.desc("k"), F.desc("h"))
    return dealt.select("bucket", "ghost", "doc_id", "text").mapInArrow(bytetext.lean("winnow", _pairs), _PAIRS)
