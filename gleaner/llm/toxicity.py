"""Toxicity by FTRL-proximal logistic regression (operator 4).

Features are presences of hashed words, word pairs and pairs with one word skipped, over the whole text (A-Z
lower-cased; a word is a run of ASCII letters, digits and non-ASCII bytes). Each coordinate has its own learning rate,
and L1 keeps most weights at zero, so that what scoring needs is a short list of buckets.

Training takes at most `max_rows` labelled documents, those with the smallest hash of their id, and of these as many whole
texts as come to at most `max_bytes` (both are the operator's parameters); features are extracted on executors and the
passes run in one task over that bounded sample. Scoring reads whole texts of all rows.

Edge cases: null and empty texts score by the bias alone; rows with a null label or id don't train; without labelled
rows every score is 0.5; a document that is labelled twice trains twice, and of rows that share an id only as many as the
bounds allow train; ties go to the smaller id and label; an empty table gives no rows; very long texts are scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm import bytetext
from gleaner.llm.common import spread

BITS = 22
MAX_ROWS, MAX_BYTES = 10_000, 64 << 20
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.1
PASSES = 3
#: The index of the bias, which L1 leaves alone.
BIAS = 1 << BITS


def feature_positions(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words, pairs and skip pairs: (bucket at each position, row of the position)."""
    hashes, _, first = bytetext.words(raw, offsets, bytetext.NON_WORD)
    row = bytetext.segment_ids(first)
    shift = np.uint64(64 - BITS)
    out = [((hashes >> shift).astype(np.int64), row)]
    for gap in (1, 2):
        if len(hashes) > gap:
            same = row[gap:] == row[:-gap]
            out.append(((bytetext.pair(hashes[:-gap][same], hashes[gap:][same], gap) >> shift).astype(np.int64), row[gap:][same]))
    return out


def _extract(batches):
    for batch in batches:
        for at, end, raw, offsets in bytetext.blocks(batch.column("text")):
            spots = feature_positions(raw, offsets)
            key = np.unique(np.concatenate([r.astype(np.int64) << 32 | b for b, r in spots]))
            bounds = np.searchsorted(key >> 32, np.arange(end - at + 1)).astype(np.int32)
            features = pa.ListArray.from_arrays(pa.array(bounds), pa.array((key & 0xFFFFFFFF).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("label").slice(at, end - at), batch.column("order").slice(at, end - at), features], names=["label", "order", "features"])


def ftrl(rows: list[tuple[np.ndarray, int]], passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights) that are not zero, the bias included, after passes over the rows in turn."""
    z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)
    lasso = np.full(BIAS + 1, L1)
    lasso[BIAS] = 0.0
    for _ in range(passes):
        for features, label in rows:
            at = np.append(features, BIAS)
            zi, ni = z[at], n[at]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) > lasso[at], -(zi - np.sign(zi) * lasso[at]) / ((BETA + root) / ALPHA + L2), 0.0)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            if g:
                z[at] = zi + g - (np.sqrt(ni + g * g) - root) / ALPHA * w
                n[at] = ni + g * g
    w = np.where(np.abs(z) > lasso, -(z - np.sign(z) * lasso) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)
    some = np.flatnonzero(w)
    return some, w[some]


def _train(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    table = table.sort_by("order").combine_chunks()
    lists = table.column("features").chunk(0) if table.num_rows else pa.array([], pa.list_(pa.int32()))
    bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    labels = table.column("label").to_pylist()
    buckets, weights = ftrl([(values[bounds[i] : bounds[i + 1]], y) for i, y in enumerate(labels)])
    return pa.table({"bucket": pa.array(buckets, pa.int32()), "weight": pa.array(weights)})


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> list[tuple[int, float]]:
    """Non-zero weights by bucket: at most 2**BITS + 1, usually a few thousand."""
    order = F.xxhash64("id")
    some = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label is not null").withColumn("order", order).orderBy("order", "id", "label").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(some), "id").select("text", "label", "order", F.xxhash64("text").alias("h"))
    # Where the texts of all chosen rows are within both bounds, nothing is left out.
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    if facts.n > max_rows or (facts.bytes or 0) > max_bytes:
        first = rows.select("order", "h", F.octet_length("text").alias("size")).orderBy("order", "h").limit(max_rows)
        last = first.withColumn("sum", F.sum("size").over(Window.orderBy("order", "h"))).where(F.col("sum") <= max_bytes).agg(F.max(F.struct("order", "h")).alias("m")).first().m
        rows = rows.where("false") if last is None else rows.where((F.col("order") < last["order"]) | (F.col("order") == last["order"]) & (F.col("h") <= last["h"])).orderBy("order", "h").limit(max_rows)
    features = spread(rows.select("text", "label", "order")).mapInArrow(bytetext.lean("toxicity", _extract), "label int, order bigint, features array<int>")
    weights = features.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_train, "bucket int, weight double")
    return [(r.bucket, r.weight) for r in weights.collect()]


def _score(weights: list[tuple[int, float]]):
    table = np.zeros(BIAS + 1)
    for b, w in weights:
        table[b] = w
    used = table != 0

    def run(batches):
        for batch in batches:
            for at, end, raw, offsets in bytetext.blocks(batch.column("text")):
                total = np.full(end - at, table[BIAS])
                hits = [r[used[b]].astype(np.int64) << 32 | b[used[b]] for b, r in feature_positions(raw, offsets)]
                key = np.unique(np.concatenate(hits))  # presence: a feature counts once a row
                np.add.at(total, key >> 32, table[key & 0xFFFFFFFF])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], names=["id", "score"])

    return bytetext.lean("toxicity", run)


def score(docs: DataFrame, weights: list[tuple[int, float]], id_col: str, text_col: str) -> DataFrame:
    """id and score (0 to 1) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return spread(rows).mapInArrow(_score(weights), f"id {docs.schema[id_col].dataType.simpleString()}, score double")
