"""Features, training and scores against plain Python; held-out rows; the bounds of the sample."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from gleaner.llm import bytetext, toxicity
from gleaner.llm.registry import QUERIES

MASK = (1 << 64) - 1


def mix(x):
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & MASK
    return x ^ x >> 31


def word_hash(word):
    return mix(sum((b + 1) * pow(bytetext.BASE, i, 1 << 64) for i, b in enumerate(word)) & MASK)


def pair(a, b, salt):
    return mix((a * 0xD6E8FEB86659FD93 + mix((b + 0x9E3779B97F4A7C15 * (salt + 1)) & MASK)) & MASK)


def features(text):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    h = [word_hash(w) for w in re.findall(rb"[0-9a-z\x80-\xff]+", lower)]
    grams = h + [pair(a, b, 1) for a, b in zip(h, h[1:])] + [pair(a, b, 2) for a, b in zip(h, h[2:])]
    return sorted({g >> (64 - toxicity.BITS) for g in grams})


def train(rows):
    """FTRL-proximal, one coordinate at a time."""
    z, n = {}, {}
    weight = lambda i: 0.0 if i != toxicity.BIAS and abs(z.get(i, 0.0)) <= toxicity.L1 else -(z.get(i, 0.0) - math.copysign(0.0 if i == toxicity.BIAS else toxicity.L1, z.get(i, 0.0))) / ((toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2)
    for _ in range(toxicity.PASSES):
        for found, label in rows:
            spots = [*found, toxicity.BIAS]
            w = {i: weight(i) for i in spots}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for i in spots:
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / toxicity.ALPHA * w[i]
                n[i] = old + g * g
    return {i: weight(i) for i in z if weight(i)}


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(0, 40))) + (" You Vile é fool!" if i % 5 == 0 else "")) for i in range(300)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id bigint, toxic int")


def test_features_by_hand(corpus):
    rows, _, _ = corpus
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in rows]), pa.array([0] * len(rows)), pa.array(range(len(rows)))], names=["text", "label", "order"])
    got = [x for b in toxicity._extract([batch]) for x in b.column("features").to_pylist()]
    assert got == [features(t) for _, t in rows]


def test_training_and_scores_by_hand(spark, corpus):
    rows, docs, labels = corpus
    order = {r.id: r.o for r in spark.createDataFrame([(i,) for i, _ in rows], "id bigint").selectExpr("id", "xxhash64(id) AS o").collect()}
    want = train([(features(t), int(i % 5 == 0)) for i, t in sorted(rows, key=lambda r: order[r[0]])])
    got = dict(toxicity.fit(docs, labels, "doc_id", "text", "toxic"))
    assert set(got) == set(want) and np.allclose([got[i] for i in want], list(want.values()))
    scores = {r.id: r.score for r in toxicity.score(docs, list(got.items()), "doc_id", "text").collect()}
    for i, t in rows:
        assert scores[i] == pytest.approx(1 / (1 + math.exp(-sum(want.get(f, 0.0) for f in [*features(t), toxicity.BIAS]))))


def test_bounds_of_the_sample(spark, corpus):
    """An id of very many rows and very long texts stay within the bounds."""
    rows, _, labels = corpus
    docs = spark.createDataFrame(rows + [(0, f"you fool {i}") for i in range(500)], "doc_id bigint, text string")
    fitted = lambda **bound: toxicity.fit(docs, labels, "doc_id", "text", "toxic", **bound)
    assert fitted(max_bytes=0) == [] and fitted(max_rows=50) and fitted(max_bytes=5000) and fitted()


def test_held_out(spark, small):
    """Labels of the fold that isn't learned are told apart."""
    folder = small.replace("0.001", "0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    out = [(labels[r.doc_id], r.score, r.predicted) for r in QUERIES["op4_toxicity"](spark, folder).collect() if r.held_out and labels.get(r.doc_id) is not None]
    good, bad = [s for y, s, _ in out if not y], [s for y, s, _ in out if y]
    assert len(bad) > 20
    ranked = sum((a > b) + 0.5 * (a == b) for a in bad for b in good) / (len(bad) * len(good))
    assert ranked > 0.9 and sum(p for y, _, p in out if not y) <= 0.05 * len(good)
