"""Every column of the comparison against plain Python, ids that repeat or lack included."""

import hashlib
import random

import pytest

from gleaner.llm import winnow
from gleaner.llm.registry import QUERIES


def grams(text):
    k = min(winnow.GRAM, len(text))
    codes = [ord(c) + 1 for c in text]
    base, mask = winnow.bytetext.BASE, (1 << 64) - 1

    def mix(x):
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & mask
        return (x ^ x >> 31) >> 32

    powers = [pow(base, i, 1 << 64) for i in range(k)]
    return [mix(sum(c * p for c, p in zip(codes[i : i + k], powers)) & mask) for i in range(len(text) - k + 1)] if text else []


def fingerprint(text):
    h = grams(text)
    w = min(winnow.WINDOW, len(h))
    spots = []
    for i in range(len(h) - w + 1 if h else 0):
        low = min(h[i : i + w])
        p = max(j for j in range(i, i + w) if h[j] == low)
        if not spots or spots[-1] != p:
            spots.append(p)
    return ",".join(f"{p}:{h[p]:08x}" for p in spots), {h[p] for p in spots}


def like(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def compared(text, after):
    m = len(text) // 3
    edited = text[: len(text) - m] + after[:m]
    (fp, own), (changed, other), (_, next_) = fingerprint(text), fingerprint(edited), fingerprint(after)
    return len(text), hashlib.sha256(edited.encode()).hexdigest(), fp, changed, like(own, other), like(own, next_)


def told(rows):
    return sorted((r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in rows)


def test_query_by_hand(spark, small):
    texts = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{small}/documents.parquet").collect()), reverse=True)
    texts = [(i, t[:3000]) for i, t in texts][:80]
    got = winnow.compare_with_next(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert told(got) == sorted(compared(t, texts[(i + 1) % len(texts)][1]) for i, (_, t) in enumerate(texts))
    whole = QUERIES["op7_fingerprints"](spark, small)
    assert whole.count() == spark.read.parquet(f"{small}/documents.parquet").count()


@pytest.mark.parametrize("bucket", [3, 4096])
def test_ids_that_repeat_or_lack(spark, monkeypatch, bucket):
    """Any number of rows of one id is cut into ranges; within an id the order is that of the texts' hashes."""
    monkeypatch.setattr(winnow, "BUCKET_ROWS", bucket)
    draw = random.Random(9)
    text = lambda: " ".join(draw.choice(["wind", "sand", "wave", "shore", "é😀"]) for _ in range(draw.randint(0, 30)))
    rows = [(None, text()) for _ in range(40)] + [(7, text()) for _ in range(40)] + [(i, text()) for i in range(20)] + [(9, "twin")] * 5 + [(-(2**63), "least")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "xxhash64(text) AS h", "'clash' AS bucket", "'clash' AS k")
    order = sorted(((r.doc_id if r.doc_id is not None else -(2**63), r.h, r.text) for r in df.collect()), reverse=True)
    got = winnow.compare_with_next(df).collect()
    assert told(got) == sorted(compared(t, order[(i + 1) % len(order)][2]) for i, (_, _, t) in enumerate(order))
