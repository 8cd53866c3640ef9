"""Latent semantic retrieval: its parts by hand, and its recall against a search without the cosine's bound."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleaner.llm import decontaminate


def test_rayleigh_ritz_gives_singular_vectors():
    draw = np.random.default_rng(0)
    a = draw.standard_normal((60, 8)) @ np.diag([9, 7, 5, 3, 0.1, 0.1, 0.1, 0.1]) @ np.linalg.qr(draw.standard_normal((8, 8)))[0] @ draw.standard_normal((8, 40))
    product = draw.standard_normal((40, 12))
    for _ in range(2):
        basis = np.linalg.qr(product)[0]
        product = a.T @ (a @ basis)
    got = decontaminate.rayleigh_ritz(basis, product, 3)
    want = np.linalg.svd(a)[2][:3]
    assert np.allclose(np.abs((got.T @ want.T).diagonal()), 1, atol=1e-6)


@pytest.mark.parametrize("n", [1, 8, 24, 25, 40, 41, 57, 300])
def test_item_windows_cover_an_item(n):
    spans = decontaminate.item_windows(n)
    assert spans[0][0] == 0 and spans[-1][1] == n and all(b - a == min(n, decontaminate.WINDOW) for a, b in spans)
    assert all(b - a <= decontaminate.ITEM_STRIDE for (a, _), (b, _) in zip(spans, spans[1:]))


@pytest.fixture(scope="module")
def corpus(spark, small):
    """Background texts, and each benchmark item hidden in one at each share of replaced words, the answer kept."""
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").limit(60).collect() if r.text]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").orderBy("item_id").collect()]
    pool = " ".join(texts).split()
    draw = np.random.default_rng(3)
    rows = list(enumerate(texts))
    planted = {}
    for share in (0.0, 0.1, 0.2, 0.3):
        for item, text in items:
            words = text.split()
            swap = draw.choice(max(1, len(words) - 6), min(int(share * len(words)), len(words) - 6), replace=False)
            for i in swap:
                words[i] = pool[draw.integers(len(pool))]
            before, after = (" ".join(pool[k : k + 30 + draw.integers(8)]) for k in draw.integers(0, len(pool) - 40, 2))
            planted[1000 + len(planted)] = (share, item)
            rows.append((999 + len(planted), f"{before} {' '.join(words)} {after}"))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), planted


def test_recall_against_brute_force(corpus):
    """The bound on the cosine loses at most one in a hundred of the leaks that the checks on words confirm."""
    docs, items, planted = corpus
    got = {r.doc_id for r in decontaminate.leaks(docs, items).collect()}
    every = {r.doc_id for r in decontaminate.leaks(docs, items, cosine=-9.0).collect()}
    assert got <= every and len(got) >= 0.99 * len(every)
    assert {d for d, (share, _) in planted.items() if share == 0.0} <= got
    assert len([d for d in planted if d in got]) >= 0.98 * len(planted)


def test_blocks_of_items_find_the_same(corpus, monkeypatch):
    docs, items, _ = corpus
    said = lambda: sorted((r.doc_id, r.share) for r in decontaminate.leaks(docs.union(docs), items).collect())
    whole = said()
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 3000)
    assert said() == whole and len(whole) % 2 == 0


def test_short_and_long_items(spark):
    words = [f"w{i}x{i * i % 97}" for i in range(400)]
    noise = [f"n{i}" for i in range(300)]
    items = [(1, "one two three four five"), (2, " ".join(words)), (3, "two words"), (4, "red green blue")]
    rows = [
        (10, " ".join(noise + ["One,", "two", "three", "four", "five"] + noise)),
        (11, "one two three five four"),
        (12, " ".join(noise[:50] + words + noise)),
        (13, " ".join(words[:150])),  # too little of a long item
        (14, "these two words"),
        (15, "Red green blue"),
        (16, "red green"),
        (17, "x red green"), (18, "blue y"),  # a sequence doesn't run on into the next row
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("share", F.lit("clash"))
    got = {r.doc_id: (r.item_id, r.share) for r in decontaminate.leaks(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == {10: (1, 1.0), 12: (2, 1.0), 15: (4, 1.0)}


def rare_leaks():
    """Thousands of plain documents, and twelve that each hold an item whose words are nowhere else."""
    items = [(i, " ".join(f"q{i}x{k * k + 7 * i}" for k in range(20))) for i in range(12)]
    plain = "the of and to in is that it was for on are with as his they be at one have".split()
    rows = [(100 + i, " ".join(plain[(i * k) % 20] for k in range(1, 10))) for i in range(6000)]
    return rows + [(i, f"the of and {text} to in is") for i, text in items], items


def test_words_of_few_documents_are_in_the_space(spark, monkeypatch):
    """The space is fitted on every document and on the items of every block."""
    rows, items = rare_leaks()
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 400)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.item_id, r.share) for r in decontaminate.leaks(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == {i: (i, 1.0) for i, _ in items}


def test_products_over_all_passages():
    """Sums by runs, parts and slices are those of the TF-IDF matrix written out."""
    draw = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in np.minimum(draw.zipf(1.3, n), 500)) for n in (0, 1, 7, 8, 30, 900)]
    idf = draw.random(decontaminate.FEATURES, dtype=np.float32) + np.float32(0.1)
    right = draw.standard_normal((decontaminate.FEATURES, 5), dtype=np.float32)
    passages = []
    for _, _, hashes, first in decontaminate._words(pa.array(texts)):
        for a, b in zip(first[:-1], first[1:]):
            passages += [np.bincount(decontaminate.feature(hashes[s : min(s + decontaminate.WINDOW, b)]), minlength=decontaminate.FEATURES) * idf for s in range(a, b, decontaminate.STRIDE)]
    matrix = np.array([p / np.linalg.norm(p) for p in passages])
    want = matrix.T @ (matrix @ right)
    for part in (decontaminate.PART, 16):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(decontaminate, "PART", part)
            found = list(decontaminate._products(idf, right)([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])]))
        got = np.concatenate([np.frombuffer(r.column(1)[0].as_buffer(), "<f4").reshape(-1, 5) for r in found])
        assert np.allclose(got, want, rtol=1e-4, atol=1e-4)


def test_short_texts_are_multiplied_together(monkeypatch):
    """Blocks of text go through the products many at a time, and the sums stay those of one block at a time."""
    draw = np.random.default_rng(6)
    texts = pa.array([" ".join(f"w{i}" for i in draw.integers(0, 3000, n)) for n in draw.integers(0, 400, 800)])
    idf = draw.random(decontaminate.FEATURES, dtype=np.float32) + np.float32(0.1)
    right = draw.standard_normal((decontaminate.FEATURES, 7), dtype=np.float32)
    calls, real = [], decontaminate._squared_lengths
    monkeypatch.setattr(decontaminate, "_squared_lengths", lambda *given: calls.append(1) or real(*given))

    def summed():
        calls.clear()
        found = list(decontaminate._products(idf, right)([pa.RecordBatch.from_arrays([texts], names=["text"])]))
        return np.concatenate([np.frombuffer(r.column(1)[0].as_buffer(), "<f4").reshape(-1, 7) for r in found])

    blocks = len(list(decontaminate._words(texts)))
    together = summed()
    assert blocks >= 6 and len(calls) <= blocks / 2
    monkeypatch.setattr(decontaminate, "GATHERED", 1, raising=False)
    monkeypatch.setattr(decontaminate, "COLUMNS", 3, raising=False)
    assert np.allclose(summed(), together, rtol=1e-4, atol=1e-4) and len(calls) == blocks
