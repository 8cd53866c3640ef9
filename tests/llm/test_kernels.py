"""The numpy kernels against plain Python."""

import re
import struct

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleaner.llm import bytetext, decontaminate, langid, minhash, packing, secrets, sharding, toxicity, winnow

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.text("abC d\n\té ", max_size=30), min_size=1, max_size=8)


def lower(x):
    return "".join(c.lower() if c < "\x80" else c for c in x)


def shingles(text, size):
    w = WORD.findall(lower(text))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


@settings(deadline=None, max_examples=60)
@given(TEXTS, st.sampled_from([1, 2, 5]), st.sampled_from([8, 1 << 20]))
def test_shingle_sets(texts, size, block):
    seen = {}
    for at, end, raw, offsets in bytetext.blocks(pa.array(texts), block):
        values, bounds = minhash.shingle_sets(raw, offsets, size)
        for r in range(at, end):
            own = values[bounds[r - at] : bounds[r - at + 1]]
            want = shingles(texts[r], size)
            assert len(own) == len(want)
            assert seen.setdefault(frozenset(want), own.tobytes()) == own.tobytes()


def test_long_text_in_parts(monkeypatch):
    text = "alpha beta  gamma " * 400
    raw, offsets = np.frombuffer(text.encode(), np.uint8), np.array([0, 0, len(text)])
    whole = bytetext.words(raw, offsets, bytetext.SPACE)
    monkeypatch.setattr(bytetext, "BLOCK_BYTES", 64)
    parts = bytetext.words(raw, offsets, bytetext.SPACE)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts)) and len(whole[0]) == 1200


def test_circulant_signature():
    pi = np.random.default_rng(20240229).permutation(minhash.PLACES)
    values = np.arange(1, 40, dtype=np.uint64) * np.uint64(77777777777)
    got = minhash.signatures(values, np.array([0, 39, 39]))
    places = (bytetext.mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(44)).astype(int)
    for k in (0, 1, 77, minhash.COORDINATES - 1):
        assert got[0, k] == min(pi[(p + k) % minhash.PLACES] for p in places)
    assert not got[1].any()


@settings(deadline=None, max_examples=40)
@given(st.lists(st.integers(1, 50), max_size=120), st.sampled_from([1, 3, 1000]))
def test_best_fit(lengths, limit):
    bins, offsets = packing.best_fit(lengths, 50, limit)
    fill = {}
    for b, o, n in zip(bins.tolist(), offsets.tolist(), lengths):
        assert o == fill.get(b, 0)
        fill[b] = o + n
    assert all(x <= 50 for x in fill.values())
    if limit == 1000 and lengths:  # unbounded best fit never leaves two bins that would fit in one
        assert sum(2 * x <= 50 for x in fill.values()) <= 1


def test_tokens_equal_the_tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    whole, own = Tokenizer.from_file(path), packing.ChunkEncoder(path)
    letters = "abC'sStrevmld 09²¼ÀéßµªÿΣσςİıá\x85\x1c\x1f\t\n _!<|endoftext|>×÷日本\xa0\xad"

    @settings(deadline=None, max_examples=60)
    @given(st.lists(st.text(letters, max_size=30), min_size=1, max_size=5))
    def same(texts):
        texts = texts + [texts[0] + "<|endoftext|>", "It's I'LL <|ENDOFTEXT|>"]
        for raw, e in zip(own.encode(texts), whole.encode_batch(texts, add_special_tokens=False)):
            assert list(struct.unpack(f"<{len(raw) // 4}I", raw)) == e.ids

    same()


def test_communication_matrix():
    m = sharding.communication_matrix([10, 0, 7, 100], 8, 3)
    assert m.sum(axis=1).tolist() == [10, 0, 7, 100] and sorted(m.sum(axis=0).tolist()) == [14] * 3 + [15] * 5
    draw = np.random.default_rng(1)
    x = np.array([sharding.hypergeometric(draw, 30, 70, 40) for _ in range(4000)])
    assert abs(x.mean() - 12) < 0.2 and abs(x.var() - 5.09) < 0.5
    assert 0 <= sharding.hypergeometric(draw, 10**12, 10**12, 100) <= 100


@settings(deadline=None, max_examples=60)
@given(st.text("abé😀", max_size=80), st.sampled_from([11, 1 << 20]))
def test_winnowing(text, part):
    winnow.PART = part
    g, w = 4, 7
    codes = [ord(c) for c in text]
    want = []
    if codes:
        k = min(g, len(codes))
        h = [int(winnow.gram_hashes(np.array(codes[i : i + k], dtype=np.uint32), k)[0]) for i in range(len(codes) - k + 1)]
        size = min(w, len(h))
        for i in range(len(h) - size + 1):
            low = min(h[i : i + size])
            p = max(j for j in range(i, i + size) if h[j] == low)
            if not want or want[-1] != p:
                want.append(p)
    assert winnow.winnow(text, g, w)[0].tolist() == want
    winnow.PART = 1 << 20


@settings(deadline=None, max_examples=80)
@given(st.lists(st.integers(0, 5), max_size=30), st.lists(st.integers(0, 5), max_size=30))
def test_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert decontaminate.common_subsequence(decontaminate._masks(a), b) == table[-1][-1]


def test_trigram_sums(monkeypatch):
    texts = ["", "ab", "abc", "abcd é", "x" * 50]
    weights = np.random.default_rng(0).standard_normal((langid.DIMS, 2))
    for size in (1 << 20, 7):
        monkeypatch.setattr(bytetext, "BLOCK_BYTES", size)
        for at, end, raw, offsets in bytetext.blocks(pa.array(texts), 1 << 20):
            got = langid.trigram_sums(raw, offsets, weights)
            for r in range(at, end):
                own = texts[r].encode()
                want = sum(weights[langid.grams(np.frombuffer(own[i : i + 3], np.uint8))[0]] for i in range(len(own) - 2)) / max(1, len(own) - 2)
                assert np.allclose(got[r], want)


def test_ftrl_is_sparse_and_separates():
    draw = np.random.default_rng(0)
    rows = [(np.unique(np.append(draw.integers(10, 5000, 40), [1, 2] if y else [])).astype(np.int64), y) for y in (draw.random(800) < 0.2).astype(int)]
    some, weights = toxicity.ftrl(rows)
    at = dict(zip(some.tolist(), weights.tolist()))
    assert at[1] > 1 and at[2] > 1 and at[toxicity.BIAS] < 0 and len(at) < 200


def test_false_discovery_thresholds():
    assert secrets.thresholds({(5, 0): 90, (5, 60): 10}) == {5: 1 + max(b for b in range(120) if 10 ** (-b / 10) * 100 > 0.05 * 10)}
    assert secrets.thresholds({(5, 0): 3}) == {5: secrets.BINS + 1}
