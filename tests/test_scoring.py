import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.functions.keywords import KeywordMatcher, trie_regex
from gleaner.functions.simhash import FIRST, SECOND, simhash, simhash_bytes
from gleaner.functions.vectors import HashEncoder, VectorTableEncoder, distance, embed, is_relevant, literal
from gleaner.operators.counts import term_weights
from gleaner.operators.dedup import SeenSet, dedup, fifo_dedup, near_dedup_pairs
from gleaner.operators.select import EmbeddingSelector, KeywordSelector, select
from gleaner.operators.topk import bounded_topk


def score(spark, text, keywords):
    return spark.createDataFrame([(text,)], "x string").select(KeywordMatcher(keywords).score(F.col("x")).alias("y")).first().y


def test_keyword_scores(spark):
    assert score(spark, "gull tern tern", {"gull": 1.5, "tern": 2, "crab": 4}) == 5.5
    assert score(spark, "Gull TERNtern", ["tern", "gull"]) == 3
    assert score(spark, "ÉTÉ Été été", {"été": 2.0}) == 2.0 and score(spark, "K\u212a k\u017f", ["ks", "kk"]) == 0  # no Unicode folding
    assert score(spark, "É é", ["é"]) == 1  # A-Z alone are folded
    assert score(spark, "abcabd", ["ab", "abc", "c"]) == 2
    assert score(spark, "anything", []) == 0
    assert score(spark, "a+b (c) [d] {e}", ["a+b", "(c)", "[d]", "{e}"]) == 4


@given(st.lists(st.text("abc.", min_size=1, max_size=4), min_size=1, max_size=8), st.text("abc. ", max_size=40))
def test_trie_is_leftmost_longest(keywords, text):
    flat = re.compile("|".join(re.escape(k) for k in sorted(set(keywords), key=lambda k: (-len(k), k))))
    assert re.findall(trie_regex(keywords), text) == flat.findall(text)


def slow_simhash(b):
    votes = [0] * 64
    for i in range(1, len(b) - 1):
        h = (b[i - 1] << 32) ^ (b[i] << 16) ^ b[i + 1] ^ i
        h = ((h ^ h >> 33) * FIRST) % 2**64
        h = ((h ^ h >> 33) * SECOND) % 2**64
        h ^= h >> 33
        for k in range(64):
            votes[k] += 1 if h >> k & 1 else -1
    u = sum(1 << k for k in range(64) if votes[k] > 0)
    return u - 2**64 if u >= 2**63 else u


@given(st.binary(max_size=60))
def test_simhash_by_hand(b):
    assert simhash_bytes(b) == slow_simhash(b)


@pytest.mark.parametrize(("text", "fp"), [("", 0), ("ab", 0), ("abc", -7729334669053277957), ("gardening", -3567371223042180622), ("astronomy", -8979540482824859454), ("A momentum trading strategy", -6781974544229618275), ("héllo wörld", -3613614901867988028)])
def test_simhash_known(spark, text, fp):
    assert spark.createDataFrame([(text,)], "x string").select(simhash(F.col("x")).alias("y")).first().y == fp


def test_simhash_query_reads_whole_texts(spark, tmp_path):
    from gleaner.plans.catalog import QUERIES

    texts = ["word " * 100 + "a", "word " * 100 + "another end", "é" * 300, "ab", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.fingerprint for r in QUERIES["simhash_text"](spark, str(tmp_path)).collect()}
    assert got == {i: None if t is None else slow_simhash(t.encode()) for i, t in enumerate(texts)} and got[0] != got[1]


def test_seen_set():
    seen = SeenSet(2)
    assert [seen.admit(x) for x in "PQPRPQ"] == [True, True, False, True, True, True]


def pages(spark, rows):
    return spark.createDataFrame([(u, c, "eng", s) for u, c, s in rows], "uri string, content string, languages string, score double")


def test_dedup_keeps_the_better_page(spark):
    df = pages(spark, [("b", "same text", 1.0), ("a", "same text", 2.0), ("c", "other text", 0.0), ("d", "x", 0.0), ("e", "", 0.0)])
    assert sorted(r.uri for r in dedup(df).collect()) == ["a", "c", "d"]  # short contents share fingerprint 0


def test_dedup_query_tells_collisions_apart(spark, tmp_path):
    from gleaner.plans.catalog import ORACLES, QUERIES
    from gleaner.schema import CONTENT_BYTES

    long = "word " * 400
    texts = [long + "a", long + "b", long + "a", "a", "b", "", "a", None, None, "w" * CONTENT_BYTES, "w" * CONTENT_BYTES + "x", "tied"]
    assert simhash_bytes(texts[0].encode()) == simhash_bytes(texts[1].encode())
    rows = [(None, "tied", "en"), *[(i, t, "en") for i, t in enumerate(texts)]]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(ORACLES["dedup_pages"]).fetchall()
    got = [r.doc_id for r in QUERIES["dedup_pages"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((i for (i,) in want), key=str) == [0, 1, 10, 11, 3, 4, 5]


def test_fifo_dedup(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(["alpha", "alpha", "beta", "gamma", "alpha"])], "n int, content string")
    assert [r.n for r in fifo_dedup(df, "n", 2).orderBy("n").collect()] == [0, 2, 3, 4]


def test_hamming_pairs(spark):
    base = "word " * 40
    df = spark.createDataFrame([(1, base + "a"), (2, base + "b"), (3, "quite another text")], "k int, content string")
    pairs = {(r.left, r.right) for r in near_dedup_pairs(df, "k").collect()}
    bits = bin((simhash_bytes((base + "a").encode()) ^ simhash_bytes((base + "b").encode())) % 2**64).count("1")
    assert pairs == ({(1, 2)} if bits <= 3 else set())


def test_near_dedup_has_every_document(spark, tmp_path):
    from gleaner.plans.catalog import QUERIES

    long = "word " * 3000
    texts = {5: "some text here", 3: "some text here", 9: "some text here", 4: "quite another text", 7: long + "a", 8: long + "quite another end of this text " * 400}
    spark.createDataFrame(list(texts.items()), "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    prints = {k: simhash_bytes(t.encode()) for k, t in texts.items()}
    first = {k: min(j for j in prints if prints[j] == prints[k]) for k in prints}
    apart = {(a, b): ((prints[a] ^ prints[b]) % 2**64).bit_count() for a in set(first.values()) for b in set(first.values()) if a < b}
    got = {(r.left, r.right, r.bits) for r in QUERIES["near_dedup_hamming"](spark, str(tmp_path)).collect()}
    assert got == {(first[k], k, 0) for k in prints} | {(a, b, n) for (a, b), n in apart.items() if n <= 3}
    assert first[9] == 3 and first[8] == 8


@pytest.mark.parametrize(("scores", "k", "ascending", "best"), [([7.0, 3.0, 1.5, 2.5], 2, True, [1.5, 2.5]), ([7.0, 3.0, 1.5, 2.5], 2, False, [7.0, 3.0]), ([4.0, 2.0, 6.0], 5, True, [2.0, 4.0, 6.0]), ([], 2, True, [])])
def test_topk(spark, scores, k, ascending, best):
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(scores)], "uri string, score double")
    assert [r.score for r in bounded_topk(df, "score", k, ascending).collect()] == best
    assert "TakeOrderedAndProject" in df.orderBy("score").limit(k)._jdf.queryExecution().executedPlan().toString()


def test_keyword_selection(spark):
    df = pages(spark, [("a", "ebb tide", 0.0), ("b", "tide tables", 0.0), ("c", "dry land", 0.0)])
    got = select(KeywordSelector(KeywordMatcher(["tide"]), 2), df).collect()
    assert [(r.uri, r.score) for r in got] == [("a", 1.0), ("b", 1.0)]


def test_embedding_selection(spark):
    df = pages(spark, [("a", "shore shore sea", 0.0), ("b", "desert", 0.0)])
    got = select(EmbeddingSelector("sea shore", HashEncoder(), 10), df).collect()
    assert [r.uri for r in got] == ["a", "b"] and got[0].score < got[1].score
    assert [r.uri for r in select(EmbeddingSelector("sea shore", HashEncoder(), 10, threshold=0.6), df).collect()] == ["a"]


def test_relevance_is_inclusive(spark):
    row = spark.range(1).select(is_relevant(literal([1.0, 0.0]), literal([0.6, 0.8])).alias("a"), distance(literal([1.0, 0.0]), literal([0.6, 0.8])).alias("d")).first()
    assert row.a and abs(row.d - 0.4) < 1e-12


def test_encoders(spark, tmp_path):
    assert np.allclose(np.linalg.norm(HashEncoder().encode(["a b c"]), axis=1), 1)
    assert not HashEncoder().encode([""]).any()
    with pytest.raises(FileNotFoundError):
        VectorTableEncoder(str(tmp_path / "none"))
    (tmp_path / "tokens.txt").write_text("sea\nshore\n")
    np.save(tmp_path / "vectors.npy", np.eye(2))
    got = spark.createDataFrame([("sea shore",), ("",)], "x string").select(embed(F.col("x"), VectorTableEncoder(str(tmp_path))).alias("v")).collect()
    assert np.allclose(got[0].v, [0.5**0.5] * 2) and not any(got[1].v)


def test_term_weights(spark):
    df = spark.createDataFrame([("b a a a a",), ("b c",)], "x string")
    got = term_weights(df, F.col("x"), 2).collect()
    assert [(r.token, r["count"]) for r in got] == [("a", 4), ("b", 2)] and np.allclose([r.weight for r in got], [0.5, 0.5**0.5])
