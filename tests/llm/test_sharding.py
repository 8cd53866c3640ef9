"""The drawn counts against exact probabilities, and shuffles of rows that are all alike."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import sharding
from gleaner.llm.registry import QUERIES


@pytest.mark.parametrize(("good", "bad", "n"), [(5, 9, 6), (40, 3, 20), (1, 1, 1), (300, 700, 120)])
def test_hypergeometric_by_exact_probabilities(good, bad, n):
    draw = np.random.default_rng(7)
    seen = collections.Counter(sharding.hypergeometric(draw, good, bad, n) for _ in range(20_000))
    exact = {k: math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n) for k in range(max(0, n - bad), min(n, good) + 1)}
    assert set(seen) <= set(exact)
    likely = [k for k, p in exact.items() if p > 1e-3]
    assert sum((seen[k] - 20_000 * exact[k]) ** 2 / (20_000 * exact[k]) for k in likely) < len(likely) + 5 * math.sqrt(2 * len(likely)) + 5


def test_hypergeometric_of_huge_populations():
    draw = np.random.default_rng(8)
    x = np.array([sharding.hypergeometric(draw, 10**13, 7 * 10**13, 16_384) for _ in range(4000)])
    # As many draws as that are binomial to within the noise.
    assert abs(x.mean() - 2048) < 4 and abs(x.var() / (2048 * 7 / 8) - 1) < 0.1


def test_equal_rows_spread(spark):
    df = spark.range(40_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("same").alias("text"))
    placed = sharding.shard(df, ["doc_id", "text"], shards=8)
    by = {r["shard"]: (r["n"], r["low"], r["high"], r["slots"]) for r in placed.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high"), F.countDistinct("slot").alias("slots")).collect()}
    assert by == {s: (5000, 0, 4999, 5000) for s in range(8)}


def test_query_against_its_table(spark, small):
    """Sizes, checksums, gapless slots; shards as equal as can be; no order of the input left."""
    import zlib

    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = QUERIES["op10_sharding"](spark, small).collect()
    assert sorted((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in got) == sorted((i, len(t) + 1, zlib.crc32(t), "rows", None) for i, t in texts.items())
    shards = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r.slot):
        assert r.slot == len(shards[r.shard])
        shards[r.shard].append(r.doc_id)
    sizes = sorted(map(len, shards.values()))
    assert len(sizes) == 8 and sizes[-1] - sizes[0] <= 1
    order = [i for s in range(8) for i in shards[s]]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.25
