"""Lists that fill several levels and several parts, and hosts of very many labels, against sets."""

import pytest
from pyspark.sql import functions as F

from gleaner.llm import q_urlfilter, urlfilter


@pytest.mark.parametrize(("bits", "at_once"), [(1 << 24, 16), (12_000, 2)])
def test_listed_keys(spark, monkeypatch, bits, at_once):
    """Membership of every host, domain and page is exact, whatever the list's length and the levels' mistakes."""
    monkeypatch.setattr(urlfilter, "MAX_BITS", bits)
    monkeypatch.setattr(urlfilter, "PARTS_AT_ONCE", at_once)
    urls = [(i, f"http://a{i % 7}.h{i}.net/p/{i}") for i in range(4000)]
    listed = {f"h{i}.net" for i in range(0, 9000, 5)} | {f"a{i % 7}.h{i}.net/p/{i}" for i in range(0, 4000, 11)} | {"net.", ""}
    df = spark.createDataFrame(urls, "page_id bigint, url string")
    out = urlfilter.judge_urls(df, spark.createDataFrame([(k,) for k in sorted(listed)], "key string"), [])
    got = {r.page_id for r in out.collect() if r.listed}
    assert got == {i for i in range(4000) if i % 5 == 0 or i % 11 == 0}


def test_levels_of_the_registered_list(spark, small):
    host, path = urlfilter.host_and_path(F.col("url"))
    pages = spark.read.parquet(f"{small.replace('0.001', '0.1')}/pages.parquet").select(host.alias("h"), path.alias("p"))
    universe = pages.select(F.explode(urlfilter.keys_of(F.col("h"), F.col("p"), 3)).alias("key"))
    (cascade,) = urlfilter.build_cascades(q_urlfilter.block_list(spark, small.replace("0.001", "0.1")), universe)
    assert len(cascade.levels) >= 4 and cascade.levels[0].bits > 400_000


def test_very_long_urls(spark):
    rows = [(1, "http://" + "a." * 100_000 + "bad.com/" + "x" * 100_000), (2, "http://bad.com" + "." * 100_000), (3, "http://x.bad.com/p?" + "q" * 100_000)]
    listed = spark.createDataFrame([("bad.com",), ("x.bad.com/p",)], "key string")
    got = {r.page_id: r.listed for r in urlfilter.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string"), listed, []).collect()}
    assert got == {1: True, 2: False, 3: True}
