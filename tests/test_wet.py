import gzip
import io

import pytest

from gleaner.sources.wet import read_paths, read_wet, records, resolve, truncated


def record(uri, body, languages="eng", kind="conversion", length=None, date="2026-03-03T00:00:00Z"):
    body = body if isinstance(body, bytes) else body.encode()
    lines = ["WARC/1.0", f"WARC-Type: {kind}"] + ([f"WARC-Target-URI: {uri}"] if uri else []) + ([f"WARC-Date: {date}"] if date else []) + ([f"WARC-Identified-Content-Language: {languages}"] if languages is not None else [])
    lines.append(f"Content-Length: {len(body) if length is None else length}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("members", [True, False])
def test_language_filter(spark, tmp_path, members):
    parts = [record("a", "dry land", "ita")] * 50 + [record("b", "ebb", "deu"), record("c", "ebb tide", "fra,deu")]
    path = tmp_path / "lang.wet.gz"
    path.write_bytes(b"".join(gzip.compress(p) for p in parts) if members else gzip.compress(b"".join(parts)))
    got = read_wet(spark, str(path), languages=["deu"]).collect()
    assert [(r.uri, r.content, r.languages) for r in got] == [("b", "ebb", "deu"), ("c", "ebb tide", "fra,deu")]
    assert str(got[0].date) == "2026-03-03 00:00:00" and got[0].length == 3 and got[0].score == float("inf")
    assert read_wet(spark, str(path)).count() == 52
    assert read_wet(spark, str(path), languages=[]).count() == 0


def test_edges():
    long = "é" * 7000
    head = b"WARC/1.0\r\nWARC-Type: conversion\r\nWARC-Target-URI: first\r\nWARC-Target-URI: second\r\nWARC-Date: 2026-03-03T00:00:00Z\r\nContent-Length: 0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    stream = io.BytesIO(
        record("inner", "x\r\nWARC/1.0\r\ny") + record("", "no uri") + record("nodate", "z", date=None) + record("empty", "") + record("info", "w", kind="warcinfo") + head + record("bad", b"a\xffb") + record("long", long) + record("nolang", "q", languages=None) + record("digits", "q", length="1x") + record("short", "cut", length=99999)
    )
    got = {r[0]: r for r in records(stream)}
    assert set(got) == {"inner", "first", "bad", "long", "nolang"}
    assert got["inner"][1] == "x\r\nWARC/1.0\r\ny" and got["first"][1] == "abc" and got["bad"][1] == "ab"
    assert got["long"][1] == "é" * 6000 and got["long"][4] == 14000 and got["nolang"][2] == ""
    assert not list(records(io.BytesIO(record("nolang", "q", languages=None)), ["eng"]))


def test_repeated_and_unreadable_fields():
    head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Type: conversion\r\nWARC-Target-URI: twice\r\nWARC-Date: 2026-03-03T00:00:00Z\r\nWARC-Identified-Content-Language: ita\r\nWARC-Identified-Content-Language: fra,deu\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    inner = record("inner", "q").decode()
    for wanted, languages in ((["deu"], "fra,deu"), (None, "ita")):
        assert [(r[0], r[1], r[2]) for r in records(io.BytesIO(head), wanted)] == [("twice", "abc", languages)]
    assert not list(records(io.BytesIO(head), ["eng"]))
    # A length that can't be read still frames the body by its digits.
    assert not list(records(io.BytesIO(record("outer", inner, length=f"{len(inner)}x"))))


@pytest.mark.parametrize(("raw", "n", "want"), [(b"a\xe2\x82\xac", 3, 1), (b"\xe2\x82\xac", 2, 0), (b"\xc3\xa9x", 2, 2), (b"abc", 9, 3)])
def test_boundary(raw, n, want):
    assert len(truncated(raw, n)) == want


def test_paths(spark, tmp_path):
    index = tmp_path / "wet.paths.gz"
    index.write_bytes(gzip.compress(b"one.wet.gz\n two \nunfinished"))
    assert resolve(str(index), "root/") == ["root/one.wet.gz", "root/ two "]
    assert read_paths(spark, str(index)).count() == 3
    (tmp_path / "one.wet.gz").write_bytes(gzip.compress(record("a", "text")))
    index.write_bytes(gzip.compress(b"one.wet.gz\n"))
    assert read_wet(spark, str(index), root=f"{tmp_path}/").count() == 1


def test_scan_reads_every_item(spark, tmp_path):
    from gleaner.plans.catalog import QUERIES

    items = [(i, f"item é {i}") for i in range(60)]
    spark.createDataFrame(items, "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted((r.uri, r.content) for r in QUERIES["wet_scan"](spark, str(tmp_path)).collect()) == sorted((f"item://{i}", t) for i, t in items)
