"""Components against brute force: every link of a thousand documents, ids that several texts have, rows without an id."""

import os

import pytest
from pyspark.sql import functions as F

from gleaner.llm import minhash
from gleaner.llm.registry import QUERIES
from tests.llm.test_kernels import shingles

LARGER = "/root/testdata/sf0.01"


def components(sets, percent=80):
    """Row to the rows it is linked with, over all pairs that could be: by length, then by the sets themselves."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    order = sorted((i for i in range(len(sets)) if sets[i]), key=lambda i: len(sets[i]))
    for k, a in enumerate(order):
        for b in order[k + 1 :]:
            if 100 * len(sets[a]) < percent * len(sets[b]):
                break
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(len(sets))]


def wanted(rows, size):
    sets = [shingles(t or "", size) for _, t in rows]
    root = components(sets)
    low = {}
    for (i, _), r, s in zip(rows, root, sets):
        if i is not None and s:
            low[r] = min(low.get(r, i), i)
    out = [(i, len(s), (low.get(r) if s else i)) for (i, _), r, s in zip(rows, root, sets)]
    return sorted((i, n, c, i is None or i == c) for i, n, c in out) if all(i is not None for i, _ in rows) else sorted(map(repr, ((i, n, c, i is None or i == c) for i, n, c in out)))


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="the larger tables are absent")
def test_every_link_of_a_thousand_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op5_near_duplicates"](spark, LARGER).collect())
    assert got == wanted(rows, 2)


def test_repeated_ids_and_no_ids(spark):
    words = lambda salt: [f"{salt}{i}" for i in range(60)]
    a, b, c = words("a"), words("b"), words("c")
    near = lambda x: " ".join([*x[:-1], "other"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (5, near(a)), (6, near(b)), (None, near(c)), (9, " ".join(c)), (None, "quite alone here"), (None, None), (4, " ".join(c)), (4, " ".join(c))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({x: F.lit("clash") for x in ("row", "node", "set_a", "low")})
    got = sorted(map(repr, (tuple(r) for r in minhash.near_duplicates(df, shingle=2).collect())))
    assert got == wanted(rows, 2)


def test_tiles_are_bounded_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL_BUCKET", 2)
    monkeypatch.setattr(minhash, "TILE_SHINGLES", 200)
    monkeypatch.setattr(minhash, "STAR_ROUNDS", 0)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:i] + [f"z{i}"] + base[i + 1 :])) for i in range(30)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle=2).collect()}
    assert got == dict.fromkeys(range(30), 0)
