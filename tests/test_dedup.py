"""Pairs within three bits, sequential windows in lanes, and local model snapshots, against plain Python."""

import collections
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.functions.simhash import simhash_bytes
from gleaner.functions.text import normalize, tokens
from gleaner.functions.vectors import SnapshotEncoder, embed, snapshot_dir
from gleaner.operators import dedup
from gleaner.operators.dedup import SeenSet, fifo_dedup, near_dedup_pairs


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_every_pair_within_the_bits(spark, monkeypatch, bits):
    draw = random.Random(bits)
    prints = [draw.getrandbits(64) for _ in range(30)]
    for base in prints[:20]:
        for n in (1, 2, 3, 4):
            prints.append(base ^ sum(1 << b for b in draw.sample(range(64), n)))
    signed = [x - 2**64 if x >= 2**63 else x for x in prints]
    monkeypatch.setattr(dedup, "simhash", lambda c: c)  # the column holds fingerprints
    got = {(r.left, r.right, r.bits) for r in near_dedup_pairs(spark.createDataFrame(list(enumerate(signed)), "k int, fp bigint"), "k", "fp", bits).collect()}
    first = {x: min(i for i, y in enumerate(prints) if y == x) for x in prints}
    want = {(a, b, (x ^ y).bit_count()) for x, a in first.items() for y, b in first.items() if a < b and (x ^ y).bit_count() <= bits}
    assert got == want and len(want) >= 20
    with pytest.raises(ValueError):
        near_dedup_pairs(spark.createDataFrame([(1, 1)], "k int, fp bigint"), "k", "fp", 4)


def test_windows_in_lanes(spark):
    draw = random.Random(8)
    rows = [(i, f"text number {draw.randint(0, 40)} of few") for i in range(600)]
    df = spark.createDataFrame(rows, "n int, content string").repartition(3)
    for lanes in (1, 4):
        seen, want = collections.defaultdict(lambda: SeenSet(5)), []
        for i, text in rows:
            fp = simhash_bytes(text.encode())
            if seen[fp % lanes].admit(fp):
                want.append(i)
        assert [r.n for r in fifo_dedup(df, "n", 5, lanes=lanes).orderBy("n").collect()] == want
    seen, want = collections.defaultdict(lambda: SeenSet(5)), []
    for i, text in rows:
        if seen[text[12]].admit(simhash_bytes(text.encode())):
            want.append(i)
    got = fifo_dedup(df, "n", 5, lane=F.substring("content", 13, 1))
    assert [r.n for r in got.orderBy("n").collect()] == want and got.columns == ["n", "content"]


def test_normal_forms(spark):
    texts = ["Straße ÉCOLE Привет 漢字 かな カナ 한글", "ﬁne ①²", "é", "한", "ΟΔΟΣ", "ＡＢＣ", "", None, "tab\tnew\nline  x"]
    import unicodedata

    got = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", normalize(F.col("x")).alias("y")).collect()
    assert {r.i: r.y for r in got} == {i: None if t is None else unicodedata.normalize("NFKC", t).lower() for i, t in enumerate(texts)}


def test_tokens_of_mixed_scripts(spark):
    text = "été2 x漢字y 漢x1かな 9a_b привет-мир ①"
    got = spark.createDataFrame([(text,)], "x string").select(tokens(F.col("x")).alias("t")).first().t
    assert got == ["été2", "x漢字y", "漢", "x1かな", "9a", "b", "привет", "мир", "①"]


def snapshot(folder, vectors, normal=True, kind="F32"):
    from tokenizers import Tokenizer, models, pre_tokenizers

    made = Tokenizer(models.WordLevel({"[UNK]": 0, "sea": 1, "shore": 2, "dune": 3}, unk_token="[UNK]"))
    made.pre_tokenizer = pre_tokenizers.Whitespace()
    folder.mkdir(parents=True, exist_ok=True)
    made.save(str(folder / "tokenizer.json"))
    (folder / "config.json").write_text(json.dumps({"normalize": normal}))
    raw = vectors.astype({"F32": "<f4", "F16": "<f2"}[kind]).tobytes()
    head = json.dumps({"embeddings": {"dtype": kind, "shape": list(vectors.shape), "data_offsets": [0, len(raw)]}}).encode()
    (folder / "model.safetensors").write_bytes(len(head).to_bytes(8, "little") + head + raw)


@pytest.mark.parametrize("kind", ["F32", "F16"])
def test_snapshot_encoder(spark, tmp_path, kind):
    vectors = np.array([[9, 9], [1, 0], [0, 1], [3, 4]])
    snapshot(tmp_path / "models--some--model" / "snapshots" / "abc", vectors, kind=kind)
    encoder = SnapshotEncoder("some/model", str(tmp_path))
    got = spark.createDataFrame([("sea shore",), ("dune nowhere",), ("nothing known",), (None,)], "x string").select(embed(F.col("x"), encoder).alias("v")).collect()
    assert np.allclose([r.v for r in got], [[0.5**0.5, 0.5**0.5], [0.6, 0.8], [0, 0], [0, 0]])
    assert snapshot_dir(str(tmp_path)) == str(tmp_path)
    with pytest.raises(FileNotFoundError):
        SnapshotEncoder("other/model", str(tmp_path))
    snapshot(tmp_path / "plain", vectors, normal=False)
    with pytest.raises(ValueError):
        SnapshotEncoder(str(tmp_path / "plain"))
