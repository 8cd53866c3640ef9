"""The bitset against plain best fit, and pieces of rows that are all alike."""

import collections
import random

import pytest

from gleaner.llm import packing
from gleaner.llm.q_packing import tokenizer_path


def plain(lengths, capacity, limit):
    """Bins that are open, searched one by one."""
    out, count = [], 0
    stacks = collections.defaultdict(list)  # of bins that are alike, the one touched last
    for n in lengths:
        fits = [space for space, bins in stacks.items() if bins and space >= n]
        if fits:
            space = min(fits)
            bin_ = stacks[space].pop()
        else:
            if sum(map(len, stacks.values())) >= limit:
                stacks[min(s for s, bins in stacks.items() if bins)].pop()
            bin_, space, count = count, capacity, count + 1
        out.append((bin_, capacity - space))
        if space > n:
            stacks[space - n].append(bin_)
    return out


@pytest.mark.parametrize("limit", [1, 2, 7, 1000])
def test_best_fit_by_search(limit):
    draw = random.Random(limit)
    for top in (5, 60, 100):
        lengths = [draw.randint(1, top) for _ in range(300)]
        bins, offsets = packing.best_fit(lengths, 100, limit)
        assert list(zip(bins.tolist(), offsets.tolist())) == plain(lengths, 100, limit)


def test_equal_rows_spread_over_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 100)
    df = spark.createDataFrame([(None, "the same words")] * 1000, "doc_id bigint, text string")
    got = packing.pack(df, tokenizer_path(), capacity=64).collect()
    groups = collections.Counter(r.sequence_id >> 32 for r in got)
    assert len(got) == 1000 and len(groups) == 10 and max(groups.values()) < 200


def test_long_texts_count_by_their_pieces(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 100)
    df = spark.createDataFrame([(1, "word " * 5000), (2, ""), (3, None), (4, "Ünïcode 日本 <|endoftext|> it's " * 50)], "doc_id bigint, text string")
    got = packing.pack(df, tokenizer_path(), capacity=8).collect()
    assert len({r.sequence_id >> 32 for r in got}) > 3 and {r.doc_id for r in got} == {1, 2, 3, 4}
