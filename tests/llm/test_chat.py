"""Windows against a plain walk over the turns."""

import random
import re

import pytest

from gleaner.llm import chat

TOKEN = re.compile(r"[^\W\d_]+|\d|[^\s]")


def cost(text):
    return len(TOKEN.findall(text)) + chat.TURN_TOKENS


def walked(turns, budget, history):
    """(own turns, repeated turns) of each window."""
    system = bool(turns) and turns[0][0] == "system"
    space = max(1, budget - (cost(turns[0][1]) if system else 0))
    costs = [0 if system and i == 0 else cost(t) for i, (_, t) in enumerate(turns)]
    out, begin, place = [], 0, None
    for i, c in enumerate(costs):
        long, after = c * 3 > space, i == 0 or costs[i - 1] * 3 > space
        if long or after:
            begin = sum(costs[:i])
        now = (sum(costs[:i]) - begin) * 3 // (space * 2)
        if long or after or now != place:
            out.append([])
        place = now
        out[-1].append(i)
    windows = []
    for own in out:
        left, lead = space - sum(costs[i] for i in own), []
        for i in range(own[0] - 1, max(own[0] - history, 0) - 1, -1):
            if system and i == 0 or costs[i] > left:
                break
            left -= costs[i]
            lead.insert(0, i)
        windows.append((own, ([0] if system and own[0] else []) + lead))
    return windows


@pytest.fixture(scope="module")
def chats():
    draw = random.Random(5)
    out = {}
    for c in range(30):
        turns = [("system", "be kind " * draw.randint(1, 6))] if c % 3 else []
        turns += [(("user", "assistant")[i % 2], "word " * draw.choice([1, 5, 20, 30, 34, 60, 90, 150])) for i in range(draw.randint(1, 25))]
        out[c] = turns
    out[100] = [("user", "w " * 300)] * 4  # as in a budget of 1024: all turns under the share
    return out


@pytest.mark.parametrize(("budget", "history"), [(100, 2), (100, 0), (300, 3), (20, 1)])
def test_windows_by_hand(spark, chats, budget, history):
    rows = [(c, i, *turn) for c, turns in chats.items() for i, turn in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {}
    for r in chat.format_chats(df, budget=budget, history=history).collect():
        parts = r.formatted.split("<|im_start|>")[1:]
        said = [(p.partition("\n")[0], p.partition("\n")[2].removesuffix("<|im_end|>\n")) for p in parts]
        got[r.conv_id, r.window] = (said[r.repeated :], said[: r.repeated])
        longest = max(cost(t) for _, t in said)
        assert sum(cost(t) for _, t in said) <= budget or longest + (cost(said[0][1]) if said[0][0] == "system" else 0) > budget
    want = {(c, w): tuple([turns[i] for i in some] for some in window) for c, turns in chats.items() for w, window in enumerate(walked(turns, budget, history))}
    assert got == want


def test_turns_under_the_share_keep_the_budget(spark):
    df = spark.createDataFrame([(1, i, "user", "w " * 300) for i in range(12)], "conv_id bigint, turn bigint, role string, text string")
    for r in chat.format_chats(df, budget=1024, history=2).collect():
        assert sum(cost(p.partition("\n")[2].removesuffix("<|im_end|>\n")) for p in r.formatted.split("<|im_start|>")[1:]) <= 1024
