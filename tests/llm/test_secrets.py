"""The battery and the spans against plain Python; planted tokens."""

import math
import random
import string

import pytest
from pyspark.sql import functions as F

from gleaner.llm import secrets
from tests.llm.test_edges import spans


def test_assign_values_of_every_length(spark):
    """Group 2 counts, whatever of the keyword's own letters or signs it could take."""
    draw = random.Random(1)
    rows = []
    for key in ("password", "PassWd", "secret", "token", "api_key", "APIkey"):
        for sign in ("=", ":", " = ", "==", ": '", '": "', "=="):
            for n in range(1, 15):
                rows.append(f"x {key}{sign}{''.join(draw.choice(string.ascii_letters + string.digits + '+/_.=-') for _ in range(n))}' token {key}={'k' * n}")
    rows += ["password=hunter2", "token=abcdefgh", "secret=abc-def", "tokensecret=password=abcdefghijkl", "é😀" * 5 + "token=abcdefghijkl", ""]
    found = secrets.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    got = {r.id: r.t for r in found.select("id", secrets.as_text(base).alias("t")).collect()}
    assert got == {i: spans(t) for i, t in enumerate(rows)}


def test_many_matches(spark):
    text = " ".join(f"deadbeefdeadbeef{i:04x}" for i in range(3000))
    (row,) = secrets.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    assert ",".join(f"hex:{s.start}:{s.end}" for s in row.spans if s.kind == 2) == spans(text)


def upper_normal(z):
    return 1 / (1 + math.exp(1.5976 * z + 0.070565992 * z**3))


def plain_battery(token):
    body = token.rstrip("=")
    known = next((a for _, a in secrets.ENCODINGS if body and set(body) <= set(a)), "")
    n, a = len(body), len(known)
    if not known or n < 8:
        return 0.0, 0.0
    codes = [known.index(c) + 1 for c in body]
    free = a - 1
    chi = sum(codes.count(d) ** 2 for d in set(codes)) * a / n - n
    z = ((max(chi, 0) / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    pairs = list(zip(codes, codes[1:]))
    runs = abs(sum((x > a / 2) != (y > a / 2) for x, y in pairs) - (n - 1) / 2) / math.sqrt((n - 1) / 4)
    serial = sum((x - (a + 1) / 2) * (y - (a + 1) / 2) for x, y in pairs) / ((a * a - 1) / 12) / math.sqrt(n - 1)
    logs = [upper_normal(z), 2 * upper_normal(runs), 2 * upper_normal(abs(serial))]
    x = -sum(math.log(max(p, 1e-30)) for p in logs)
    fourth = False
    if n < secrets.SHORT:
        kinds = [str.isupper, str.islower, lambda c: not c.isalpha()]
        cells = [(sum(map(k, body)), sum(map(k, known))) for k in kinds]
        cells = [(seen, some) for seen, some in cells if some]
        uneven = sum((seen - n * some / a) ** 2 / (n * some / a) for seen, some in cells)
        if len(cells) == 3:
            x += uneven / 2
        elif len(cells) == 2:
            x -= math.log(max(2 * upper_normal(math.sqrt(uneven)), 1e-30))
        fourth = len(cells) > 1
    x = max(x, 0.0)
    return math.exp(-x) * (1 + x + x * x / 2 + (x**3 / 6 if fourth else 0)), n * math.log2(a)


def test_battery_by_hand(spark):
    draw = random.Random(2)
    tokens = ["".join(draw.choice(a) for _ in range(n)) for _, a in secrets.ENCODINGS for n in (7, 8, 13, 20, 24, 40, 90)]
    tokens += ["internationalisation", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abc+def_ghi/jkl-mno", "====", "0123456789" * 4, tokens[-1] + "=="]
    got = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", secrets.battery(F.col("t")).alias("b")).collect()
    for r in got:
        p, bits = plain_battery(r.t)
        assert r.b.p == pytest.approx(p, rel=1e-9, abs=1e-12) and r.b.bits == pytest.approx(bits), r.t


def test_planted_tokens(spark):
    """Random tokens among words in the shape of names: nearly all are found, and nearly nothing else."""
    draw = random.Random(3)
    alphabets = [string.ascii_letters + string.digits, string.ascii_letters + string.digits + "-_", string.ascii_lowercase + string.digits]
    planted = {i: "".join(draw.choice(alphabets[i % 3]) for _ in range((20, 32, 40, 64)[i % 4])) for i in range(240)}
    syllables = ["tion", "ing", "er", "con", "pro", "data", "base", "micro", "service", "read", "write", "stream", "net"]
    names = {1000 + i: "".join(draw.choice(syllables).title() for _ in range(draw.randint(4, 9))) + draw.choice(["", "1", "V2"]) for i in range(400)}
    rows = [(i, f"the value is {t} today") for i, t in (planted | names).items()]
    got = {r.id: r.spans for r in secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    caught = sum(any(s.kind == 3 and (s.start, s.end) == (13, 13 + len(t)) for s in got[i]) for i, t in planted.items())
    wrong = sum(any(s.kind == 3 for s in got[i]) for i in names)
    # The rate is one of expectation; a few hundred runs have it to within a few hundredths.
    assert caught >= 0.95 * len(planted) and wrong <= 0.08 * max(1, caught + wrong)


def test_reported_set_is_controlled():
    # Fifty runs at p = 0.1 aren't rejected as random, yet uniform p-values can't have put them there.
    assert secrets.thresholds({(5, 10): 50}) == {5: 10}
    uniform = {(5, b): round(1e6 * (10 ** (-b / 10) - 10 ** (-(b + 1) / 10))) for b in range(40)}
    assert secrets.thresholds(uniform)[5] >= 20
    assert secrets.thresholds({(5, 3): 1}) == {5: secrets.BINS + 1}


def test_edge_texts(spark):
    rows = [(1, None), (1, None), (None, "token=abcdefghijkl"), (2, ""), (3, "é" * 50_000 + " token=abcdefghijkl")]
    got = sorted((r.id or 0, secrets.KINDS[s.kind], s.start, s.end) for r in secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect() for s in r.spans)
    assert got == [(0, "assign", 0, 18), (3, "assign", 50_001, 50_019)]
