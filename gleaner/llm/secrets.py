"""Secret scans (operator 6): DataFrame functions only.

Base spans come from three patterns. The method adds `random` spans: runs of token characters whose symbols look drawn
at random. A run's encoding is inferred from its characters (digits, hex, base32, one-case alphanumerics, base62,
base64), and three tests of randomness are made under that encoding: chi-squared uniformity of the symbols, runs above
and below the alphabet's middle, and serial correlation of neighbouring symbols; runs under SHORT characters also have
the shares of capitals, small letters and the rest tested. Their p-values are combined (Fisher's sum of logarithms).
Runs without an encoding, with too few bits, or short and shaped like a word are left out.

False discoveries are controlled within each stratum of length, on both sides. Benjamini and Hochberg's rule picks the
runs that are not random at a false discovery rate of `rate`; they go. Of what stays, the share that randomness does not
explain is estimated (Storey: p-values of random runs are uniform, so those above LAMBDA tell how many random runs there
are), and the least p-value that is reported is raised until that share, the false discovery rate of the reported set, is
at most `rate` too. Runs that are left and carry at least MIN_BITS bits are reported. Strata and p-value bins are a fixed
grid, so what the driver gathers doesn't grow.

Positions are code points, end exclusive. Lengths of gaps and matches alternate, so positions are running sums.

Edge cases: null and empty texts have no spans; repeated rows have their own; overlapping spans of different kinds
all stay; a random run that touches a base span is not added; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import stage

# Kinds in their order, with pattern, the group whose length counts, and that length.
KINDS = ["assign", "access", "hex", "random"]
BASE = {
    "assign": (r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+", 12),
    "access": ("", r"AKIA[A-Z0-9]+", 18),
    "hex": ("", r"[0-9a-f]+", 16),
}
RATE = 0.05
MIN_BITS = 72.0
#: Fewer symbols of the widest alphabet can't carry MIN_BITS.
LEAST = math.ceil(MIN_BITS / 6)
#: A run that fits base64 is whole; else its stretches between slashes that fit base64, else what fits base64url. An equals
#: sign belongs to a run only as its padding.
CANDIDATE = (
    r"(?:(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/]{%d,}+(?![_-])"
    r"|(?<![A-Za-z0-9+_-])[A-Za-z0-9+]{%d,}+(?![_-])"
    r"|(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{%d,}+)(?:=++(?![A-Za-z0-9+/_-]))?" % (LEAST, LEAST, LEAST)
)
#: Below this length the three tests are weak, and the share of each class of symbols is tested as well.
SHORT = 24
#: Short runs of the shape of a word say nothing: long words of a language pass the tests too often.
WORD = "^(?:[A-Z]?[a-z]+|[A-Z]+)$"
#: Above this p-value nearly all runs are random ones.
LAMBDA = 0.5
#: p-value bins of the false discovery rule: tenths of a decade down to 1e-12.
BINS = 120

_SPAN = "array<struct<start:int,end:int,kind:int>>"


def matches(text: Column, head: str, body: str, least: int, kind: int) -> Column:
    """Spans of all leftmost, non-overlapping matches whose body has at least `least` characters."""
    whole = head + body
    # Gaps and matches alternate.
    gaps, hits = F.split(text, whole, -1), F.regexp_extract_all(text, F.lit(f"({whole})"), F.lit(1))
    pairs = F.zip_with(F.slice(gaps, 1, F.greatest(F.size(hits), F.lit(1))), hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    pairs = F.filter(pairs, lambda p: p["hit"].isNotNull())

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        # The head takes what it can first, as in the search; the body is the rest.
        tail = F.length(F.regexp_extract(pair["hit"], f"^{head}({body})$", 1)) if head else F.length(pair["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"))
        return F.struct(end.alias("at"), F.when(tail >= least, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    def stretch(acc: Column, some: Column) -> Column:
        inner = F.aggregate(some, F.struct(acc["at"].alias("at"), F.array().cast(_SPAN).alias("out")), step)
        return let(inner, lambda i: F.struct(i["at"].alias("at"), F.array_append(acc["out"], i["out"]).alias("out")))

    # Appending copies an array: a stretch of about the root of all matches at a time keeps that far from their square.
    width = lambda p: F.ceil(F.sqrt(F.size(p))).cast("int")
    some = lambda p: F.transform(F.sequence(F.lit(0), width(p) - 1), lambda i: F.slice(p, i * width(p) + 1, width(p)))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))
    return let(pairs, lambda p: F.when(F.size(p) > 0, F.flatten(F.aggregate(some(p), zero, stretch)["out"])).otherwise(F.array().cast(_SPAN)))


def found(text: Column, guard: str, head: str, body: str, least: int, kind: int) -> Column:
    """matches, entered only by texts that the guard pattern lets through."""
    return F.when(text.rlike(guard), matches(text, head, body, least, kind)).otherwise(F.array().cast(_SPAN))


# Encodings from the narrowest, with their symbols in order.
ENCODINGS = [
    ("digits", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower36", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
]


def upper_normal(z: Column) -> Column:
    """P(Z > z), by the logistic approximation with a cubic term (error under 2e-4)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(1.5976) * z + F.lit(0.070565992) * z * z * z))


def let(value: Column, then) -> Column:
    """then(value), with value worked out once and named once in the plan."""
    return F.transform(F.array(value), then)[0]


def battery(token: Column) -> Column:
    """struct(p, bits): the p-value under randomness and the bits that the token carries at most, for its inferred encoding."""
    symbols = lambda body: F.coalesce(*[F.when(body.rlike("^[" + alphabet.replace("-", r"\-") + "]+$"), F.lit(alphabet)) for _, alphabet in ENCODINGS], F.lit(""))
    codes = lambda body, known: F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: F.call_function("instr", known, c).cast("double"))
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda s, x: s + x)
    # Capitals, small letters and the rest.
    classes = lambda body: F.array(*[F.length(F.regexp_replace(body, others, "")).cast("double") for others in ("[^A-Z]", "[^a-z]", "[A-Za-z]")])

    def statistics(t: Column) -> Column:
        a, n, c = t["a"], t["n"], t["codes"]
        squares = total(F.transform(F.array_distinct(c), lambda d: F.pow(F.size(F.filter(c, lambda x: x == d)).cast("double"), F.lit(2.0))))
        pairs = F.filter(F.zip_with(c, F.slice(c, F.lit(2), F.greatest(F.size(c), F.lit(1))), lambda x, y: F.struct(x.alias("x"), y.alias("y"))), lambda p: p["y"].isNotNull())
        # Only short runs have classes.
        uneven = total(F.zip_with(t["seen"], t["all"], lambda seen, some: F.when(some > 0, F.pow(seen - n * some / a, F.lit(2.0)) / (n * some / a)).otherwise(F.lit(0.0))))
        free = F.size(F.filter(t["all"], lambda some: some > 0)) - 1
        return F.struct(a.alias("a"), n.alias("n"), (squares * a / n - n).alias("chi"), pairs.alias("pairs"), uneven.alias("uneven"), free.alias("free"))

    def scores(t: Column) -> Column:
        a, n, free = t["a"], t["n"], t["a"] - 1
        # Chi-squared with a-1 degrees of freedom, to a normal by Wilson and Hilferty.
        chi = (F.cbrt(F.greatest(t["chi"], F.lit(0.0)) / free) - (F.lit(1.0) - F.lit(2.0) / (F.lit(9.0) * free))) / F.sqrt(F.lit(2.0) / (F.lit(9.0) * free))
        # Runs above and below the middle: changes between neighbours are n-1 fair coins under randomness.
        changes = F.size(F.filter(t["pairs"], lambda p: (p["x"] > a / 2) != (p["y"] > a / 2))).cast("double")
        runs = F.abs(changes - (n - 1) / 2) / F.sqrt((n - 1) / 4)
        # Serial correlation against the alphabet's own mean and variance: its deviation is 1/sqrt(n-1) under randomness.
        serial = total(F.transform(t["pairs"], lambda p: (p["x"] - (a + 1) / 2) * (p["y"] - (a + 1) / 2))) / ((a * a - 1) / 12) / F.sqrt(n - 1)
        least = F.lit(1e-30)
        logs = F.ln(F.greatest(upper_normal(chi), least)) + F.ln(F.greatest(F.lit(2.0) * upper_normal(runs), least)) + F.ln(F.greatest(F.lit(2.0) * upper_normal(F.abs(serial)), least))
        # Chi-squared with one or two degrees of freedom.
        share = F.when(t["free"] == 2, -t["uneven"] / 2).when(t["free"] == 1, F.ln(F.greatest(F.lit(2.0) * upper_normal(F.sqrt(t["uneven"])), least))).otherwise(F.lit(0.0))
        return F.struct((n * F.log2(a)).alias("bits"), F.greatest(-logs - share, F.lit(0.0)).alias("x"), (t["free"] > 0).alias("fourth"))

    # Fisher: chi-squared with six degrees of freedom, or eight with the fourth test.
    combined = lambda t: F.struct((F.exp(-t["x"]) * (F.lit(1.0) + t["x"] + t["x"] * t["x"] / 2 + F.when(t["fourth"], F.pow(t["x"], F.lit(3.0)) / 6).otherwise(F.lit(0.0)))).alias("p"), t["bits"].alias("bits"))
    none = F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("bits"))

    def tested(t: Column) -> Column:
        facts = F.struct(F.length(t["known"]).cast("double").alias("a"), F.length(t["body"]).cast("double").alias("n"), codes(t["body"], t["known"]).alias("codes"), *[F.when(F.length(t["body"]) < SHORT, classes(t[c])).otherwise(F.array().cast("array<double>")).alias(name) for c, name in (("body", "seen"), ("known", "all"))])
        return F.when((F.length(t["known"]) > 0) & (F.length(t["body"]) >= 8), let(let(let(facts, statistics), scores), combined)).otherwise(none)

    return let(let(F.regexp_replace(token, "=+$", ""), lambda body: F.struct(body.alias("body"), symbols(body).alias("known"))), tested)


def stratum(length: Column) -> Column:
    """Lengths by octaves: 24-31, 32-63, 64-127 and so on; short runs by octaves of their own."""
    return F.least(F.floor(F.log2(length.cast("double"))).cast("int"), F.lit(20)) + F.when(length < SHORT, 32).otherwise(0)


def p_bin(p: Column) -> Column:
    return F.least(F.lit(BINS), F.greatest(F.lit(0), F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * 10))).cast("int")


def thresholds(counts: dict[tuple[int, int], int], rate: float = RATE) -> dict[int, int]:
    """For each stratum the first p-value bin that is not reported (BINS + 1: all are)."""
    out = {}
    for s in {k[0] for k in counts}:
        own = [counts.get((s, b), 0) for b in range(BINS + 1)]
        total, below, first = sum(own), 0, BINS + 1
        for b in range(BINS, -1, -1):  # Benjamini and Hochberg, from the smallest p-values up
            below += own[b]
            if below and 10 ** (-b / 10) * total <= rate * below:
                first = b
        # Storey: what uniform p-values above the bound don't explain of the reported runs.
        high = next(b for b in range(BINS) if 10 ** (-(b + 1) / 10) < LAMBDA)
        random = (sum(own[:high]) + 1) / (1 - 10 ** (-high / 10))
        while first and sum(own[:first]) - random * (1 - 10 ** (-first / 10)) > rate * sum(own[:first]):
            first -= 1
        out[s] = first
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """id and all spans: array of (start, end, kind), by start, then kind as in KINDS."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    guards = {"assign": BASE["assign"][0], "access": "AKIA", "hex": r"[0-9a-f]{16}"}
    spans = [found(F.col("text"), guards[k], *BASE[k], KINDS.index(k)) for k in BASE]
    rows = rows.withColumn("base", F.concat(*spans))
    runs = F.when(F.col("text").rlike(CANDIDATE), matches(F.col("text"), "", CANDIDATE, 1, KINDS.index("random"))).otherwise(F.array().cast(_SPAN))
    fresh = F.filter(runs, lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))

    token = lambda r: F.substring(F.col("text"), r["start"] + 1, r["end"] - r["start"])
    fresh = F.filter(fresh, lambda r: (r["end"] - r["start"] >= SHORT) | ~token(r).rlike(WORD))

    def tested(r: Column) -> Column:
        found = battery(token(r))
        return let(found, lambda f: F.struct(r["start"].alias("start"), r["end"].alias("end"), p_bin(f["p"]).alias("bin"), (f["bits"] >= MIN_BITS).alias("enough")))

    rows = stage(rows.withColumn("fresh", fresh).select("id", "base", F.filter(F.transform("fresh", tested), lambda f: f["enough"]).alias("fresh")), "spans")
    # A run of no encoding, or of too few bits to be reported, is no hypothesis of the rule.
    grid = rows.where(F.size("fresh") > 0).select(F.explode("fresh").alias("r")).groupBy(stratum(F.col("r.end") - F.col("r.start")).alias("s"), F.col("r.bin").alias("b")).count()
    limit = thresholds({(r.s, r.b): r["count"] for r in grid.collect()}, rate)
    rejected = F.create_map(*[F.lit(x) for pair in limit.items() for x in pair]) if limit else F.create_map(F.lit(-1), F.lit(0))

    def stays(r: Column) -> Column:
        return (r["bin"] < F.coalesce(F.element_at(rejected, stratum(r["end"] - r["start"])), F.lit(BINS + 1)))

    added = F.transform(F.filter("fresh", stays), lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), F.lit(KINDS.index("random")).alias("kind")))
    ordered = F.array_sort(F.concat("base", added), lambda x, y: F.when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(x["kind"] - y["kind"]))
    return rows.select("id", ordered.alias("spans"))


def as_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """The text with each stretch covered by spans replaced by the mark."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)).alias("out"))
        overlap = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], fresh).otherwise(overlap)

    done = F.aggregate(spans, zero, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
