"""URL filters by a Bloom filter cascade (operator 1): DataFrame functions only.

Keys are hosts, the domains above them, and pages (host and path). Level 1 encodes the listed keys. Level 2 encodes those
keys of the corpus that level 1 takes for listed by mistake, level 3 the listed keys that level 2 takes for such, and so
on until a level makes no mistake over the corpus's whole key universe. A key's membership is then read off the first
level that rejects it, exactly, without a join.

Levels are built by aggregation: bit positions are grouped by 64-bit word and OR-ed, so only words reach the driver. A
list of any length is cut by a hash of its keys into parts whose first level has about MAX_BITS, each with a cascade of
its own; rows are judged by up to PARTS_AT_ONCE parts a pass, which bounds what a plan carries, and in further passes by the others.

Edge cases: null urls and urls without `://` have empty host and path and are allowed unless a rule or the list says
otherwise; null and empty keys in a list are ignored; an empty list lists nothing; repeated rows are judged alike; a host
of very many labels costs no more than the longest listed key has labels.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import release, stage

#: Mistakes of level 1 and of each further level.
FIRST_RATE, NEXT_RATE = 0.01, 0.1
#: Bits of a cascade's first level (2 MB, for about 1.75 million listed keys), and cascades in one plan.
MAX_BITS, PARTS_AT_ONCE = 1 << 24, 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Level:
    salt: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def positions(self, key: Column) -> list[Column]:
        """Double hashing by the two halves of one 64-bit hash."""
        h = F.xxhash64(key, F.lit(self.salt))
        low, high = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
        return [F.pmod(low + high * F.lit(i), F.lit(self.bits).cast("bigint")) for i in range(self.hashes)]

    def has(self, key: Column) -> Column:
        """Whether the level takes the key for one of its own."""
        table = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")

        def tests(t: Column) -> Column:
            bits = [F.call_function("getbit", t[F.shiftright(p, 6).cast("int")], F.pmod(p, F.lit(64)).cast("int")) == 1 for p in self.positions(key)]
            return reduce(lambda a, b: a & b, bits)

        # Bound to a name, so that the plan holds the words once.
        return F.transform(F.array(table), tests)[0]


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def has(self, key: Column) -> Column:
        """Exact for every key of the universe and every listed key."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            out = F.when(self.levels[i].has(key), out).otherwise(F.lit(i % 2 == 1))
        return out


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def level_of(keys: DataFrame, n: int, rate: float, salt: int) -> Level:
    """A Bloom filter over the n keys of column `key`."""
    bits = max(64, 64 * math.ceil(n * -math.log(rate) / math.log(2) ** 2 / 64))
    empty = Level(salt, bits, max(1, round(bits / max(1, n) * math.log(2))) if n > 4 else 4, ())
    spots = keys.select(F.explode(F.array(*empty.positions(F.col("key")))).alias("p"))
    words = spots.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(_bit(F.pmod("p", F.lit(64)))).alias("bits"))
    table = [0] * (bits // 64)
    for w, x in words.collect():
        table[w] = x
    return Level(salt, bits, empty.hashes, tuple(table))


def _keys(df: DataFrame) -> DataFrame:
    return df.select("key").where("key <> ''").distinct()


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade of `key`s of listed over those of universe."""
    listed, universe = stage(_keys(listed), "listed"), _keys(universe)
    levels: list[Level] = []
    inside, outside, made = listed, None, [listed]
    while True:
        n = inside.count()
        if levels and not n:
            release(*made)
            return Cascade(tuple(levels))
        level = level_of(inside, n, NEXT_RATE if levels else FIRST_RATE, len(levels) + 1)
        levels.append(level)
        if outside is None:
            # Only the universe's keys that pass level 1 are compared with the list, once, while building.
            mistakes = universe.where(level.has(F.col("key"))).join(listed, "key", "left_anti")
        else:
            mistakes = outside.where(level.has(F.col("key")))
        inside, outside = stage(mistakes, "mistakes"), inside
        made.append(inside)


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts))


def build_cascades(listed: DataFrame, universe: DataFrame) -> list[Cascade]:
    """A cascade for each part of the keys; the list is cut into as many parts as its length asks for."""
    listed = stage(_keys(listed), "list")
    parts = max(1, math.ceil(listed.count() / max(1, MAX_BITS * math.log(2) ** 2 / -math.log(FIRST_RATE))))
    own = lambda df, i: df.where(_part(F.col("key"), parts) == i)
    return [build_cascade(own(listed, i), own(universe, i)) for i in range(parts)]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of the part behind the first `://`; both empty without one."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def domains(host: Column, most: Column) -> Column:
    """The host and every domain above it, of at most `most` labels."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.greatest(F.lit(1), F.size(parts) - most + 1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def keys_of(host: Column, path: Column, most: int) -> Column:
    """What may be listed of a url: its domains of at most `most` labels, and its page."""
    return F.concat(domains(host, F.lit(most)) if most else F.array().cast("array<string>"), F.when(path != "", F.array(F.concat(host, path))).otherwise(F.array().cast("array<string>")))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(the longest rule that fits, its verdict). rules: (verdict, host and path as one string)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, slash, tail = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + tail)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(say)).otherwise(verdict)
    return name, verdict


def _listed(cascades: list[Cascade], at: int):
    """Whether a key is listed in one of the parts from `at` on that one pass takes."""
    some = list(enumerate(cascades))[at : at + PARTS_AT_ONCE]
    if len(cascades) == 1:
        return lambda key: cascades[0].has(key)
    return lambda key: reduce(lambda rest, own: F.when(_part(key, len(cascades)) == own[0], own[1].has(key)).otherwise(rest), some, F.lit(False))


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict, listed: the longest rule's verdict, else block where the page, the host or a domain above it is listed."""
    host, path = host_and_path(F.col(url_col))
    judged = pages.select(F.col(id_col), host.alias("host"), path.alias("path")).withColumn("listed", F.lit(False))
    # No domain of more labels than the longest listed one is listed.
    most = listed.where("key not like '%/%'").agg(F.max(F.size(F.split("key", r"\.")))).first()[0] or 0
    keys = keys_of(F.col("host"), F.col("path"), most)
    universe = stage(judged.select("host", "path").distinct().select(F.explode(keys).alias("key")).distinct(), "universe")
    cascades = build_cascades(listed, universe)
    release(universe)
    for at in range(0, len(cascades), PARTS_AT_ONCE):
        if at:
            judged = stage(judged, "judged")
        judged = judged.withColumn("listed", F.col("listed") | F.exists(keys, _listed(cascades, at)))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return judged.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "listed")
