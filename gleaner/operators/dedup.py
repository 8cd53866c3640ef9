"""Deduplication by fingerprint."""

from __future__ import annotations

import itertools
from collections import OrderedDict
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.simhash import hamming, simhash


class SeenSet:
    """The last `capacity` fingerprints in order of arrival; a hit isn't refreshed."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.held: OrderedDict[int, None] = OrderedDict()

    def admit(self, fingerprint: int) -> bool:
        """True for a new fingerprint, which is then held; the oldest goes when full."""
        if fingerprint in self.held:
            return False
        if len(self.held) >= self.capacity:
            self.held.popitem(last=False)
        self.held[fingerprint] = None
        return True


def dedup(df: DataFrame, content: str = "content", score: str = "score", tie: str = "uri", ascending: bool = False, exact: bool = False) -> DataFrame:
    """One row for each fingerprint: the best score, then the smallest `tie`, nulls last.

    Near copies and texts below three bytes can share a fingerprint; with `exact` these stay apart, told by SHA-256.
    Tasks keep one row of each fingerprint before the exchange (a limit on the window's groups), so one that a third of
    all rows share costs a row a task; only columns that are asked for later are sorted and exchanged.
    """
    marked, same = df.withColumn("_fp", simhash(F.col(content))), ["_fp"]
    if exact:
        marked, same = marked.withColumn("_sha", F.unhex(F.sha2(F.col(content).cast("binary"), 256))), ["_fp", "_sha"]
    order = Window.partitionBy(*same).orderBy(F.col(score).asc() if ascending else F.col(score).desc(), F.col(tie).asc_nulls_last())
    return marked.withColumn("_n", F.row_number().over(order)).where(F.col("_n") == 1).drop("_n", *same)


#: Bands of a fingerprint: bits that differ fall into as many bands at most, so BANDS - bits of them are equal.
BANDS = 6


def _band(fp: Column, i: int) -> Column:
    low, high = 64 * i // BANDS, 64 * (i + 1) // BANDS
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def near_dedup_pairs(df: DataFrame, key: str, content: str = "content", bits: int = 3) -> DataFrame:
    """Pairs of representatives (the smallest key of a fingerprint) whose fingerprints differ in 1 to `bits` (up to 3) bits.

    Of six bands at least three are equal in such a pair, so fingerprints meet by three bands (32 bits) at a time: few meet
    by chance, whatever the number of rows. A pair that shares more bands comes from the first three alone.
    """
    if bits > 3:
        raise ValueError("six bands, three at a time, find at most three differing bits")
    marked = df.select(F.col(key).alias("k"), simhash(F.col(content)).alias("fp")).groupBy("fp").agg(F.min("k").alias("k"))
    combos = list(itertools.combinations(range(BANDS), BANDS - 3))
    keys = F.array(*[F.xxhash64(F.lit(c), *[_band(F.col("fp"), i) for i in combo]) for c, combo in enumerate(combos)])
    banded = marked.select("k", "fp", F.posexplode(keys).alias("combo", "value"))
    a, b = banded.alias("a"), banded.alias("b")
    same = [_band(F.col("a.fp"), i) == _band(F.col("b.fp"), i) for i in range(BANDS)]
    first = F.lit(-1)
    for c, combo in reversed(list(enumerate(combos))):
        first = F.when(reduce(lambda x, y: x & y, [same[i] for i in combo]), F.lit(c)).otherwise(first)
    apart = hamming(F.col("a.fp"), F.col("b.fp"))
    joined = a.join(b, (F.col("a.value") == F.col("b.value")) & (F.col("a.combo") == F.col("b.combo")) & (F.col("a.k") < F.col("b.k")) & (apart <= bits))
    return joined.where(F.col("a.combo") == first).select(F.col("a.k").alias("left"), F.col("b.k").alias("right"), apart.alias("bits"))


def near_dedup_members(df: DataFrame, key: str, content: str = "content") -> DataFrame:
    """left, right, bits as near_dedup_pairs has them: a row for each row of df, with the smallest key of its fingerprint as left and 0 bits."""
    marked = df.select(F.col(key).alias("right"), simhash(F.col(content)).alias("fp"))
    first = marked.groupBy("fp").agg(F.min("right").alias("left")).withColumnRenamed("fp", "of")
    # A join and no window: a fingerprint of many rows can be split.
    return marked.join(first, F.col("fp").eqNullSafe(F.col("of"))).select("left", "right", F.lit(0).alias("bits"))


def fifo_dedup(df: DataFrame, order: str | list[Column], capacity: int, content: str = "content", lanes: int = 1, lane: Column | None = None) -> DataFrame:
    """The sequential window: rows in `order`, each admitted unless the last `capacity` admitted fingerprints hold its own.

    A window over arrivals is one sequence by definition, so one lane is one task: for a stream that one consumer follows.
    `lanes` deals fingerprints over that many independent windows (equal ones meet in one lane), which is what several
    consumers of one stream do; `lane` deals by an expression of the content instead.
    """
    keyed = df.withColumn("_fp", simhash(F.col(content)))
    keyed = keyed.withColumn("_lane", (F.pmod(F.col("_fp"), F.lit(lanes)) if lane is None else lane).cast("string"))
    names, schema = df.columns, df.schema

    def run(batches):
        now, seen = None, SeenSet(capacity)
        for batch in batches:
            keep = []
            for at, fp in zip(batch.column("_lane").to_pylist(), batch.column("_fp").to_pylist()):
                if at != now:  # lanes follow each other
                    now, seen = at, SeenSet(capacity)
                keep.append(seen.admit(fp))
            yield batch.filter(pa.array(keep, pa.bool_())).select(names)

    rows = keyed.repartition("_lane") if lane is not None else keyed.repartition(lanes, "_lane")
    return rows.sortWithinPartitions("_lane", *([order] if isinstance(order, str) else order)).mapInArrow(run, schema)
