"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix (operator 10).

Rows sit in source blocks (a hash of the row and its place). The counts of rows that go from each block to each shard are
drawn first, block by block, from the multivariate hypergeometric distribution over what the shards still lack, which is
the law that a uniform shuffle gives those counts. Each block permutes its rows and cuts the permutation by its counts;
rows go to their shards; each shard permutes again, cell by cell, so that no task holds a shard. Shard sizes differ by one
row at most, whatever the blocks hold, and only sizes of blocks (never rows) reach the driver.

Rows are written to the shared folder with their block, and again with their shard, so that what was counted is what is
placed even after a lost executor.

Edge cases: null ids and texts are rows like any others; rows that are equal in every column are interchangeable and spread
over the blocks; long texts are only carried; an empty table gives no rows. Input columns named shard or slot are replaced.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import stage

#: Rows of a source block and of a shard's cell, on average.
BLOCK_ROWS = 16_384
MAX_BLOCKS = 65_536


def hypergeometric(draw: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among n drawn without replacement, by inversion over all values that have any weight.

    Weights are products of the ratios of neighbouring probabilities, from 1 at the mode, so their error doesn't grow with
    the population; beyond twelve deviations and fifty they are below 1e-30 in sum.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    share = good / (good + bad)
    reach = int(12 * math.sqrt(n * share * (1 - share))) + 50
    up, down = np.arange(mode, min(high, mode + reach), dtype=np.float64), np.arange(mode, max(low, mode - reach), -1, dtype=np.float64)
    above = np.cumprod((good - up) / (up + 1) * (n - up) / (bad - n + up + 1))
    below = np.cumprod(down / (good - down + 1) * (bad - n + down) / (n - down + 1))
    weights = np.cumsum(np.concatenate([below[::-1], [1.0], above]))
    return mode - len(below) + int(np.searchsorted(weights, draw.random() * weights[-1], side="right"))


def communication_matrix(rows: list[int], shards: int, seed: int) -> np.ndarray:
    """Row b: how many rows of block b go to each shard. Columns add up to shard sizes that differ by one at most."""
    total = sum(rows)
    left = np.array([total // shards + (s < total % shards) for s in range(shards)], dtype=np.int64)
    draw = np.random.default_rng(seed)
    out = np.zeros((len(rows), shards), dtype=np.int64)
    for b, n in enumerate(rows):
        rest = int(left.sum())
        for s in range(shards):  # one hypergeometric draw for each shard in turn
            rest -= int(left[s])
            out[b, s] = hypergeometric(draw, int(left[s]), rest, n)
            n -= int(out[b, s])
        left -= out[b]
    return out


def shard(docs: DataFrame, key_cols: list[str], shards: int = 8, seed: int = 20240307) -> DataFrame:
    """docs with shard (int) and slot (long, gapless from 0 in each shard); input columns of these names are replaced."""
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    # The row travels as one struct, so that no name of the input can clash with those used here.
    docs = docs.select(F.struct(*kept).alias("row"), *[F.col(c).alias(f"key_{i}") for i, c in enumerate(key_cols)])
    key_cols = [f"key_{i}" for i in range(len(key_cols))]
    # The row's place parts equal rows; in the written table it stays what it was.
    placed = stage(docs.withColumn("_place", F.monotonically_increasing_id()), "placed")
    key_cols = [*key_cols, "_place"]
    blocks = int(min(MAX_BLOCKS, max(shards, -(-placed.count() // BLOCK_ROWS))))  # beyond that, blocks only take longer to sort
    keyed = placed.withColumn("_block", F.pmod(F.xxhash64(*key_cols, F.lit(seed)), F.lit(blocks)).cast("int")).withColumn("_order", F.xxhash64(*key_cols, F.lit(seed + 1)))
    sizes = dict(keyed.groupBy("_block").count().collect())
    matrix = communication_matrix([sizes.get(b, 0) for b in range(blocks)], shards, seed)
    # Per block: where each shard's part of the permutation ends, and where the block's part of each shard begins.
    ends = spark.createDataFrame([(b, row.tolist()) for b, row in enumerate(matrix.cumsum(axis=1))], "_block int, _ends array<bigint>")
    in_block = Window.partitionBy("_block").orderBy("_order", *key_cols)
    ranked = keyed.withColumn("_rank", F.row_number().over(in_block) - 1).join(F.broadcast(ends), "_block")
    placed = ranked.withColumn("shard", F.size(F.filter("_ends", lambda e: e <= F.col("_rank"))).cast("int")).drop("_ends", "_rank", "_block")
    # Second permutation: a fresh random order whose leading part names the cell; cells follow each other in the shard.
    cells = max(1, blocks // shards)
    placed = placed.withColumn("_order", F.xxhash64("_order", F.lit(seed + 2))).withColumn("_cell", F.pmod(F.xxhash64("_order", F.lit(seed + 3)), F.lit(cells)).cast("int"))
    placed = stage(placed, "dealt")
    counts = {(r["shard"], r["_cell"]): r["count"] for r in placed.groupBy("shard", "_cell").count().collect()}
    rows = []
    for s in range(shards):
        begins = 0
        for c in range(cells):
            rows.append((s, c, begins))
            begins += counts.get((s, c), 0)
    starts = spark.createDataFrame(rows, "shard int, _cell int, _begin bigint")
    in_cell = Window.partitionBy("shard", "_cell").orderBy("_order", *key_cols)
    out = placed.withColumn("_rank", F.row_number().over(in_cell) - 1).join(F.broadcast(starts), ["shard", "_cell"])
    return out.select("row.*", "shard", (F.col("_begin") + F.col("_rank")).cast("bigint").alias("slot"))
