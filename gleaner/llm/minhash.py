"""Near-duplicate detection by circulant MinHash, banding and exact Jaccard verification (operator 5).

A document's set holds the distinct shingles of its words (A-Z lower-cased, split at ASCII white space); with fewer
words than a shingle, the whole sequence is the one shingle. Two documents are linked when
100 * |intersection| >= percent * |union|; a component is what links connect.

Signatures: one permutation sigma (a 64-bit bijection folded to 2**20 places) scatters the shingles; a second
permutation pi, shifted circularly by k, gives coordinate k as min pi[place - k]. With pi doubled at its end, all
coordinates of a shingle are one contiguous row of memory. Shingles of one place only make signatures agree more, so sets
near the number of places meet in more buckets, and lose no link.

Exactness: equal sets (by 128 bits of their shingles) fold into one node, whatever ids their documents have. A node is
compared with centres of its band buckets first (linear in the rows, whatever a bucket's size), which joins nearly all of
a group of copies. Then every pair of a bucket whose members are still in different components, and which passes a size
bound and a 256-bit sketch, is confirmed on the full sets: as rows in small buckets, in tiles of a bounded number of
members and shingles, of which only links leave the task, in large ones. At similarity 0.8 a link escapes all 32 bands
with probability 3e-6 and the sketch with about 1e-6.

Edge cases: null or wordless texts have an empty set, n_shingles 0 and are linked with nothing; a null id keeps its
row, and its component is the smallest id among what it is linked with, null if none has one; an id that several texts
have stands for each of them; repeated rows give one row each; an empty table gives an empty result; very long texts are
sets like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.llm import bytetext
from gleaner.llm.common import release, spread, stage

BANDS, ROWS = 32, 5
COORDINATES = BANDS * ROWS
PLACES = 1 << 20
SKETCH_BITS = 256
#: Rows that a broadcast may hold: 24 bytes each at most.
BROADCAST_IDS = 1_000_000
STAR_ROUNDS = 2
CENTRES_PER_ROUND = 2
#: Buckets up to this size give their pairs as rows; larger ones are compared in tiles of at most about TILE by TILE members.
SMALL_BUCKET = 8
TILE = 1024
#: Shingles of a tile's rows or columns, about: eight bytes each.
TILE_SHINGLES = 1 << 20

_rows: np.ndarray | None = None


def _leave() -> None:
    global _rows
    _rows = None


bytetext.leaving["minhash"] = _leave


def circulant_rows() -> np.ndarray:
    """Row p holds pi[p - k] for every coordinate k: a view on pi, once doubled at its end."""
    global _rows
    if _rows is None:
        pi = np.random.default_rng(20240229).permutation(PLACES).astype(np.uint32)
        _rows = np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[: COORDINATES - 1]]), COORDINATES)
    return _rows


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of each row's distinct shingles in ascending order, bounds of the rows)."""
    hashes, _, first = bytetext.words(raw, offsets, bytetext.SPACE)
    counts = np.diff(first)
    full = hashes
    for i in range(1, size):
        full = bytetext.pair(full[:-1], hashes[i:], i) if len(hashes) > i else full[:0]
    row_of = bytetext.segment_ids(first)
    keep = np.arange(len(full)) + size <= first[1:][row_of[: len(full)]] if len(full) else np.zeros(0, bool)
    values, rows = full[keep], row_of[: len(full)][keep]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = []
        for r in short:  # fewer words than a shingle: the sequence itself
            x = hashes[first[r] : first[r] + 1]
            for i in range(1, counts[r]):
                x = bytetext.pair(x, hashes[first[r] + i : first[r] + i + 1], i)
            whole.append(bytetext.mix(x + np.uint64(counts[r]))[0])
        values = np.concatenate([values, np.array(whole, dtype=np.uint64)])
        rows = np.concatenate([rows, short])
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[new], rows[new]
    return values, np.searchsorted(rows, np.arange(len(offsets)))


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of COORDINATES minima for each non-empty set; empty sets get zeros."""
    table = circulant_rows()
    out = np.zeros((len(bounds) - 1, COORDINATES), dtype=np.uint32)
    places = (bytetext.mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(44)).astype(np.int64)
    for r in range(len(bounds) - 1):
        low, high = bounds[r], bounds[r + 1]
        if high > low:
            best = table[places[low : low + 4096]][: high - low].min(axis=0)
            for at in range(low + 4096, high, 4096):
                np.minimum(best, table[places[at : min(at + 4096, high)]].min(axis=0), out=best)
            out[r] = best
    return out


def bands_and_sketch(signature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a 64-bit key for each band, 256 sketch bits as four words: two bits of each of 128 coordinates)."""
    wide = signature.astype(np.uint64).reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), wide.shape[:2])
    for i in range(ROWS):
        key = bytetext.pair(key, wide[:, :, i], i)
    # Low bits of a minimum of few candidates are as good as random once mixed.
    two = (bytetext.mix(signature[:, :128].astype(np.uint64)) & np.uint64(3)).reshape(len(signature), 4, 32)
    sketch = (two << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=2, dtype=np.uint64)
    return key.view(np.int64), sketch.view(np.int64)


def sketch_limit(percent: int) -> int:
    """Most differing sketch bits of a pair at the similarity bound: mean plus 5 deviations."""
    j = percent / 100
    mean = (1 - j) / 2 * SKETCH_BITS
    deviation = (j * (1 - j) * 0.25 + (1 - j) * 0.125) ** 0.5 / 128**0.5 * SKETCH_BITS
    return int(mean + 5 * deviation) + 1


def set_hashes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two 64-bit sums over each set's shingles, which tell sets apart."""
    total = np.zeros((2, len(values) + 1), dtype=np.uint64)
    np.cumsum(bytetext.mix(values), out=total[0, 1:])
    np.cumsum(bytetext.mix(values ^ np.uint64(0x5BD1E9955BD1E995)), out=total[1, 1:])
    return (total[:, bounds[1:]] - total[:, bounds[:-1]]).view(np.int64)


_FEATURES = "doc_id bigint, row bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, sketch array<bigint>"


def _features(size: int):
    def run(batches):
        for batch in batches:
            for at, end, raw, offsets in bytetext.blocks(batch.column("text")):
                values, bounds = shingle_sets(raw, offsets, size)
                bands, sketch = bands_and_sketch(signatures(values, bounds))
                ragged = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                own = [batch.column(x).slice(at, end - at) for x in ("doc_id", "row")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(bounds)), *map(pa.array, set_hashes(values, bounds)), ragged(bands), ragged(sketch)], names=[x.split()[0] for x in _FEATURES.split(", ")])

    return bytetext.lean("minhash", run)


def _sets(size: int):
    def run(batches):
        for batch in batches:
            for _, _, raw, offsets in bytetext.blocks(batch.column("text")):
                values, bounds = shingle_sets(raw, offsets, size)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*map(pa.array, set_hashes(values, bounds)), lists], names=["set_a", "set_b", "shingles"])

    return bytetext.lean("minhash", run)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that hold on the full sets. Either side may be in any number of pairs: joins, which Spark splits when skewed."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", both.alias("i"), (F.size("sa") + F.size("sb") - both).alias("u")).where(F.col("i") * 100 >= F.col("u") * percent).select("a", "b")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp): smallest node reachable over links (a, b). Minimum labels spread along links and jump to labels' labels.

    nodes: (node, comp) with the labels so far; links join labels, so that earlier rounds' links need not be kept.
    """
    by_label = nodes.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    edges = links.join(by_label, "a").join(by_label.toDF("b", "cb"), "b").select(F.least("ca", "cb").alias("x"), F.greatest("ca", "cb").alias("y")).where("x <> y").distinct()
    edges = stage(edges, "edges")
    if edges.isEmpty():
        return nodes
    both = edges.union(edges.select("y", "x"))
    labels = stage(both.groupBy(F.col("x").alias("n")).agg(F.min("y").alias("m")).select("n", F.least("n", "m").alias("l")), "labels")
    while True:
        near = both.join(labels, F.col("y") == F.col("n")).groupBy("x").agg(F.min("l").alias("m"))
        step = labels.select("n", "l").join(near, F.col("n") == F.col("x"), "left").select("n", F.col("l").alias("old"), F.least("l", F.coalesce("m", "l")).alias("l"))
        jump = step.select(F.col("n").alias("k"), F.col("l").alias("kl"))
        step = stage(step.join(jump, F.col("l") == F.col("k"), "left").select("n", "old", F.least("l", F.coalesce("kl", "l")).alias("l")), "labels")
        release(labels)
        labels = step
        if step.where("old <> l").isEmpty():
            break
    out = stage(nodes.join(labels.select("n", "l"), F.col("comp") == F.col("n"), "left").select("node", F.coalesce("l", "comp").alias("comp")), "comps")
    release(edges, labels, nodes)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable), kept (the document is its component's smallest id)."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("doc_id", F.isnull("doc_id"), "text").alias("row"), "text")
    features = stage(spread(texts).mapInArrow(_features(shingle), _FEATURES), "features")
    # Equal sets are one node, with the smallest id and one of the rows that have it.
    chosen = F.min(F.struct("row", "n_shingles", "bands", "sketch")).alias("m")
    nodes = features.where("n_shingles > 0").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("low"), chosen)
    nodes = stage(nodes.select("set_a", "set_b", F.monotonically_increasing_id().alias("node"), "low", "m.row", "m.n_shingles", "m.bands", "m.sketch"), "nodes")
    rows = nodes.select("node", F.explode("bands").alias("key"))
    busy = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    near = stage(rows.join(busy, "key"), "near")
    company = near.groupBy("node").agg(F.sum("c").alias("company"))
    crowd = stage(near.drop("c").join(company.join(nodes.select("node", F.col("n_shingles").alias("n"), "sketch"), "node"), "node"), "crowd")
    release(near)
    some = stage(nodes.join(crowd.select("node").distinct(), "node", "left_semi").select("node", "row", "set_a", "set_b"), "some")
    ids = some.count()
    named = nodes.select("set_a", "set_b", F.col("low").alias("comp"))
    if ids:
        # Three numbers each: small enough to send to every executor up to the bound, shuffled joins beyond it.
        few = F.broadcast if ids <= BROADCAST_IDS else lambda x: x
        sets = spread(texts.join(few(some.select("row")), "row", "left_semi").select("text")).mapInArrow(_sets(shingle), "set_a bigint, set_b bigint, shingles array<bigint>")
        sets = stage(sets.join(few(some.select("set_a", "set_b", "node")), ["set_a", "set_b"]).select("node", "shingles").dropDuplicates(["node"]), "sets")
        labels = _link(crowd, sets, some.select("node", F.col("node").alias("comp")), percent)
        release(sets)
        lows = nodes.select("node", "low").join(labels, "node").groupBy("comp").agg(F.min("low").alias("lowest"))
        lowest = labels.join(lows, "comp").select("node", "lowest")
        named = stage(nodes.select("set_a", "set_b", "node", "low").join(lowest, "node", "left").select("set_a", "set_b", F.least("lowest", "low").alias("comp")), "named")
        release(labels, nodes)
    release(crowd, some)
    out = features.join(named, ["set_a", "set_b"], "left")
    component = F.when(F.col("n_shingles") > 0, F.least("comp", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _fits(a: str, b: str, percent: int):
    """(size bound, differing sketch bits) of two aliases' rows."""
    apart = F.bit_count(F.col(f"{a}.sketch")[0].bitwiseXOR(F.col(f"{b}.sketch")[0]))
    for i in range(1, 4):
        apart = apart + F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i]))
    return F.least(f"{a}.n", f"{b}.n") * 100 >= F.greatest(f"{a}.n", f"{b}.n") * percent, apart


def _link(crowd: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    limit = sketch_limit(percent)
    for turn in range(STAR_ROUNDS):
        mixed = _mixed(crowd, labels)
        # A centre for each bucket: first the member with the most company over all its buckets, then a random one.
        rank = F.col("company") if turn == 0 else F.xxhash64("node", F.lit(turn))
        centre = mixed.groupBy("key").agg(F.max(F.struct(rank.alias("r"), "node", "comp", "n", "sketch")).alias("c")).select("key", "c.*")
        m, c = mixed.alias("m"), centre.alias("c")
        sizes, apart = _fits("m", "c", percent)
        tries = m.join(c, F.col("m.key") == F.col("c.key")).where(F.col("m.comp") != F.col("c.comp")).where(sizes).select(F.col("m.node").alias("a"), F.col("c.node").alias("b"), apart.alias("apart")).where(F.col("apart") <= limit).distinct()
        best = tries.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy("apart", "b"))).where(F.col("r") <= CENTRES_PER_ROUND)
        links = stage(_confirm(best.select("a", "b"), sets, percent), "links")
        release(mixed)
        if links.isEmpty():
            break
        labels = components(labels, links)
        release(links)
    # What is left: every pair of a bucket across components.
    mixed = _mixed(crowd, labels)
    by_comp = mixed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    facts = by_comp.groupBy("key").agg(F.sum("c").alias("total"), F.sum("s").alias("size"), F.max(F.struct("c", "comp", "s")).alias("top"))
    parts = lambda members, shingles: F.ceil(F.greatest(members / TILE, shingles / TILE_SHINGLES)).cast("int")
    facts = facts.select("key", "total", F.col("top.comp").alias("top"), parts(F.col("total") - F.col("top.c"), F.col("size") - F.col("top.s")).alias("rows"), parts(F.col("total"), F.col("size")).alias("cols"))
    told = stage(mixed.join(facts, "key"), "rest")
    small, large = told.where(F.col("total") <= SMALL_BUCKET), told.where(F.col("total") > SMALL_BUCKET)
    # Small buckets: their few pairs as rows, each confirmed once.
    a, b = small.alias("a"), small.alias("b")
    sizes, apart = _fits("a", "b", percent)
    pairs = a.join(b, F.col("a.key") == F.col("b.key")).where((F.col("a.comp") < F.col("b.comp")) & sizes & (apart <= limit)).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
    found = _confirm(pairs, sets, percent)
    # Large ones: tiles of bounded size, compared inside a task; only links leave it. Rows are members outside the bucket's
    # largest component, columns are all members.
    spot = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    as_row = large.where(F.col("comp") != F.col("top")).select("key", spot("rows", 1).alias("i"), each("cols").alias("j"), F.lit(True).alias("side"), "node", "comp", "n", "sketch")
    as_column = large.select("key", each("rows").alias("i"), spot("cols", 2).alias("j"), F.lit(False).alias("side"), "node", "comp", "n", "sketch")
    tiles = as_row.unionByName(as_column).join(sets, "node")
    found = found.union(tiles.groupBy("key", "i", "j").applyInArrow(_tile(percent, limit), "a bigint, b bigint"))
    links = stage(found, "links")
    labels = labels if links.isEmpty() else components(labels, links)
    release(mixed, told, links)
    return labels


def _tile(percent: int, limit: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table.column("side").to_numpy()
        node, comp, n = (table.column(x).to_numpy() for x in ("node", "comp", "n"))
        sketch = table.column("sketch").chunk(0).flatten().to_numpy().view(np.uint64).reshape(-1, 4)
        lists = table.column("shingles").chunk(0)
        bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        rows, cols = np.flatnonzero(side), np.flatnonzero(~side)
        if not len(rows) or not len(cols):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        apart = np.zeros((len(rows), len(cols)), dtype=np.int16)
        for k in range(4):
            apart += np.bitwise_count(sketch[rows, k][:, None] ^ sketch[cols, k][None])
        least, most = np.minimum(n[rows][:, None], n[cols][None]), np.maximum(n[rows][:, None], n[cols][None])
        may = (comp[rows][:, None] != comp[cols][None]) & (apart <= limit) & (least * 100 >= most * percent)
        rows, cols, may = rows[may.any(axis=1)], cols[may.any(axis=0)], may[may.any(axis=1)][:, may.any(axis=0)]
        both = np.zeros(may.shape, dtype=np.float32)
        if len(rows):
            # Overlaps as products of incidence matrices, over the shingles in slices.
            of = lambda some: (np.concatenate([values[bounds[i] : bounds[i + 1]] for i in some]), np.repeat(np.arange(len(some)), bounds[some + 1] - bounds[some]))
            (va, ra), (vb, rb) = of(rows), of(cols)
            shared = np.intersect1d(va, vb)
            for at in range(0, len(shared), 2048):
                part = shared[at : at + 2048]
                x, y = np.zeros((len(rows), len(part)), np.float32), np.zeros((len(cols), len(part)), np.float32)
                for m, v, r in ((x, va, ra), (y, vb, rb)):
                    place = np.minimum(np.searchsorted(part, v), len(part) - 1)
                    own = part[place] == v
                    m[r[own], place[own]] = 1
                both += x @ y.T
        union = n[rows][:, None] + n[cols][None] - both
        i, j = np.nonzero(may & (both * 100 >= union * percent))
        return pa.table({"a": pa.array(node[rows[i]]), "b": pa.array(node[cols[j]])})

    return run


def _mixed(crowd: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the buckets whose members are in more than one component."""
    now = crowd.join(labels, "node")
    open_keys = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    return stage(now.join(open_keys, "key"), "mixed")
