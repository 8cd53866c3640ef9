"""Language ID by hierarchical discrimination (operator 9).

The family is predicted first (one linear SVM for each pair of families, by votes); then one-versus-one linear SVMs
separate the languages of that family. Features are hashed byte trigrams of the whole
lower-cased text, as shares of the text's trigrams, so that a score is one gather from a table of weights and one sum.

The SVMs (squared hinge, ridge) are fitted on at most `per_language` documents of each language, drawn at random, and
FAMILY_ROWS of each family; these bounds are the operator's parameters. Each pair is fitted in a task of its own from
sparse rows. Weights stay in a table; predictions take PAIRS_AT_ONCE pairs a pass, so any number of languages can be
learned. Predictions read whole texts of all rows.

Edge cases: `und` with score 0 for null texts and texts without a letter; a single learned language is predicted for
every other text; without any learned language all texts are `und`; ties go to the name that sorts first; rows of one id
are told apart, null ids and repeated rows are rows like any others; an empty table gives no rows; long texts are taken
in parts, with nothing lost between them.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm import bytetext
from gleaner.llm.common import release, spread, stage

BITS = 13
DIMS = 1 << BITS
PER_LANGUAGE = 600
FAMILY_ROWS = 1200
#: Languages whose counts a broadcast may hold, and pairs whose weights (32 kB each) one pass over the texts takes.
BROADCAST_LANGUAGES, PAIRS_AT_ONCE = 10_000, 1024
#: Ridge and steps of the SVM.
RIDGE, STEPS = 1e-3, 150
#: Slope from SVM margins to probabilities.
SLOPE = 3.0

# ISO 639-1 codes by family; a code that isn't listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "turkic": "az kk ky tr tt ug uz",
    "indic": "bn gu hi mr ne or pa si sd ur",
    "semitic": "am ar he mt",
    "sinitic": "zh yue",
}


def family_of(lang: str) -> str:
    return next((name for name, codes in FAMILIES.items() if lang in codes.split()), lang)


def grams(raw: np.ndarray) -> np.ndarray:
    """Bucket of the trigram at each byte but the last two."""
    low = bytetext.LOWER[raw].astype(np.uint32)
    code = (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)


def trigram_sums(raw: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each row, the mean of weights (buckets x outputs) over its trigrams."""
    rows = len(offsets) - 1
    out = np.zeros((rows, weights.shape[1]))
    if len(raw) < 3:
        return out
    for at in range(0, len(raw) - 2, bytetext.BLOCK_BYTES):  # a long text is taken in parts, with nothing lost between them
        part = grams(raw[at : at + bytetext.BLOCK_BYTES + 2])
        low = np.clip(offsets[:-1] - at, 0, len(part))
        high = np.clip(np.maximum(offsets[1:] - 2, offsets[:-1]) - at, 0, len(part))
        full = np.flatnonzero(high > low)
        if len(full):
            edges = np.stack([low[full], high[full]], axis=1).ravel()
            for k in range(weights.shape[1]):
                values = np.append(weights[part, k], 0.0)
                out[full, k] += np.add.reduceat(values, edges)[::2]
    return out / np.maximum(1, np.diff(offsets) - 2)[:, None]


def _profiles(batches):
    """Sparse trigram shares of each row."""
    for batch in batches:
        for at, end, raw, offsets in bytetext.blocks(batch.column(0)):
            index, share = [], []
            for r in range(end - at):
                own = raw[offsets[r] : offsets[r + 1]]
                counts = np.zeros(DIMS, dtype=np.int64)
                for low in range(0, len(own) - 2, bytetext.BLOCK_BYTES):
                    counts += np.bincount(grams(own[low : low + bytetext.BLOCK_BYTES + 2]), minlength=DIMS)
                some = np.flatnonzero(counts)
                index.append(some.astype(np.int32))
                share.append((counts[some] / max(1, len(own) - 2)).astype(np.float32))
            yield pa.RecordBatch.from_arrays([*(batch.column(x).slice(at, end - at) for x in (1, 2)), pa.array(index, pa.list_(pa.int32())), pa.array(share, pa.list_(pa.float32()))], names=["lang", "r", "index", "share"])


def fit_svm(index: np.ndarray, share: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """(weights, bias) of a squared-hinge linear SVM by accelerated gradient steps; y is +1 or -1, classes weigh alike.

    Row i of the matrix holds share[bounds[i]:bounds[i + 1]] at index of the same places; no row is empty.
    """
    row = np.repeat(np.arange(len(y)), np.diff(bounds))
    scale = np.sqrt(np.bincount(row, share.astype(np.float64) ** 2)).mean()
    values = share / np.float32(scale)
    # The bias is one more feature, of every row.
    times = lambda v: np.add.reduceat(values * v[index], bounds[:-1]) + v[DIMS]
    back = lambda u: np.append(np.bincount(index, values * u[row], minlength=DIMS), u.sum())
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    v = np.ones(DIMS + 1)
    for _ in range(12):  # largest eigenvalue, for the step
        v = back(weight * times(v))
        top = float(np.linalg.norm(v))
        v /= top
    step = 1 / (2 * top + RIDGE)
    w = z = np.zeros(DIMS + 1)
    t = 1.0
    for _ in range(STEPS):
        slack = np.maximum(0, 1 - y * times(z))
        new = z + step * (2 * back(weight * y * slack) - RIDGE * z)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w[:-1] / scale, float(w[-1])


def _fit_pair(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    lists = table.column("index").chunk(0)
    w, bias = fit_svm(lists.flatten().to_numpy(), table.column("share").chunk(0).flatten().to_numpy(), lists.offsets.to_numpy(), table.column("side").to_numpy())
    return pa.table({"k": [key[0].as_py()], "w": pa.array([w.astype("<f4").tobytes()], pa.binary()), "bias": [bias]}, schema=pa.schema([("k", pa.int32()), ("w", pa.binary()), ("bias", pa.float64())]))


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = PER_LANGUAGE) -> dict:
    """The hierarchy: languages, families, pairs (level, one, other) of each level, and a table with the pairs' weights."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sizes = stage(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    few = F.broadcast if sizes.count() <= BROADCAST_LANGUAGES else lambda x: x
    # About twice the rows wanted of each language are ranked, however common it is.
    drawn = known.withColumn("u", F.rand(20240317)).join(few(sizes), "lang").where(F.col("u") * F.col("n") < 2 * per_language)
    ranked = drawn.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("u"))).where(F.col("r") <= per_language)
    profiles = stage(ranked.select("text", "lang", "r").mapInArrow(bytetext.lean("langid", _profiles), "lang string, r int, index array<int>, share array<float>").where(F.size("index") > 0), "profiles")
    langs = sorted(r.lang for r in profiles.select("lang").distinct().collect())
    own: dict[str, list[str]] = {}
    for x in langs:
        own.setdefault(family_of(x), []).append(x)
    families = sorted(own)
    pairs = [("family", a, b) for a, b in itertools.combinations(families, 2)] + [(f, a, b) for f in families for a, b in itertools.combinations(own[f], 2)]
    model = {"langs": langs, "families": families, "own": own, "pairs": pairs, "weights": None}
    if pairs:
        sides = [(k, x, side, -(-FAMILY_ROWS // len(names)))
                 for k, (level, a, b) in enumerate(pairs) for side, name in ((1.0, a), (-1.0, b)) for names in [own[name] if level == "family" else [name]] for x in names]
        sides = docs.sparkSession.createDataFrame(sides, "k int, lang string, side double, most int")
        rows = profiles.join(few(sides), "lang").where(F.col("r") <= F.col("most")).select("k", "side", "index", "share")
        model["weights"] = stage(rows.groupBy("k").applyInArrow(_fit_pair, "k int, w binary, bias double"), "weights")
    release(sizes, profiles)
    return model


class _Votes:
    """Votes for families, and for the languages of each family, by row."""

    def __init__(self, model: dict):
        self.families, self.own = model["families"], model["own"]
        self.slot = {("family", f): i for i, f in enumerate(self.families)}
        for f in self.families:
            for x in self.own[f]:
                self.slot[f, x] = len(self.slot)

    def fresh(self, rows: int) -> np.ndarray:
        """Wins, and the weakest probability against another: two planes of rows x slots."""
        return np.stack([np.zeros((rows, len(self.slot))), np.ones((rows, len(self.slot)))])

    def add(self, state: np.ndarray, pairs: list, margins: np.ndarray) -> None:
        wins, weakest = state
        for k, (level, a, b) in enumerate(pairs):
            p = 1 / (1 + np.exp(-SLOPE * np.clip(margins[:, k], -30, 30)))
            for i, q in ((self.slot[level, a], p), (self.slot[level, b], 1 - p)):
                wins[:, i] += q
                weakest[:, i] = np.minimum(weakest[:, i], q)

    def said(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, weakest probability on the way down) of each row."""
        wins, weakest = state
        every = np.arange(wins.shape[1])
        names, score = np.empty(len(wins), dtype=object), np.empty(len(wins))
        family = wins[:, : len(self.families)].argmax(axis=1)
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            slots = every[[self.slot[name, x] for x in self.own[name]]]
            best = wins[rows][:, slots].argmax(axis=1)
            names[rows] = np.array(self.own[name], dtype=object)[best]
            score[rows] = np.minimum(weakest[rows, slots[best]], weakest[rows, f])
        return names, score


def _predict(model: dict, pairs: list, weights: np.ndarray, bias: np.ndarray, first: bool, last: bool):
    """One pass: the votes of some pairs. Votes so far travel with the rows; the last pass gives the result."""
    votes = _Votes({k: model[k] for k in ("families", "own")})

    def run(batches):
        for batch in batches:
            for at, end, raw, offsets in bytetext.blocks(batch.column("text")):
                cut = lambda name: batch.column(name).slice(at, end - at)
                if first:
                    state = votes.fresh(end - at)
                else:
                    state = np.stack([np.frombuffer(x, "<f8").reshape(2, -1) for x in cut("state").to_pylist()], axis=1).copy()
                votes.add(state, pairs, trigram_sums(raw, offsets, weights) + bias)
                if last:
                    names, score = votes.said(state)
                    letters = cut("letters").to_numpy(zero_copy_only=False)
                    names[~letters], score[~letters] = "und", 0.0
                    yield pa.RecordBatch.from_arrays([cut("id"), pa.array(names, pa.string()), pa.array(score)], names=["id", "lang_pred", "score"])
                else:
                    packed = pa.array([state[:, i].astype("<f8").tobytes() for i in range(end - at)], pa.binary())
                    yield pa.RecordBatch.from_arrays([cut("id"), cut("text"), cut("letters"), packed], names=["id", "text", "letters", "state"])

    return bytetext.lean("langid", run)


def predict(docs: DataFrame, model: dict, id_col: str, text_col: str) -> DataFrame:
    """id, lang_pred, score (the weakest probability on the way down) for every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = spread(docs.select(F.col(id_col).alias("id"), text.alias("text"), text.rlike(r"\p{L}").alias("letters")))
    kind = docs.schema[id_col].dataType.simpleString()
    if not model["langs"]:
        return rows.select("id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    plain = {k: model[k] for k in ("families", "own")}
    pairs, before = model["pairs"], None
    for at in range(0, max(1, len(pairs)), PAIRS_AT_ONCE):
        some = pairs[at : at + PAIRS_AT_ONCE]
        weights, bias = np.zeros((DIMS, len(some))), np.zeros(len(some))
        if some:
            for r in model["weights"].where(F.col("k").between(at, at + len(some) - 1)).collect():
                weights[:, r.k - at], bias[r.k - at] = np.frombuffer(r.w, "<f4"), r.bias
        last = at + PAIRS_AT_ONCE >= len(pairs)
        run = _predict(plain, some, weights, bias, at == 0, last)
        if last:
            return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double")
        rows = stage(rows.mapInArrow(run, f"id {kind}, text string, letters boolean, state binary"), "votes")
        if before is not None:
            release(before)
        before = rows
