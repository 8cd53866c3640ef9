"""A corpus pipeline over documents: language ID, near-duplicates, decontamination, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the next
stage's docs. All stages but the last return the columns of documents.

Edge cases, in every stage: an empty table gives an empty one; further columns are carried, whatever their names; rows are
told apart by id and text, so an id that several texts have loses only those that are rejected; of rows that are equal in
both, near-duplicates keep one and the other stages treat all alike; texts of any length are read whole; nulls in other
columns are carried. Rows with a null doc_id, texts that are null and texts without a letter are rejected by the first
stage; a later stage taken alone keeps them, as it finds nothing in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import decontaminate, langid, minhash, packing, secrets
from gleaner.llm.common import fold, stage, table
from gleaner.llm.q_packing import tokenizer_path

#: Ids that a broadcast may hold: eight bytes each.
BROADCAST_IDS = 1_000_000
#: Below this score of the weakest decision a text counts as no language; with two classes on each level none is below.
LEAST_SURE = 0.2


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a key of each id and text, and the key's name: ids may repeat or be null."""
    taken = {c.lower() for c in docs.columns}
    name = next(n for n in (f"_row_{i}" for i in range(len(taken) + 1)) if n not in taken)
    # A null leaves the hash as it is, so each value is hashed with whether it is there.
    return docs.withColumn(name, F.xxhash64(F.isnull("doc_id"), "doc_id", F.isnull("text"), "text")), name


def _without(keyed: DataFrame, key: str, rejected: DataFrame) -> DataFrame:
    """docs without the rejected keys: a broadcast up to BROADCAST_IDS of them, a shuffled join beyond."""
    rejected = stage(rejected.toDF(key).distinct(), "drop")
    return keyed.join(F.broadcast(rejected) if rejected.count() <= BROADCAST_IDS else rejected, key, "left_anti").drop(key)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what has no recognisable language."""
    known = docs.select("doc_id", "text", "lang")
    model = langid.fit(known.where(fold("doc_id", 3) != 1), "doc_id", "text", "lang")
    keyed, key = _keyed(docs.where(F.col("doc_id").isNotNull()))
    said = langid.predict(keyed.select(key, "text"), model, key, "text")
    return _without(keyed, key, said.where((F.col("lang_pred") == "und") | (F.col("score") < LEAST_SURE)).select("id"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group stays, the one with the smallest key: shingles of five words, similarity 0.8 or more. Texts
    without a word are in no group; ties between equal rows are settled by keeping one of them."""
    keyed, key = _keyed(docs)
    found = stage(minhash.near_duplicates(keyed, key, shingle=5, percent=80), "near")
    # Only rows of one id and one text share a key.
    if not found.groupBy("doc_id").count().where(F.col("count") > 1).isEmpty():
        keyed = keyed.dropDuplicates([key])
    return _without(keyed, key, found.where(~F.col("kept")).select("doc_id"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, for each of their rows; without a benchmark all stay."""
    keyed, key = _keyed(docs)
    return _without(keyed, key, decontaminate.leaks(keyed, table(spark, sf_dir, "benchmark"), key).select("doc_id"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; documents without any stay as they are."""
    taken = {c.lower() for c in docs.columns}
    name, key = [n for n in (f"_masked_{i}" for i in range(len(taken) + 2)) if n not in taken][:2]
    # The id and the text's hash name a text even where ids repeat or are null.
    keyed = docs.withColumn(key, F.struct("doc_id", F.xxhash64("text")))
    found = secrets.scan(keyed, key, "text").where(F.size("spans") > 0).select(F.col("id").alias(key), F.col("spans").alias(name))
    found = stage(found.dropDuplicates([key]), "secrets")
    size = found.agg(F.sum(F.size(name) + 4)).first()[0] or 0
    out = keyed.join(F.broadcast(found) if size <= BROADCAST_IDS else found, key, "left")
    has = F.col(name).isNotNull()
    out = out.withColumn("text", F.when(has, secrets.masked(F.col("text"), F.col(name))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(has, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 2048 tokens; a null text is an empty one."""
    return packing.pack(docs, tokenizer_path(), capacity=2048, closing=0)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Models, sketches and token ids are beyond SQL; tests/llm/test_pipeline.py holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
