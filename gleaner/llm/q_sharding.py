"""Query op10_sharding."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import table
from gleaner.llm.sharding import shard


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into eight shards under the law `rows`."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = shard(docs, ["doc_id", "text_crc32", "size"], shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op10_sharding": op10_sharding}
ORACLES: dict[str, str] = {}
