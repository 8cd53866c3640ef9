"""Query op6_secret_scan."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import table
from gleaner.llm.secrets import KINDS, as_text, scan


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of every document."""
    found = scan(table(spark, sf_dir, "documents"), "doc_id", "text")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("bigint")
    return found.select(F.col("id").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in KINDS[:3]], F.sha2(as_text(base).cast("binary"), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"))


QUERIES = {"op6_secret_scan": op6_secret_scan}
ORACLES: dict[str, str] = {}
