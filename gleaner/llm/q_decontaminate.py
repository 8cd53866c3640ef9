"""Query op3_decontamination."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import table
from gleaner.llm.decontaminate import leaks


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item it matches best."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return leaks(docs, table(spark, sf_dir, "benchmark")).withColumn("contaminated", F.lit(True))


QUERIES = {"op3_decontamination": op3_decontamination}
ORACLES: dict[str, str] = {}
