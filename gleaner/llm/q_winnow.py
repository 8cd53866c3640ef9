"""Query op7_fingerprints."""

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm.common import table
from gleaner.llm.winnow import compare_with_next


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return compare_with_next(table(spark, sf_dir, "documents"))


QUERIES = {"op7_fingerprints": op7_fingerprints}
ORACLES: dict[str, str] = {}
