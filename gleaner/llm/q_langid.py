"""Query op9_language_id."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import fold, table
from gleaner.llm.langid import fit, predict


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned on the folds other than 1, predicted for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(fold("doc_id", 3) != 1), "doc_id", "text", "lang")
    return predict(docs, model, "doc_id", "text").select(F.col("id").alias("doc_id"), (fold("id", 3) == 1).alias("held_out"), "lang_pred", "score")


QUERIES = {"op9_language_id": op9_language_id}
ORACLES: dict[str, str] = {}
