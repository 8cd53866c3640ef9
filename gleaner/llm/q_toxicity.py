"""Query op4_toxicity."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import fold, table
from gleaner.llm.toxicity import fit, score

THRESHOLD = 0.3


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned on labelled documents of folds other than 2, scored for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    weights = fit(docs, labels.where(fold("doc_id", 4) != 2), "doc_id", "text", "toxic")
    out = score(docs, weights, "doc_id", "text")
    return out.select(F.col("id").alias("doc_id"), (fold("id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLES: dict[str, str] = {}
