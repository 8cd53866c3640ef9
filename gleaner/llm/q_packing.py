"""Query op2_best_fit_packing."""

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm.common import table
from gleaner.llm.packing import pack


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens, each document closed by id 0."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, closing=0)


QUERIES = {"op2_best_fit_packing": op2_best_fit_packing}
ORACLES: dict[str, str] = {}
