"""The page: one record of crawled text, and its limits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Byte limits of a page's fields and of the text shown to a language model.
URI_BYTES, CONTENT_BYTES, LANGUAGE_BYTES, PROMPT_BYTES = 4096, 12000, 64, 6000

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("uri", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("languages", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("length", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)

UNSCORED = float("inf")


def rescored(value: Column) -> Column:
    """A page's score, for withColumn("score", ...)."""
    return value.cast("double")


def unscored() -> Column:
    return F.lit(UNSCORED)
