"""Token counts, term weights, score statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import normalize, tokens

WEIGHTED_TERMS = 128


def token_counts(df: DataFrame, text: Column) -> DataFrame:
    """token, count over all rows; counted in each task before the exchange."""
    return df.select(F.explode(tokens(normalize(text))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def term_weights(df: DataFrame, text: Column, terms: int = WEIGHTED_TERMS) -> DataFrame:
    """token, count, weight = 1/sqrt(count) of the most frequent terms; ties go to the smaller token."""
    top = token_counts(df, text).orderBy(F.desc("count"), F.asc("token")).limit(terms)
    return top.withColumn("weight", F.lit(1.0) / F.sqrt("count"))


def score_stats(df: DataFrame, score: str) -> DataFrame:
    x = F.col(score)
    return df.agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("low"), F.max(x).alias("high"))
