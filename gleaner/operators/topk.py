"""Bounded top-k: each task keeps k rows, and only those meet."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bounded_topk(df: DataFrame, score: str, k: int, ascending: bool = True, tie: str = "uri") -> DataFrame:
    """The k best rows, best first; ties go to the smaller `tie`."""
    return df.orderBy(F.col(score).asc() if ascending else F.col(score).desc(), F.col(tie).asc()).limit(k)


def grouped_topk(df: DataFrame, group: str, score: str, k: int, ascending: bool = True, tie: str = "uri") -> DataFrame:
    """The k best rows of each group; tasks keep k rows of a group before the exchange."""
    order = Window.partitionBy(group).orderBy(F.col(score).asc() if ascending else F.col(score).desc(), F.col(tie).asc())
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")
