"""A session with the settings the engine assumes; a cluster's own settings win."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def session(cores: int | None = None, **conf: str) -> SparkSession:
    cores = cores or os.cpu_count() or 1
    builder = SparkSession.builder.master(f"local[{cores}]").appName("gleaner").config("spark.sql.shuffle.partitions", str(cores)).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g")
    for k, v in (DEFAULTS | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def few_splits(df: DataFrame) -> bool:
    """Whether a scan has fewer splits than there are cores, told by the size of its files alone: nothing is planned or run.

    Spark cuts files into pieces of a core's share, but not below the cost of opening one.
    """
    query = df._jdf.queryExecution()
    leaves = query.optimizedPlan().collectLeaves()
    size = max((int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())), default=0)
    return size < df.sparkSession.sparkContext.defaultParallelism * query.sparkSession().sessionState().conf().filesOpenCostInBytes()
