"""Structured Streaming: pages as they land, running top-k, deduplication."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from gleaner.functions.simhash import simhash
from gleaner.operators.dedup import SeenSet
from gleaner.operators.topk import bounded_topk


def landed(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 64) -> DataFrame:
    """The Parquet files of a folder, or one file, as a stream; the bound on files is the back-pressure."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    files = spark.read.parquet(path).inputFiles()
    if len(files) == 1 and files[0].endswith("/" + path.rstrip("/").rpartition("/")[2]):  # a file: its folder, and only it
        folder, _, name = path.rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder or ".")
    return reader.parquet(path)


def running_topk(stream: DataFrame, state: str, checkpoint: str, score: str, k: int, ascending: bool = True, tie: str = "uri") -> StreamingQuery:
    """The k best rows so far, in Parquet folders state/batch=N: each batch joins the last one's k rows, and only those.

    A batch that is repeated after a failure overwrites its own folder from the one before, so the result is exact; folders
    before that one are removed.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number > 0:
            batch = batch.unionByName(spark.read.schema(batch.schema).parquet(f"{state}/batch={number - 1}"))
        bounded_topk(batch, score, k, ascending, tie).coalesce(1).write.mode("overwrite").parquet(f"{state}/batch={number}")
        if number > 1:
            _remove(spark, f"{state}/batch={number - 2}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def latest_topk(spark: SparkSession, state: str) -> DataFrame:
    """The last batch's rows."""
    batches = spark.read.option("basePath", state).parquet(state)
    last = batches.agg(F.max("batch")).first()[0]
    return batches.where(F.col("batch") == last).drop("batch")


def stream_dedup(stream: DataFrame, content: str = "content", event_time: str | None = None, within: str | None = None) -> DataFrame:
    """One row for each fingerprint, for ever or within a time after the watermark."""
    marked = stream.withColumn("_fp", simhash(F.col(content)))
    if event_time and within:
        return marked.withWatermark(event_time, within).dropDuplicatesWithinWatermark(["_fp"]).drop("_fp")
    return marked.dropDuplicates(["_fp"]).drop("_fp")


def stream_fifo_dedup(stream: DataFrame, capacity: int, lanes: int = 8, content: str = "content") -> DataFrame:
    """The count-bounded window as state of each lane; equal fingerprints meet in one lane."""
    marked = stream.withColumn("_fp", simhash(F.col(content))).withColumn("_lane", F.pmod(F.col("_fp"), F.lit(lanes)))
    names = stream.columns

    def run(key: tuple, frames, state: GroupState):
        seen = SeenSet(capacity)
        for fp in state.get[0] if state.exists else []:
            seen.held[fp] = None
        for frame in frames:
            keep = [seen.admit(int(fp)) for fp in frame["_fp"]]
            yield pd.DataFrame(frame[keep][names])
        state.update((list(seen.held),))

    return marked.groupBy("_lane").applyInPandasWithState(run, stream.schema, "fps array<bigint>", "append", GroupStateTimeout.NoTimeout)


def drain(query: StreamingQuery, then: Callable[[], DataFrame]) -> DataFrame:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return then()
