"""What the training-data operators share: staging, scan spreading, reading tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import few_splits

_own_dir: str | None = None


def staging_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in spark.checkpoint.dir; on one machine, a folder of our own where it is unset."""
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _own_dir is None or not os.path.isdir(_own_dir):
        _own_dir = tempfile.mkdtemp(prefix="gleaner-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return _own_dir


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{staging_dir(spark)}/gleaner/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def release(*staged: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for df in staged:
        path = getattr(df, "_staged_at", None)
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an Arrow batch on its way to Python and back, and Spark's own default, which is sixteen times as much.
BATCH_BYTES, SPARK_BATCH_BYTES = 4 << 20, "67108864b"


def spread(df: DataFrame) -> DataFrame:
    """Rows on their way to Python. They are dealt over all cores when the scan has fewer splits than cores (one small file);
    large scans stay as they are. Batches are kept small unless the session has a size of its own."""
    spark = df.sparkSession
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == SPARK_BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # By a hash of the row's number: dealing in turns would sort whole rows first.
    return df.repartition(spark.sparkContext.defaultParallelism, F.monotonically_increasing_id()) if few_splits(df) else df


def fold(id_col: str, parts: int):
    """The fold of a row: CRC-32 of its id as text, modulo parts; -1 without an id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts)), F.lit(-1))
