"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows and bytes of the Arrow batches in which texts go to Python.
BATCH_ROWS, BATCH_BYTES = 1024, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_in_small_batches(spark: SparkSession) -> None:
    """From now on the Arrow batches of this session hold few texts, so that a task holds a few MB of them at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir). Where it is unset: an own one in local mode, an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: lineage ends there, and lost executors lose nothing.

    Files that the write shuffled are removed when it ends; no later plan reads them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, None)
    spark.conf.set(cleanup, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(cleanup) if before is None else spark.conf.set(cleanup, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def released(*frames: DataFrame) -> None:
    """Empties staged tables that nothing reads any more."""
    for df in frames:
        df.sparkSession.createDataFrame([], "emptied boolean").write.mode("overwrite").parquet(df.staged_at)


def in_training(doc_id: str = "doc_id", folds: int = 4, held_out: int = 2) -> Column:
    """False for the rows held out: those whose crc32 of the id, written as text, leaves held_out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds != held_out, F.lit(True))


def bounded_sample(df: DataFrame, by: str, at_most: int, key: str = "doc_id") -> DataFrame:
    """About at_most rows of each value of `by` (all, if fewer), chosen by a hash of the key, so that reruns agree."""
    counts = {r[0]: r[1] for r in df.groupBy(by).count().collect()}
    share = F.lit(1.0)
    for value, n in counts.items():
        share = F.when(F.col(by) == F.lit(value), F.lit(min(1.0, at_most / n))).otherwise(share)
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) < share * F.lit(float(1 << 30)))
