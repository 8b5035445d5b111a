"""Stored tables whose rows have keys: a batch reads, merges and rewrites only the partitions that it touches.

A batch first writes what its partitions will be beside the table, then puts that in their place. If it breaks off after the first step, it runs again
from what is written there and not from a table that may be half replaced; both steps give the same rows however often they run. Each partition is left in
`files` files, so a table doesn't fall into small ones, whatever the number of batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ingest import reprocess, run_available

BUCKET = "bucket"


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _file_system(spark, path)
    return files.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    files, at = _file_system(spark, path)
    files.delete(at, True)


def stored(spark: SparkSession, target: str, schema) -> DataFrame:
    """The table as it stands; without rows before the first batch."""
    return spark.read.schema(schema).parquet(target) if exists(spark, target) else spark.createDataFrame([], schema)


def rewrite(new: DataFrame, target: str, batch: int, partition: Sequence[str], keys: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame], files: int = 1) -> None:
    """The partitions that new rows touch become merge(their rows so far, new); all others stay as they lie."""
    spark, pending = new.sparkSession, f"{target}.pending/{batch}"
    # The kinds of columns as the table has them; partition columns come last.
    schema = new.select(*[c for c in new.columns if c not in partition], *partition).schema
    if not exists(spark, f"{pending}/_SUCCESS"):
        # As many rows as the batch has partitions.
        touched = new.select(*partition).distinct().collect()
        if not touched:
            return
        one = lambda row: [F.col(c).eqNullSafe(F.lit(row[c]).cast(schema[c].dataType)) for c in partition]
        inside = F.lit(False)
        for row in touched:
            hit = F.lit(True)
            for test in one(row):
                hit = hit & test
            inside = inside | hit
        held = F.col(partition[0]).isin([row[0] for row in touched]) if len(partition) == 1 and all(row[0] is not None for row in touched) else inside
        merge(stored(spark, target, schema).where(held), new.select(schema.names)).select(schema.names).write.mode("overwrite").parquet(pending)
    rows = spark.read.schema(schema).parquet(pending)
    spread = rows.repartition(*partition, F.pmod(F.xxhash64(*keys), F.lit(files)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(target)
    remove(spark, pending)


def latest(keys: Sequence[str], order: str, last: bool = True) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Of the rows of a key the one of greatest (or least) `order`; among equal ones the row that is greatest (least) as a whole, so reruns agree."""

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        every, pick = old.unionByName(new), F.max_by if last else F.min_by
        row = F.struct(*every.columns)
        return every.groupBy(*keys).agg(pick(row, F.struct(order, row)).alias("row")).select("row.*")

    return merge


def merge_stream(stream: DataFrame, target: str, checkpoint: str, partition: Sequence[str], keys: Sequence[str], order: str, last: bool = True, derive: Callable[[DataFrame], DataFrame] = lambda df: df, files: int = 1) -> None:
    """New records into a table by key: the last (or first) of each key stays. A key's rows must all belong to one partition."""
    run_available(stream, lambda df, batch: rewrite(derive(df), target, batch, partition, keys, latest(keys, order, last), files), checkpoint)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)


def write_state(state: DataFrame, target: str, keys: Sequence[str], buckets: int = 64) -> None:
    """A state table in folders by buckets of its keys."""
    state.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(buckets, BUCKET).write.partitionBy(BUCKET).parquet(target)


def reprocess_batch(arrived: DataFrame, target: str, batch: int, keys: Sequence[str], status: str, columns: Sequence[str], order: str, buckets: int = 64) -> None:
    """Results go into the buckets of their keys: rows that need processing take the last result by `order`; results without a row are left."""
    new = arrived.groupBy(*keys).agg(F.max_by(F.struct(status, *columns), order).alias("r")).select(*keys, "r.*").withColumn(BUCKET, bucket_of(keys, buckets))
    spark = arrived.sparkSession
    schema = spark.read.parquet(target).schema
    # The table's columns, of which new rows fill only some.
    filled = new.select(*[F.col(f.name).cast(f.dataType) if f.name in new.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    rewrite(filled, target, batch, [BUCKET], keys, lambda old, some: reprocess(old, some, keys, status, columns), 1)


def reprocess_stream(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], status: str, columns: Sequence[str], order: str, buckets: int = 64) -> None:
    """Results that arrive as a stream go into a state table (see write_state) batch by batch; a batch rewrites only the buckets of its keys."""
    run_available(stream, lambda df, batch: reprocess_batch(df, target, batch, keys, status, columns, order, buckets), checkpoint)
