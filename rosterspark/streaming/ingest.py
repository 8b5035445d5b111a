"""Tables filled from files as they come: every run handles only what is new and a crash loses nothing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import needs_processing
from ..operators.tables import shared_dir, write_partitions


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Handles all input that the checkpoint doesn't know yet, batch by batch."""
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingest(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], derive: Callable[[DataFrame], DataFrame] = lambda df: df, replace: bool = False) -> None:
    """New rows into a partitioned table.

    Each batch fills partitions of its own (the keys and the batch's number), which it replaces if it runs again; so a batch that runs twice changes
    nothing, and no batch touches another's rows. replace: batches are whole partitions, the latest takes the place of those before.
    """

    def handle(df: DataFrame, batch: int) -> None:
        if replace:
            write_partitions(derive(df), target, keys)
        else:
            write_partitions(derive(df).withColumn("batch", F.lit(batch)), target, [*keys, "batch"])

    run_available(stream, handle, checkpoint)


def first_wins(stream: DataFrame, keys: Sequence[str], time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """The first record of each key. With a time column, keys are forgotten once they are older than the delay, so state stays bounded."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys)) if time else stream.dropDuplicates(list(keys))


def reprocess(state: DataFrame, arrived: DataFrame, keys: Sequence[str], status: str, columns: Sequence[str]) -> DataFrame:
    """The state table after new results: rows that need processing take them, all others keep theirs."""
    new = arrived.select(*keys, *[F.col(c).alias(f"{c}__new") for c in (status, *columns)])
    joined = state.join(new, list(keys), "left")
    redo = needs_processing(F.col(status)) & F.col(f"{status}__new").isNotNull()
    updated = {c: F.when(redo, F.col(f"{c}__new")).otherwise(F.col(c)) for c in (*columns, status)}
    return joined.select(*[updated[c].alias(c) if c in updated else F.col(c) for c in state.columns])


def event_files(spark: SparkSession, sf_dir: str, root: str, files: int = 6) -> DataFrame:
    """A stream over the events, dealt to files by their ids, a file a batch."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(files, "event_id").write.parquet(f"{root}/events")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/events")


def ingest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events into a table by day through a stream of several files, run twice; rows and distinct ids of every day of the table."""
    root = f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex}"
    stream = event_files(spark, sf_dir, root)
    for _ in range(2):
        ingest(stream, f"{root}/table", f"{root}/checkpoint", ["day"], lambda df: df.withColumn("day", F.to_date("ts").cast("string")))
    return spark.read.parquet(f"{root}/table").groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("rows"), F.count_distinct("event_id").alias("ids"), F.sum("event_id").alias("total"))
