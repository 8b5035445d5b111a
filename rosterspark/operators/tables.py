"""Union, replace, merge and sync of tables, as plans and as writes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset: an own one in local mode, an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return found.rstrip("/") if found else tempfile.mkdtemp(prefix="spark-")


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read again: what is used several times is computed once, and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def canonical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns in order; those that are missing come as blanks."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])


def replace_partitions(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partitions that the new rows have replace the old ones wholly, the others stay; equal rows once."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new).dropDuplicates()


def write_partitions(new: DataFrame, path: str, keys: Sequence[str]) -> None:
    """The same on a stored table: only partitions that the new rows have are overwritten."""
    new.dropDuplicates().write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def insert_if_absent(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return old.unionByName(new.join(old.select(*keys), list(keys), "left_anti"))


def with_fallback(before: DataFrame, after: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """Rows of the fallback for the keys that a filter (before to after) emptied."""
    emptied = before.select(key).distinct().join(after.select(key), key, "left_anti")
    return after.unionByName(fallback.join(emptied, key, "left_semi"))


def roster_sync(roster: DataFrame, done: DataFrame, keys: Sequence[str], status: str, position: str) -> DataFrame:
    """The roster in its order with the results that exist; rows gone from it are dropped, new ones have a blank status."""
    return roster.join(done, list(keys), "left").withColumn(status, F.coalesce(F.col(status), F.lit(""))).orderBy(position)


def search_paths(*paths: DataFrame) -> DataFrame:
    """Each result once, with the paths that led to it. Paths: id, path."""
    out = paths[0]
    for p in paths[1:]:
        out = out.unionByName(p)
    return out.groupBy("id").agg(F.array_sort(F.collect_set("path")).alias("paths"))


def set_relation(a: Column, b: Column) -> Column:
    """equal, subset, superset, overlap or disjoint for two arrays as sets."""
    inter = F.size(F.array_intersect(a, b))
    na, nb = F.size(F.array_distinct(a)), F.size(F.array_distinct(b))
    return F.when((inter == na) & (inter == nb), "equal").when(inter == na, "subset").when(inter == nb, "superset").when(inter > 0, "overlap").otherwise("disjoint")
