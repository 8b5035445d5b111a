"""CSV tables, nested JSON documents, and how tables are published."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], sep: str = ",") -> DataFrame:
    """CSV files or folders of them, all columns strings; empty cells are blanks, never null. Files with a header alone give no rows."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.read.schema(schema).options(header=True, multiLine=True, escape='"', sep=sep, enforceSchema=False)
    return reader.csv(paths if isinstance(paths, str) else list(paths)).na.fill("")


def with_origin(df: DataFrame, name: str = "origin") -> DataFrame:
    """The name of the file that a row comes from, without its ending."""
    return df.withColumn(name, F.regexp_replace(F.url_decode(F.element_at(F.split("_metadata.file_path", "/"), -1)), r"\.\w+$", ""))


def split_document(df: DataFrame, column: str, schema: T.DataType) -> dict[str, DataFrame]:
    """A JSON object of entities ({name: {fields, faculty: [...], ...}}) as a table of entities and one for each array field."""
    entities = df.select(F.explode(F.from_json(column, T.MapType(T.StringType(), schema))).alias("college", "e"))
    arrays = [f.name for f in schema.fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)]
    out = {"college": entities.select("college", *[f"e.{f.name}" for f in schema.fields if f.name not in arrays])}
    return out | {a: entities.select("college", F.posexplode(f"e.{a}").alias("pos", "x")).select("college", "pos", "x.*") for a in arrays}


def write_by_key(df: DataFrame, path: str, key: str, columns: Sequence[str]) -> None:
    """A CSV folder for each value of the key, columns in order, quotes doubled."""
    df.select(key, *[c for c in columns if c != key]).repartition(key).write.mode("overwrite").options(header=True, escape='"').partitionBy(key).csv(path)


def write_document(df: DataFrame, path: str) -> None:
    """One JSON object for each row; Spark's committer publishes all files or none."""
    df.write.mode("overwrite").json(path)


def publish(df: DataFrame, root: str, version: str) -> DataFrame:
    """A new version beside the old ones; versions sort as texts.

    Readers follow the greatest version named in the folder `published`, to which one small file is added when all others are in place;
    nothing is ever overwritten, so a crash leaves the version before.
    """
    df.write.mode("errorifexists").parquet(f"{root}/v={version}")
    df.sparkSession.createDataFrame([(version,)], "version string").coalesce(1).write.mode("append").parquet(f"{root}/published")
    return current(df.sparkSession, root)


def current(spark: SparkSession, root: str) -> DataFrame:
    newest = spark.read.schema("version string").parquet(f"{root}/published").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{root}/v={newest}")
