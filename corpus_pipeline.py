"""A corpus pipeline: five operators, each on all that the one before it kept.

STAGES are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. The first four return the columns of
documents: languages and toxicity drop rows, the join keeps one document of each group of near duplicates, the mix repeats and
leaves out documents; the last returns the tokens' digests. run() writes each stage as Parquet in the folder that the cluster shares and
reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterspark.llm import bpe, language_id, mixing, near_duplicates, toxicity
from rosterspark.llm.common import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document whose n-grams stand so far from every profile reads like no language that was learnt.
LEAST_LANGUAGE_SCORE = 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Goes: documents without letters (und) and those near to no learnt language."""
    found = language_id.identify(docs, language_id.learn(docs), keep=True)
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(COLUMNS)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Goes: documents that are predicted toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(docs, *toxicity.learn(docs, labels), keep=True).where("predicted = 0").select(COLUMNS)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stays: one row of each group, that of smallest id and then text hash, and each distinct document that is linked with nothing.

    Rows without an id are known by their text; in a group, a row with an id comes before them.
    """
    text_key = F.shiftrightunsigned(F.xxhash64("text"), 2).bitwiseOR(F.lit(1 << 62))
    keyed = docs.withColumn("key", F.coalesce(F.col("doc_id"), text_key))
    groups = near_duplicates.link_groups(keyed.withColumn("doc_id", F.col("key")))
    found = staged(groups.select(F.col("doc_id").alias("key"), F.col("component_id").alias("component")), "groups")
    kept = found.where("component = key or component is null").groupBy("key").agg(F.count("*").alias("n"), F.max("component").isNull().alias("alone"))
    # Most keys stand once and are kept: their texts stay where they are. Those of other keys, and a few by chance, are joined.
    others = found.where("component <> key").select("key").unionByName(kept.where("n > 1").select("key"))
    seen = near_duplicates.marked(keyed, others, "key")
    sure = seen.where("not marked").select(COLUMNS)
    rest = seen.where("marked").drop("marked")
    once = rest.join(kept.where("n = 1"), "key", "left_semi").select(COLUMNS)
    # Copies shrink to one in the tasks that read them.
    again = rest.join(kept.where("n > 1"), "key").withColumn("hash", F.xxhash64("text"))
    best = again.groupBy("key", F.when(F.col("alone"), F.col("hash")).alias("own")).agg(F.min_by(F.struct(*COLUMNS), F.struct("hash", *COLUMNS)).alias("row"))
    return sure.unionByName(once).unionByName(best.select("row.*"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    taken = mixing.mix(docs, keep=True)
    return taken.where("copies > 0").withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and their decoded bytes, as digests."""
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language", language), ("toxicity", toxic), ("near_duplicates", near_duplicate), ("mixing", mixed), ("tokens", tokens)]

#: Learnt profiles and tokenizers can't be written in SQL; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
