"""Tables kept up to date, payloads, and classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import tables as S
from ..plans import classify
from ..sources import records
from ..streaming import ingest
from .people import named
from .registry import query, table


def by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.dayofmonth("ts").alias("day"))


@query("""
WITH e AS (SELECT event_id, user_id, event_type, day(ts)::INT AS day FROM events), new AS (SELECT event_id, user_id, 'new' AS event_type, day FROM e WHERE day % 3 = 0 AND event_id % 2 = 0)
SELECT DISTINCT day, event_type, event_id FROM (SELECT * FROM e WHERE day NOT IN (SELECT day FROM new) UNION ALL SELECT * FROM new)
""")
def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third day replaced by half of its rows."""
    e = by_day(spark, sf_dir)
    new = e.where("day % 3 = 0 and event_id % 2 = 0").withColumn("event_type", F.lit("new"))
    return S.replace_partitions(e, new, ["day"]).select("day", "event_type", "event_id")


@query("""
WITH e AS (SELECT event_id, user_id, event_type, day(ts)::INT AS day FROM events)
SELECT user_id, event_id, 'old' AS origin FROM e WHERE user_id % 2 = 0 UNION ALL SELECT user_id, event_id, 'new' FROM e WHERE user_id % 2 = 1
""")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users that the old table lacks come from the new one."""
    e = by_day(spark, sf_dir).select("user_id", "event_id")
    return S.insert_if_absent(e.where("user_id % 2 = 0").withColumn("origin", F.lit("old")), e.withColumn("origin", F.lit("new")), ["user_id"])


@query("SELECT DISTINCT user_id, day(ts)::INT AS day FROM events WHERE NOT (user_id % 5 = 0 AND day(ts) < 10)")
def top_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that are not done yet."""
    pairs = by_day(spark, sf_dir).select("user_id", "day").distinct()
    return J.top_up(pairs, pairs.where("user_id % 5 = 0 and day < 10"), ["user_id", "day"])


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'matched' ELSE '' END AS status, CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal END AS result FROM supplier
""")
def roster_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roster with results that exist; results of people who left are dropped."""
    s = table(spark, sf_dir, "supplier")
    done = s.where("s_suppkey % 3 = 0").select("s_suppkey", F.lit("matched").alias("status"), F.col("s_acctbal").alias("result"))
    gone = done.limit(1).select((F.col("s_suppkey") - 1_000_000).alias("s_suppkey"), "status", "result")
    return S.roster_sync(s.select("s_suppkey"), done.unionByName(gone), ["s_suppkey"], "status", "s_suppkey")


@query("""
SELECT c_nationkey, c_custkey FROM customer WHERE c_acctbal > 9900 UNION ALL SELECT c_nationkey, -1 AS c_custkey FROM (SELECT DISTINCT c_nationkey FROM customer EXCEPT SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)
""")
def with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations that a filter emptied get a row from the fallback."""
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    after = c.where("c_acctbal > 9900").select("c_nationkey", "c_custkey")
    fallback = c.select("c_nationkey").distinct().withColumn("c_custkey", F.lit(-1).cast("long"))
    return S.with_fallback(c, after, fallback, "c_nationkey")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS course, '' AS section FROM events")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of events as rows; fields that are missing are blank."""
    e = table(spark, sf_dir, "events")
    flat = records.flatten_json(e, "props", "struct<k:bigint,section:string>", {"k": "k", "section": "section"})
    return flat.select("event_id", F.col("k").cast("bigint").alias("k"), F.col("event_type").alias("course"), "section")


RESPONSE = """
WITH r AS (SELECT l.doc_id, CASE WHEN quality IS NULL THEN '' WHEN quality = 1 AND toxic = 1 THEN 'Invalid' WHEN quality = 1 THEN 'Computer Science' ELSE 'Unknown' END AS field,
  CASE WHEN quality = 1 AND toxic = 0 THEN 'Databases|Theory' END AS subs FROM labels l)
"""


@query(RESPONSE + "SELECT doc_id, field, subs AS subfields FROM r")
def classify_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of a classifier, as JSON text that stands for the labels, read into a field and its subfields."""
    return classify.parse(responses(spark, sf_dir), "raw", ["Databases", "Theory", "Systems"]).select("doc_id", "field", "subfields")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    field = F.when((F.col("quality") == 1) & (F.col("toxic") == 1), "Invalid").when(F.col("quality") == 1, "computer science").otherwise("Unknown")
    raw = F.to_json(F.struct(field.alias("field"), F.array(F.lit("databases"), F.lit("THEORY"), F.lit("Cooking"), F.lit("Databases")).alias("subfields")))
    return lab.select("doc_id", raw.alias("raw"), "toxic")


@query(RESPONSE + "SELECT doc_id, CASE WHEN field = 'Computer Science' THEN 'Computer Science' WHEN doc_id % 2 = 0 THEN 'profile' ELSE 'no_data' END AS label FROM r")
def cascade_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first source's field if it decides, else the second's, else a fallback label."""
    first = classify.parse(responses(spark, sf_dir), "raw", ["Databases", "Theory"])
    second = F.when(F.col("doc_id") % 2 == 0, "profile")
    return first.select("doc_id", classify.cascade(F.when(F.col("field") == "Computer Science", F.col("field")), second, F.lit(False)).alias("label"))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 0 OR c_custkey % 5 IN (0, 2, 3)")
def verdict_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a verdict rejects go, unless their link ends in digits, holds a part of the name or shares four letters with it."""
    c = named(table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey")
    base, k = F.lit("https://x.example/"), F.col("id")
    kinds = [F.concat(base, F.lower("last")), F.concat(base, F.lit("zz")), F.concat(base, F.lit("u/"), k.cast("string")), F.concat(base, F.lit("q"), F.substring(F.lower(F.concat("first", "last")), 2, 5)), F.concat(base, F.lit("www"))]
    rows = c.select(k.alias("c_custkey"), F.concat_ws(" ", "first", "last").alias("name"), F.element_at(F.array(*kinds), (k % 5 + 1).cast("int")).alias("url"))
    verdicts = rows.select("c_custkey", (F.col("c_custkey") % 4 != 0).alias("verdict"))
    return classify.drop_rejected(rows, verdicts, "c_custkey").select("c_custkey")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*)::BIGINT AS rows, count(DISTINCT event_id)::BIGINT AS ids, sum(event_id)::BIGINT AS total FROM events GROUP BY 1")
def resumable_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events ingested as a stream of files into a table by day, twice; the second run finds nothing new."""
    return ingest.ingest_events(spark, sf_dir)
