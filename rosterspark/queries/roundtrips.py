"""Sources and sinks: rows of the tables are written in the form that a source has and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from ..operators import reshape as R
from ..operators import tables as S
from ..sources import records, tabular, web
from ..streaming import ingest, keyed
from .registry import query, table


def folder(spark: SparkSession, label: str) -> str:
    return f"{S.shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@query("""
SELECT c_custkey::VARCHAR AS c_custkey, c_name || ', "' || c_mktsegment || '"' AS name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS segment, '' AS website, c_nationkey::INT AS nation FROM customer
""")
def csv_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a folder of CSV files for each nation, read as texts: quotes and commas in cells, blanks, a column that the files lack."""
    c = table(spark, sf_dir, "customer")
    name = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"'))
    root = folder(spark, "csv")
    out = c.select(F.col("c_nationkey").alias("nation"), "c_custkey", name.alias("name"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("segment"))
    tabular.write_by_key(out, root, "nation", ["c_custkey", "name", "segment"])
    back = tabular.read_csv(spark, root, ["c_custkey", "name", "segment"])
    nation = F.regexp_extract("_metadata.file_path", r"nation=(\d+)", 1).cast("int")
    kept = back.withColumn("nation", nation)
    return S.canonical(kept, ["c_custkey", "name", "segment", "website", "nation"]).withColumn("nation", F.col("nation").cast("int"))


@query("SELECT n_name AS origin, count(*)::BIGINT AS files, sum(n_regionkey)::BIGINT AS total FROM nation GROUP BY 1")
def csv_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV file for each nation; the file's name says whose it is."""
    root = folder(spark, "origins")
    n = table(spark, sf_dir, "nation")
    n.select("n_name", "n_regionkey").repartition("n_name").write.option("header", True).partitionBy("n_name").csv(root)
    back = tabular.read_csv(spark, root, ["n_regionkey"])
    # Spark names the files itself, so the folder stands for the name that a file would have.
    named = tabular.with_origin(back.withColumn("file", F.regexp_extract(F.url_decode("_metadata.file_path"), "n_name=([^/]+)/", 1)))
    return named.where("origin <> ''").groupBy(F.col("file").alias("origin")).agg(F.count("*").alias("files"), F.sum(F.col("n_regionkey").cast("long")).alias("total"))


@query("""
SELECT n_name AS college, r_name AS state, (row_number() OVER (PARTITION BY n_nationkey ORDER BY c_custkey) - 1)::INT AS pos, c_name AS name, NULLIF(c_mktsegment, 'BUILDING') AS title
FROM nation JOIN region ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
""")
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested JSON document for each nation with its customers, written and split into tables again."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey", F.col("c_name").alias("name"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("title"))
    nested = R.nest(c, "n_nationkey", "c_custkey", ["name", "title"], "faculty")
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).join(nested, "n_nationkey")
    root = folder(spark, "documents")
    tabular.write_document(n.select(F.map_from_arrays(F.array("n_name"), F.array(F.struct(F.col("r_name").alias("state"), "faculty"))).alias("doc")), root)
    schema = Ty.StructType([Ty.StructField("state", Ty.StringType()), Ty.StructField("faculty", Ty.ArrayType(Ty.StructType([Ty.StructField("name", Ty.StringType()), Ty.StructField("title", Ty.StringType())])))])
    text = spark.read.text(root).select(F.get_json_object("value", "$.doc").alias("doc"))
    parts = tabular.split_document(text, "doc", schema)
    return parts["college"].join(parts["faculty"], "college").select("college", "state", "pos", "name", "title")


@query("SELECT s_suppkey::VARCHAR AS code, s_name || ' & Sons' AS name, CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE s_nationkey::VARCHAR END AS nation FROM supplier")
def xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as records of XML files; names hold markup as text, some fields are missing."""
    s, root = table(spark, sf_dir, "supplier"), folder(spark, "xml")
    field = F.when(F.col("s_suppkey") % 2 == 0, "").otherwise(F.concat(F.lit("<nation>"), F.col("s_nationkey").cast("string"), F.lit("</nation>")))
    record = F.concat(F.lit("<course><code>"), F.col("s_suppkey").cast("string"), F.lit("</code><title>&lt;b&gt;"), "s_name", F.lit("&lt;/b&gt; &amp;amp; Sons</title>"), field, F.lit("</course>"))
    # A file for each of some groups of suppliers, with one root.
    files = s.groupBy(F.pmod(F.xxhash64("s_suppkey"), F.lit(64)).alias("file")).agg(F.concat(F.lit("<all>"), F.array_join(F.collect_list(record), ""), F.lit("</all>")).alias("value"))
    files.write.partitionBy("file").text(root)
    return records.read_xml(spark, f"{root}/*", "course", {"code": "code", "name": "title", "nation": "nation"}, "code string, title string, nation string")


@query("""
WITH l AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)
SELECT user_id, event_id, CASE WHEN ((n - 1) // 4) % 2 = 0 THEN event_type ELSE event_id::VARCHAR END AS kind, CASE WHEN ((n - 1) // 4) % 2 = 0 THEN event_id::VARCHAR ELSE event_type END AS number FROM l WHERE n % 4 <> 1
""")
def headers_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited rows under headers that repeat with their columns in another order: every fourth row of a user is a header, in turns (kind, number, kind) and (number, kind)."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    first = F.array(F.lit("kind"), F.lit("number"), F.lit("kind"))
    header = F.when(F.col("n") % 8 == 1, first).otherwise(F.array(F.lit("number"), F.lit("kind")))
    cells = F.when(F.col("n") % 4 == 1, header).otherwise(F.array("event_type", F.col("event_id").cast("string"), F.lit("spare")))
    rows = e.withColumn("n", n).withColumn("cells", cells)
    read = web.repeated_headers(rows, "user_id", "event_id", "cells", F.col("n") % 4 == 1)
    return read.select("user_id", "event_id", F.element_at("row", F.lit("kind")).alias("kind"), F.element_at("row", F.lit("number")).alias("number"))


@query("""
WITH l AS (SELECT c_nationkey AS doc, c_custkey AS pos, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n FROM customer)
SELECT doc, pos, CASE WHEN ((n - 1) // 5) % 2 = 0 THEN 'old' ELSE 'new' END AS layout, CASE WHEN ((n - 1) // 5) % 2 = 0 THEN 'Days' ELSE 'Time' END AS second FROM l WHERE n % 5 <> 1
""")
def layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of tables in an old and a new layout, known by the header before them."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("doc"), F.col("c_custkey").alias("pos"), F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")).alias("n"))
    header = F.when(F.col("n") % 10 == 1, F.array(F.lit(" CRN"), F.lit("Days"))).otherwise(F.array(F.lit("Course Section"), F.lit("Time")))
    rows = c.withColumn("cells", F.when(F.col("n") % 5 == 1, header).otherwise(F.array(F.col("pos").cast("string"), F.lit("x"))))
    return web.with_layout(rows, "doc", "pos", "cells", {"CRN": "old", "Course Section": "new"}).select("doc", "pos", "layout", F.col("header")[1].alias("second"))


@query("SELECT s_suppkey::VARCHAR AS code, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE s_nationkey::VARCHAR END AS name, '' AS time FROM supplier")
def header_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns under whatever spelling of their header; the first filled one counts."""
    s = table(spark, sf_dir, "supplier")
    odd = s.select(F.col("s_suppkey").alias("Course Code"), F.when(F.col("s_suppkey") % 2 == 0, F.concat("s_name", F.lit(" "))).otherwise("").alias("TITLE "), F.col("s_nationkey").alias("course-name"))
    return web.rename_by_alias(odd, {"code": ["course code"], "name": ["title", "Course Name"], "time": ["Meeting Time"]})


@query("SELECT o_custkey::INT AS page, (o_orderkey % 7)::INT AS line, CASE o_orderkey % 2 WHEN 0 THEN 'code' ELSE 'name' END AS col, string_agg(o_orderkey::VARCHAR, ' ' ORDER BY o_orderkey) AS text FROM orders GROUP BY 1, 2, 3")
def word_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as words on a customer's page: words of like height are a line, columns are ranges of x."""
    k = F.col("o_orderkey")
    # Even keys lie from 0 to 500,000, odd ones beyond.
    x = F.when(k % 2 == 0, k / 1000).otherwise(500_000 + k / 1000)
    words = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("int").alias("page"), k.cast("string").alias("text"), x.alias("x0"), (x + 0.2).alias("x1"), ((k % 7) * 3.0 + 0.4).alias("top"))
    bounds = spark.createDataFrame([("code", 0.0, 500_000.0), ("name", 500_000.0, 2_000_000.0)], "col string, lo double, hi double")
    return web.word_table(words, bounds)


@query("""
WITH y AS (SELECT o_custkey, year(o_orderdate)::INT AS y, count(*)::INT AS n FROM orders GROUP BY 1, 2), t AS (SELECT o_custkey, sum(n)::INT AS every, coalesce(sum(n) FILTER (WHERE y >= 1999), 0)::INT AS recent FROM y GROUP BY 1)
SELECT c_custkey AS page, c_name AS name, y AS year, n AS works, every, recent, c_mktsegment AS tag FROM customer JOIN y ON y.o_custkey = c_custkey JOIN t ON t.o_custkey = c_custkey
""")
def profile_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile pages of customers (name, metrics, works a year, tags), written as html and read again."""
    y = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    spans = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y", "n"))), lambda s: F.concat(F.lit('<span class="year">'), s["y"].cast("string"), F.lit('</span><span class="count">'), s["n"].cast("string"), F.lit("</span>"))), "")
    t = y.groupBy(F.col("o_custkey").alias("c_custkey")).agg(spans.alias("spans"), F.sum("n").alias("every"), F.coalesce(F.sum(F.when(F.col("y") >= 1999, F.col("n"))), F.lit(0)).alias("recent"))
    row = lambda label, a, b: F.concat(F.lit(f"<tr><td>{label}</td><td>"), a.cast("string"), F.lit("</td><td> "), b.cast("string"), F.lit("</td></tr>"))
    html = F.concat(
        F.lit("<html><body><h1> "), "c_name", F.lit("</h1><table><tr><th>Metric</th><th>All</th><th>Recent</th></tr>"), row("Works", F.col("every"), F.col("recent")), row("WORKS", F.lit(0), F.lit(0)),
        F.lit("</table>"), "spans", F.lit('<a class="tag" href="/t">'), "c_mktsegment", F.lit("</a></body></html>"),
    )
    pages = table(spark, sf_dir, "customer").join(t, "c_custkey").select(F.col("c_custkey").alias("page"), html.alias("html"))
    p = web.profile(pages, "page", "html")
    works = F.element_at("metrics", F.lit("works"))
    return p.select("page", "name", F.explode("by_year").alias("year", "works"), works["all"].alias("every"), works["recent"].alias("recent"), F.element_at("tags", 1).alias("tag"))


@query("SELECT n_nationkey, n_name, 2 AS edition FROM nation WHERE n_regionkey > 0")
def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a table published one after the other; readers see the later one whole."""
    n, root = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), folder(spark, "versions")
    tabular.publish(n.withColumn("edition", F.lit(1)), root, "2024-01-01")
    return tabular.publish(n.where("n_regionkey > 0").withColumn("edition", F.lit(2)), root, "2024-02-01").select("n_nationkey", "n_name", "edition")


@query("SELECT user_id, min(event_id)::BIGINT AS event_id FROM events GROUP BY 1")
def first_wins_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user from a stream of files in the order of their ids, kept once over all batches."""
    root = folder(spark, "first")
    # Files are read in the order in which they were written.
    events = table(spark, sf_dir, "events").select("user_id", "event_id")
    for part in range(3):
        events.where(f"event_id % 3 = {part}").groupBy("user_id").agg(F.min("event_id").alias("event_id")).withColumn("part", F.lit(part)).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema("user_id long, event_id long, part int").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    ingest.ingest(ingest.first_wins(stream, ["user_id", "part"]), f"{root}/out", f"{root}/checkpoint", ["part"])
    return spark.read.parquet(f"{root}/out").groupBy("user_id").agg(F.min("event_id").alias("event_id"))


@query("""
WITH n AS (SELECT event_id % 3 AS part, user_id, max(event_id) AS e FROM events WHERE event_type = 'purchase' GROUP BY 1, 2),
s AS (SELECT DISTINCT user_id FROM events)
SELECT s.user_id, CASE WHEN user_id % 4 = 0 THEN 'manual_approved' WHEN n.e IS NULL THEN '' ELSE 'matched' END AS status, CASE WHEN user_id % 4 = 0 THEN NULL ELSE n.e END::BIGINT AS result
FROM s LEFT JOIN n USING (user_id) WHERE n.part IS NULL OR n.part = (SELECT min(part) FROM n m WHERE m.user_id = s.user_id)
""")
def reprocess_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state table of users filled by results that arrive in three files: rows that are still to do take the first result, approved ones stay."""
    root = folder(spark, "reprocess")
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    state = e.select("user_id").distinct().select("user_id", F.when(F.col("user_id") % 4 == 0, "manual_approved").otherwise("").alias("status"), F.lit(None).cast("long").alias("result"))
    keyed.write_state(state, f"{root}/state", ["user_id"], 8)
    arrived = e.where("event_type = 'purchase'").select("user_id", F.lit("matched").alias("status"), F.col("event_id").alias("result"), (F.col("event_id") % 3).alias("part"))
    for part in range(3):
        arrived.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema("user_id long, status string, result long").parquet(f"{root}/in")
        keyed.reprocess_stream(stream, f"{root}/state", f"{root}/checkpoint", ["user_id"], "status", ["result"], "result", 8)
    return spark.read.parquet(f"{root}/state").drop(keyed.BUCKET)


@query("""
WITH v AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_id % 10 = 0 THEN 3 WHEN event_id % 5 = 0 THEN 2 ELSE 1 END AS version FROM events)
SELECT day, count(*)::BIGINT AS rows, sum(version)::BIGINT AS versions, sum(event_id)::BIGINT AS total, 1::BIGINT AS files FROM v GROUP BY 1
""")
def keyed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day from a stream of files in which some come two or three times, each time as a later version, not in order; rows, versions and files of every day of the table."""
    root = folder(spark, "keyed")
    versions = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(3), F.lit(1), F.lit(2))).when(F.col("event_id") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    events = table(spark, sf_dir, "events").select("event_id", "ts", F.explode(versions).alias("version"))
    events.repartition(6, "event_id", "version").write.parquet(f"{root}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    for _ in range(2):  # the second run finds nothing new
        keyed.merge_stream(stream, f"{root}/table", f"{root}/checkpoint", ["day"], ["event_id"], "version", derive=lambda df: df.withColumn("day", F.date_format("ts", "yyyy-MM-dd")))
    out = spark.read.schema("event_id long, ts timestamp, version int, day string").parquet(f"{root}/table").withColumn("file", F.col("_metadata.file_path"))
    return out.groupBy("day").agg(F.count("*").alias("rows"), F.sum("version").alias("versions"), F.sum("event_id").alias("total"), F.count_distinct("file").alias("files"))


PARSED = """
WITH c AS (SELECT c_custkey, c_mktsegment AS source, c_name, c_nationkey FROM customer)
"""


@query(PARSED + """
SELECT source, c_custkey::VARCHAR AS code, CASE WHEN source = 'BUILDING' THEN c_name ELSE upper(c_name) END AS name, '' AS error FROM c WHERE source IN ('BUILDING', 'MACHINERY') AND NOT (source = 'MACHINERY' AND c_custkey % 7 = 0)
UNION ALL SELECT source, '' AS code, '' AS name, CASE WHEN source = 'MACHINERY' THEN 'ValueError: no table' ELSE 'KeyError: ''' || source || '''' END AS error FROM c WHERE source NOT IN ('BUILDING', 'MACHINERY') OR source = 'MACHINERY' AND c_custkey % 7 = 0
""")
def parsers_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of two sources read by their parsers; broken payloads and sources without a parser come with the reason."""
    k = F.col("c_custkey")
    payload = F.when((F.col("c_mktsegment") == "MACHINERY") & (k % 7 == 0), "broken").otherwise(F.concat(k.cast("string"), F.lit("|"), "c_name"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("source"), payload.alias("payload"))

    def plain(pdf):
        return pdf.payload.str.split("|", expand=True).rename(columns={0: "code", 1: "name"})

    def loud(pdf):
        if (pdf.payload == "broken").any():
            raise ValueError("no table")
        return plain(pdf).assign(name=lambda x: x["name"].str.upper())

    good, bad = records.by_source(rows, {"BUILDING": plain, "MACHINERY": loud}, ["code", "name"])
    return good.withColumn("error", F.lit("")).unionByName(bad.select("source", F.lit("").alias("code"), F.lit("").alias("name"), "error"))


@query("SELECT o_orderkey, o_orderstatus AS source, 'https://x.example/' || lower(o_orderstatus) AS base, CASE WHEN o_orderstatus = 'F' THEN 500 ELSE 200 END AS page_size FROM orders WHERE o_orderstatus <> 'P'")
def configured_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the configuration of their source; rows of a source without one go."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("source"))
    config = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("source")).distinct().where("source <> 'P'")
    config = config.select("source", F.concat(F.lit("https://x.example/"), F.lower("source")).alias("base"), F.when(F.col("source") == "F", 500).otherwise(200).alias("page_size"))
    return records.configured(rows, config)
