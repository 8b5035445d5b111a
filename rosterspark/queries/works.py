"""Works: orders stand for papers, the suppliers of their lines for authors, nations for institutions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields as X
from ..functions import text as T
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import reshape as R
from .registry import query, table


@query("""
WITH a AS (SELECT DISTINCT l_orderkey AS paper, l_suppkey AS author, CASE WHEN s_suppkey % 13 = 0 THEN [] WHEN s_suppkey % 5 = 0 THEN [s_nationkey, (s_nationkey + 1) % 25] ELSE [s_nationkey] END AS insts, c_nationkey AS home
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
k AS (SELECT s_nationkey AS inst, s_suppkey AS author FROM supplier WHERE s_acctbal > 3000), p AS (SELECT list(n_nationkey) AS peers FROM nation WHERE n_regionkey < 3)
SELECT kind, count(*)::BIGINT AS n, count(DISTINCT paper)::BIGINT AS papers FROM (
  SELECT a.paper, CASE WHEN list_contains(insts, home) AND k.author IS NOT NULL THEN 'faculty' WHEN list_contains(insts, home) THEN 'student' WHEN list_has_any(insts, peers) THEN 'other' ELSE 'external' END AS kind
  FROM a LEFT JOIN k ON a.home = k.inst AND a.author = k.author, p) GROUP BY 1
""")
def coauthor_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors of an order by their nations (two, one or none) against the customer's."""
    lines, orders = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers, suppliers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), table(spark, sf_dir, "supplier")
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    insts = suppliers.select("s_suppkey", F.when(k % 13 == 0, F.array().cast("array<int>")).when(k % 5 == 0, F.array(n, (n + 1) % 25)).otherwise(F.array(n)).alias("insts"))
    authors = (
        lines.distinct().join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("o_custkey") == F.col("c_custkey")).join(insts, F.col("l_suppkey") == k)
        .select(F.col("l_orderkey").alias("paper"), F.col("l_suppkey").alias("last"), "insts", F.col("insts").cast("array<string>").alias("names"), F.col("c_nationkey").alias("home"))
    )
    roster = suppliers.where("s_acctbal > 3000").select(F.col("s_nationkey").alias("inst"), F.col("s_suppkey").alias("last"))
    peers = table(spark, sf_dir, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").cast("string").alias("name"))
    return J.coauthor_classes(authors, "home", peers, roster).groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("paper").alias("papers"))


@query("""
WITH k AS (SELECT doc_id, source, lang, trim(regexp_replace(lower(regexp_replace(coalesce(text, ''), '\\\\[nt]', ' ', 'g')), '[^a-z0-9]+', ' ', 'g')) AS key FROM documents)
SELECT arg_min(doc_id, (source, doc_id))::BIGINT AS doc_id, list_sort(list(DISTINCT lang)) AS langs, count(*)::BIGINT AS n FROM k GROUP BY CASE WHEN key <> '' THEN key ELSE 'id:' || doc_id::VARCHAR END
""")
def dedup_best_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose whole texts read alike: the one of the first source stays, languages are united."""
    # A hash of 128 bits stands for what a text reads like, so texts are neither shuffled nor compared.
    key = F.md5(X.paper_key(F.col("text"), F.col("doc_id")))
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.array("lang").alias("langs"), key.alias("key"))
    return A.dedup_best(d, F.col("key"), [F.col("source"), F.col("doc_id")], merge="langs", count="n").select("doc_id", "langs", "n")


@query("""
WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1, 2)
SELECT user_id, arg_max(event_type, (n, -f)) AS event_type, max(n)::BIGINT AS n FROM c GROUP BY 1
""")
def dominant_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.dominant(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")


@query("""
WITH w AS (SELECT l_suppkey AS person, l_quantity::INT AS cites, year(l_shipdate) AS y FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY person ORDER BY cites DESC) AS r FROM w),
q AS (SELECT *, row_number() OVER (PARTITION BY person ORDER BY cites DESC) AS r FROM w WHERE y >= 1999),
a AS (SELECT person, sum(cites)::BIGINT AS cited, count(*) FILTER (WHERE cites >= r)::BIGINT AS h, count(*) FILTER (WHERE cites >= 10)::BIGINT AS i10 FROM r GROUP BY 1),
b AS (SELECT person, sum(cites)::BIGINT AS cited_recent, count(*) FILTER (WHERE cites >= r)::BIGINT AS h_recent, count(*) FILTER (WHERE cites >= 10)::BIGINT AS i10_recent FROM q GROUP BY 1)
SELECT a.*, coalesce(cited_recent, 0) AS cited_recent, coalesce(h_recent, 0) AS h_recent, coalesce(i10_recent, 0) AS i10_recent FROM a LEFT JOIN b ON a.person = b.person
""")
def h_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citation metrics of suppliers whose lines stand for works, quantities for citations."""
    w = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("person"), F.col("l_quantity").cast("int").alias("cites"), F.year("l_shipdate").alias("y"))
    return A.citation_metrics(w, "person", "cites", "y", 1999)


@query("SELECT l_suppkey AS person, y AS year, sum(q)::BIGINT AS n FROM (SELECT l_suppkey, year(l_shipdate)::INT AS y, l_quantity::INT AS q FROM lineitem) GROUP BY 1, 2")
def cites_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("person"), F.year("l_shipdate").alias("year"), F.col("l_quantity").cast("int").alias("q"))
    return A.by_year(w, "person", "year", "q").select("person", F.explode("by_year").alias("year", "n"))


@query("""
SELECT c_nationkey AS nation, count(*)::BIGINT AS members, count(*) FILTER (WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))::BIGINT AS trusted, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 1
""")
def group_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nation")
    return A.totals(c, "nation", F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "c_acctbal").withColumn("total", F.round("total", 2))


@query("""
SELECT n_nationkey, n_name, CASE WHEN c_custkey IS NULL THEN NULL ELSE row_number() OVER (PARTITION BY n_nationkey ORDER BY c_custkey) - 1 END::INT AS place, c_custkey, c_name FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey
""")
def nested_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their customers nested in order, each member with its place."""
    nested = R.nest(table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey"), "n_nationkey", "c_custkey", ["c_custkey", "c_name"], "people")
    out = J.star(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "n_nationkey", nested)
    return out.select("n_nationkey", "n_name", F.posexplode_outer("people").alias("place", "p")).select("n_nationkey", "n_name", "place", "p.c_custkey", "p.c_name")


@query("""
WITH a AS (SELECT c_mktsegment, c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_custkey) AS n FROM customer),
b AS (SELECT c_mktsegment, c_nationkey, c_acctbal, row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_custkey) AS n FROM customer)
SELECT a.c_mktsegment, a.c_nationkey, c_custkey, c_acctbal FROM a JOIN b ON a.c_mktsegment = b.c_mktsegment AND a.c_nationkey = b.c_nationkey AND a.n = b.n
""")
def aligned_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of equal keys aligned by the order within a key."""
    c = table(spark, sf_dir, "customer")
    keys = ["c_mktsegment", "c_nationkey"]
    return J.aligned(c.select(*keys, "c_custkey"), c.select(*keys, "c_custkey", "c_acctbal"), keys, "c_custkey")


@query("""
SELECT n_nationkey, n_name, r_name, CASE WHEN n_nationkey % 4 = 0 THEN 'override-' || n_nationkey WHEN n_nationkey % 4 = 1 THEN NULL ELSE 'own-' || n_nationkey END AS url FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their region's name and a link that overrides replace."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    k = F.col("n_nationkey")
    own = n.withColumn("url", F.when(k % 4 == 1, "").otherwise(F.concat(F.lit("own-"), k)))
    overrides = n.where(k % 4 < 2).select("n_nationkey", F.when(k % 4 == 0, F.concat(F.lit("override-"), k)).otherwise("").alias("url"))
    return J.star(J.override(own, overrides, ["n_nationkey"], "url"), "n_regionkey", r).select("n_nationkey", "n_name", "r_name", "url")


@query("""
WITH b AS (SELECT p_brand, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY min(p_size), p_name) AS n FROM part GROUP BY 1, 2)
SELECT CASE WHEN n = 1 THEN p_brand ELSE p_brand || ' (' || p_name || ')' END AS key, p_name FROM b
""")
def best_entry_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest part of a brand keeps the brand as its key."""
    p = table(spark, sf_dir, "part").groupBy("p_brand", "p_name").agg(F.min("p_size").alias("size"))
    return A.best_entry_keys(p, "p_brand", "p_name", [F.col("size"), F.col("p_name")]).select("key", "p_name")


@query("""
SELECT o_custkey, o_orderpriority, min(o_orderkey)::BIGINT AS first_order, list_sort(list(DISTINCT o_orderstatus)) AS statuses FROM orders GROUP BY 1, 2
""")
def collapse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one section collapsed: first scalar, distinct values."""
    o = table(spark, sf_dir, "orders").withColumn("first_order", F.col("o_orderkey"))
    out = A.collapse_rows(o, ["o_custkey", "o_orderpriority"], "o_orderkey", ["first_order"], ["o_orderstatus"], [])
    return out.select("o_custkey", "o_orderpriority", "first_order", F.array_sort("o_orderstatus").alias("statuses"))


@query("SELECT p_name, string_agg(upper(left(w, 1)) || substr(w, 2), ' ' ORDER BY i) AS shown, any_value(slug) AS slug FROM (SELECT DISTINCT p_name, replace(p_name, ' ', '-') AS slug, unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part) GROUP BY 1")
def venue_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with words in their short forms: here every word's short form is itself with a capital."""
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    return names.select("p_name", T.shorten_words(F.initcap("p_name")).alias("shown"), T.slug(F.col("p_name")).alias("slug"))
