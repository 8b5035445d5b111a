"""Facets, group scopes, roll-ups and search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields as X
from ..functions import text as T
from ..operators import aggregates as A
from ..operators import filters as P
from ..operators import tables as S
from .registry import query, table


@query("SELECT o_orderpriority AS tag, count(*)::BIGINT AS members, count(DISTINCT c_nationkey)::BIGINT AS groups FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each priority by order and by nation."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return A.facet_counts(o.withColumn("tags", F.array("o_orderpriority")), "tags", "c_nationkey")


@query("""
SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT c_nationkey FROM customer GROUP BY 1 HAVING bool_or(c_acctbal > 9000) AND NOT bool_or(c_acctbal < -990))
""")
def group_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of nations that have a rich one and no poor one."""
    return P.groups_with(table(spark, sf_dir, "customer"), "c_nationkey", F.col("c_acctbal") > 9000, F.col("c_acctbal") < -990).select("c_custkey", "c_nationkey")


@query("""
SELECT n_nationkey, count(*) FILTER (WHERE c_mktsegment = 'BUILDING')::BIGINT AS members, coalesce(sum(orders) FILTER (WHERE c_mktsegment = 'BUILDING'), 0)::BIGINT AS orders
FROM nation JOIN customer ON n_nationkey = c_nationkey LEFT JOIN (SELECT o_custkey, count(*) AS orders FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 1999 GROUP BY 1) ON c_custkey = o_custkey
GROUP BY 1 HAVING count(*) FILTER (WHERE c_mktsegment = 'BUILDING') > 0
""")
def filtered_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members and orders of each nation under the current filters; empty nations go."""
    c = table(spark, sf_dir, "customer").where(P.tagged(F.array("c_mktsegment"), include=["BUILDING"], exclude=["MACHINERY"]))
    o = table(spark, sf_dir, "orders").where(F.year("o_orderdate").between(1997, 1999)).groupBy("o_custkey").agg(F.count("*").alias("orders"))
    return c.join(o, c.c_custkey == o.o_custkey, "left").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("members"), F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"))


@query("SELECT (count(DISTINCT nullif(k, '')) + count(*) FILTER (WHERE k = ''))::BIGINT AS n FROM (SELECT CASE WHEN p_size % 10 = 0 THEN '' ELSE p_name END AS k FROM part)")
def distinct_across(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct titles over all groups; each blank title counts."""
    p = table(spark, sf_dir, "part").select(F.when(F.col("p_size") % 10 == 0, "").otherwise(F.col("p_name")).alias("name"))
    return A.distinct_keys(p, T.title_key(F.col("name")))


@query("""
WITH p AS (SELECT p_partkey AS id, 'name' AS path FROM part WHERE contains(lower(p_name), 'red') AND contains(lower(p_name), 'ring')
  UNION ALL SELECT p_partkey, 'type' FROM part WHERE contains(lower(p_type || ' ' || p_brand), 'economy') AND contains(lower(p_type || ' ' || p_brand), '#1')
  UNION ALL SELECT DISTINCT l_partkey, 'people' FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE contains(lower(s_name || ' ' || n_name), 'nation_7') AND contains(lower(s_name || ' ' || n_name), '1'))
SELECT id, list_sort(list(DISTINCT path)) AS paths FROM p GROUP BY 1
""")
def search_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts found by their name, their type or the people who supply them."""
    parts = table(spark, sf_dir, "part")
    hits = lambda df, text, words, path, key: df.where(P.contains_all(text, words)).select(F.col(key).alias("id"), F.lit(path).alias("path"))
    people = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    people = people.where(P.contains_all(X.search_text("s_name", "n_name"), ["nation_7", "1"])).select("s_suppkey")
    supplied = table(spark, sf_dir, "lineitem").join(people, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi").select(F.col("l_partkey").alias("id"), F.lit("people").alias("path")).distinct()
    return S.search_paths(hits(parts, X.search_text("p_name"), ["red", "ring"], "name", "p_partkey"), hits(parts, X.search_text("p_type", "p_brand"), ["economy", "#1"], "type", "p_partkey"), supplied)


@query("""
SELECT c_nationkey, c_custkey FROM (SELECT *, count(*) OVER (PARTITION BY c_nationkey) AS n, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') OVER (PARTITION BY c_nationkey) AS s FROM customer)
WHERE c_mktsegment = 'BUILDING' OR NOT (s >= 2 AND n >= 10 AND n > 5 * s)
""")
def strict_or_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nation's BUILDING customers alone where they are a small part of a long list."""
    return P.strict_or_all(table(spark, sf_dir, "customer"), "c_nationkey", F.col("c_mktsegment") == "BUILDING").select("c_nationkey", "c_custkey")


@query("""
WITH h AS (SELECT c_nationkey, count(DISTINCT c_mktsegment) AS k, bool_or(c_mktsegment = 'MACHINERY') AS bad FROM customer GROUP BY 1)
SELECT c_custkey FROM customer JOIN h USING (c_nationkey) WHERE NOT (k >= 2 AND bad AND c_mktsegment = 'MACHINERY')
""")
def heading_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.gate_by_heading(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment", "^MACHINERY$").select("c_custkey")


@query("""
SELECT o_orderpriority, count(*)::BIGINT AS rows, count(*) FILTER (WHERE o_orderstatus = 'F')::BIGINT AS done FROM orders GROUP BY 1
""")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of a run by priority."""
    return A.coverage(table(spark, sf_dir, "orders"), "o_orderpriority", done=F.col("o_orderstatus") == "F")
