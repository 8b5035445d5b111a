"""Venues: rules, cascades, token similarity and ordered subsets over part names and text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields as X
from ..functions import text as T
from ..operators import joins as J
from ..operators import tables as S
from .registry import query, table

#: label, area, any of these, none of those.
RULES = (
    ("RW", "warm", ["^red widget"], []),
    ("RED", "warm", ["^red"], ["bolt$", "gear$"]),
    ("SM", "size", ["^small", "^large"], ["widget"]),
    ("BOLT", "shape", ["bolt"], ["^blue"]),
)


@query("""
SELECT p_name, CASE WHEN regexp_matches(p_name, '^red widget') THEN 'RW' WHEN regexp_matches(p_name, '^red') AND NOT regexp_matches(p_name, 'bolt$|gear$') THEN 'RED'
  WHEN regexp_matches(p_name, '^small|^large') AND NOT regexp_matches(p_name, 'widget') THEN 'SM' WHEN regexp_matches(p_name, 'bolt') AND NOT regexp_matches(p_name, '^blue') THEN 'BOLT' END AS label,
  count(*)::BIGINT AS n FROM part GROUP BY 1, 2
""")
def rule_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules in order on distinct names, joined back to all parts."""
    parts = table(spark, sf_dir, "part").select("p_name")
    tagged = J.apply_on_distinct(parts, "p_name", lambda names: names.withColumn("tag", J.first_rule(F.col("p_name"), RULES)))
    return tagged.groupBy("p_name", F.col("tag.label").alias("label")).agg(F.count("*").alias("n"))


@query("""
WITH n AS (SELECT DISTINCT p_name FROM part)
SELECT p_name, CASE WHEN regexp_matches(p_name, '^red') THEN 'color:red' WHEN regexp_matches(p_name, 'ring$') THEN 'shape:ring' WHEN length(p_name) <= 10 THEN 'short' END AS match,
       CASE WHEN regexp_matches(p_name, '^red') THEN 0 WHEN regexp_matches(p_name, 'ring$') THEN 1 WHEN length(p_name) <= 10 THEN 2 END::INT AS step
FROM n WHERE regexp_matches(p_name, '^red') OR regexp_matches(p_name, 'ring$') OR length(p_name) <= 10
""")
def cascade_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three matchers; each sees what those before it left."""
    by = lambda cond, label: lambda df: df.where(cond).withColumn("match", F.lit(label))
    return J.cascade(table(spark, sf_dir, "part"), "p_name", [by(F.col("p_name").rlike("^red"), "color:red"), by(F.col("p_name").rlike("ring$"), "shape:ring"), by(F.length("p_name") <= 10, "short")])


LINES = r"""
WITH ql AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
tl AS (SELECT item_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM benchmark),
q AS (SELECT doc_id * 100000 + n - 1 AS qid, list_distinct(list_filter(regexp_split_to_array(lower(line), '[^a-z]+'), lambda w: length(w) > 1)) AS tokens FROM ql),
t AS (SELECT item_id * 100000 + n - 1 AS tid, list_distinct(list_filter(regexp_split_to_array(lower(line), '[^a-z]+'), lambda w: length(w) > 1)) AS tokens FROM tl)
"""


@query(LINES + """
, qq AS (SELECT qid, len(tokens) AS nq, unnest(tokens) AS w FROM q WHERE len(tokens) >= 2), tt AS (SELECT tid, len(tokens) AS nt, unnest(tokens) AS w FROM t WHERE len(tokens) >= 2),
p AS (SELECT qid, tid, any_value(nq) AS nq, any_value(nt) AS nt, count(*) AS inter FROM qq JOIN tt USING (w) GROUP BY 1, 2),
s AS (SELECT *, nq + nt - inter AS u FROM p WHERE inter * 2 >= nt AND inter * 10 >= (nq + nt - inter) * 3),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY inter / nt DESC, inter / u DESC, tid) AS r FROM s)
SELECT qid::BIGINT AS qid, tid::BIGINT AS tid, inter / nt AS recall, inter / u AS jaccard FROM r WHERE r = 1
""")
def token_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark line nearest to each line of each document, at thresholds that find some. Lines have numbers: 100,000 times the text's, from 0."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z]+"), lambda w: F.length(w) > 1))
    lines = lambda df, key, name: df.select(F.col(key).alias("k"), F.posexplode(F.split("text", "\n")).alias("n", "line")).select((F.col("k") * 100_000 + F.col("n")).alias(name), words(F.col("line")).alias("tokens"))
    return J.token_similarity(lines(table(spark, sf_dir, "documents"), "doc_id", "qid"), lines(table(spark, sf_dir, "benchmark"), "item_id", "tid"), (1, 2), (3, 10))


@query("""
WITH n AS (SELECT min(p_partkey) AS qid, string_split(lower(p_type || ' journal ' || p_name), ' ') AS t FROM part GROUP BY p_type, p_name), m AS (SELECT min(p_partkey) AS tid, string_split('journal ' || p_name, ' ') AS t FROM part GROUP BY p_name),
h AS (SELECT qid, tid, len(m.t) AS k FROM n JOIN m ON len(m.t) >= 3 AND len(n.t) - len(m.t) BETWEEN 0 AND 1 AND list_has_all(n.t, m.t) AND list_filter(n.t, lambda x: list_contains(m.t, x)) = m.t)
SELECT qid::BIGINT AS qid, arg_min(tid, (-k, tid))::BIGINT AS tid, max(k)::INT AS n FROM h GROUP BY 1
""")
def ordered_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Journals named by type and part, matched with journals named by part; each goes by the key of its first part."""
    parts = table(spark, sf_dir, "part")
    keyed = lambda c, n: parts.groupBy(c.alias("name")).agg(F.min("p_partkey").alias(n)).select(n, T.journal_tokens(T.journal_key(F.col("name"))).alias("tokens"))
    return J.ordered_subset(keyed(F.concat("p_type", F.lit(" journal of "), "p_name"), "qid"), keyed(F.concat(F.lit("journal "), "p_name"), "tid"))


AREAS = {"red": ["color", "warm"], "blue": ["color", "cold"], "green": ["color"], "small": ["size"], "large": ["size"], "ring": ["round"], "gear": ["round", "machine"], "bolt": ["machine"]}


@query("""
WITH n AS (SELECT DISTINCT p_name FROM part), m AS (SELECT MAP {'red': ['color', 'warm'], 'blue': ['color', 'cold'], 'green': ['color'], 'small': ['size'], 'large': ['size'], 'ring': ['round'], 'gear': ['round', 'machine'], 'bolt': ['machine']} AS areas),
w AS (SELECT p_name, unnest(string_split(p_name, ' ')) AS word, generate_subscripts(string_split(p_name, ' '), 1) AS i FROM n),
l AS (SELECT p_name, i, unnest(areas[word]) AS label, generate_subscripts(areas[word], 1) AS j FROM w, m),
f AS (SELECT p_name, label, min(i * 100 + j) AS p FROM l GROUP BY 1, 2)
SELECT n.p_name, coalesce(string_agg(label, ', ' ORDER BY p), '') AS labels FROM n LEFT JOIN f ON n.p_name = f.p_name GROUP BY 1
""")
def multi_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the words of a name, each once, in order."""
    areas = F.create_map(*[x for k, v in AREAS.items() for x in (F.lit(k), F.array(*[F.lit(a) for a in v]))])
    return table(spark, sf_dir, "part").select("p_name").distinct().select("p_name", F.array_join(J.map_items(F.split("p_name", " "), areas), ", ").alias("labels"))


@query("""
SELECT p_type, count(*)::BIGINT AS n, CASE WHEN p_type = 'ECONOMY' THEN 'workshop' WHEN p_type IN ('LARGE', 'SMALL') THEN 'conference' WHEN p_type = 'STANDARD' THEN 'journal' WHEN p_type = 'PROMO' THEN 'preprint' ELSE 'other' END AS kind,
  CASE WHEN p_type IN ('LARGE', 'SMALL') THEN 'A' WHEN p_type = 'STANDARD' THEN 'Q1' END AS rank FROM part GROUP BY 1
""")
def pub_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds and ranks of publications whose venue fields stand for part types."""
    t = F.col("p_type")
    p = table(spark, sf_dir, "part").select(
        "p_type", F.when(t == "ECONOMY", "Workshop on Bolts").otherwise("Bolts").alias("venue"), F.when(t == "LARGE", "conference").when(t == "PROMO", "repository").otherwise("").alias("vt"),
        F.when(t.isin("LARGE", "SMALL", "ECONOMY"), "A").alias("core"), F.when(t == "STANDARD", "Q1").when(t == "MEDIUM", "-").alias("q"),
    )
    kind = X.publication_type(F.col("venue"), F.col("vt"), F.lit(""), F.col("core"), F.col("q"))
    p = p.withColumn("kind", kind)
    return p.groupBy("p_type", "kind", X.ranking(F.col("kind"), F.col("core"), F.col("q"))["value"].alias("rank")).agg(F.count("*").alias("n"))


@query("""
WITH s AS (SELECT s_nationkey AS k, list(DISTINCT s_suppkey % 7) AS a FROM supplier GROUP BY 1), c AS (SELECT c_nationkey AS k, list(DISTINCT c_custkey % 9) AS b FROM customer GROUP BY 1)
SELECT k, CASE WHEN i = len(a) AND i = len(b) THEN 'equal' WHEN i = len(a) THEN 'subset' WHEN i = len(b) THEN 'superset' WHEN i > 0 THEN 'overlap' ELSE 'disjoint' END AS relation
FROM (SELECT s.k, a, b, len(list_intersect(a, b)) AS i FROM s JOIN c ON s.k = c.k)
""")
def set_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.collect_set(F.col("s_suppkey") % 7).alias("a"))
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.collect_set(F.col("c_custkey") % 9).alias("b"))
    return s.join(c, "k").select("k", S.set_relation(F.col("a"), F.col("b")).alias("relation"))


@query("""
WITH b AS (SELECT 0 AS lo, 1000 AS hi, 'low' AS col UNION ALL SELECT 1000, 5000, 'mid' UNION ALL SELECT 5000, 100000, 'high')
SELECT col, count(*)::BIGINT AS n FROM customer JOIN b ON c_acctbal >= lo AND c_acctbal < hi GROUP BY 1
""")
def range_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances assigned to ranges."""
    bounds = spark.createDataFrame([(0, 1000, "low"), (1000, 5000, "mid"), (5000, 100000, "high")], "lo int, hi int, col string")
    return J.in_range(table(spark, sf_dir, "customer"), bounds, "c_acctbal", "lo", "hi").groupBy("col").agg(F.count("*").alias("n"))
