"""Names, titles and people: customers and suppliers stand for people, nations for institutions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields as X
from ..functions import text as T
from ..operators import joins as J
from .registry import query, table

#: Given names and surnames that keys choose from.
GIVEN = ("Ada", "Bruno", "Chloe", "Dario", "Elena", "Farid", "Greta")
FAMILY = ("Abel", "Berg", "Costa", "Dietz", "Evans", "Fabre", "Gomez", "Haas", "Ivers", "Jansen", "Kessler")


def named(df: DataFrame, key: str, group: str) -> DataFrame:
    """id, grp, first, last: invented names chosen by the key."""
    pick = lambda words, n: F.element_at(F.array(*[F.lit(w) for w in words]), (F.col(key) * n % len(words) + 1).cast("int"))
    return df.select(F.col(key).alias("id"), F.col(group).alias("grp"), pick(GIVEN, 3).alias("first"), pick(FAMILY, 5).alias("last"))


def _pick(words: tuple[str, ...], key: str, n: int) -> str:
    return f"[{', '.join(repr(w) for w in words)}][({key} * {n} % {len(words)} + 1)::INT]"


SUPPLIERS = f"s AS (SELECT s_suppkey AS id, s_nationkey AS grp, {_pick(GIVEN, 's_suppkey', 3)} AS first, {_pick(FAMILY, 's_suppkey', 5)} AS last FROM supplier)"
CUSTOMERS = f"c AS (SELECT c_custkey AS id, c_nationkey AS grp, {_pick(GIVEN, 'c_custkey', 3)} AS first, {_pick(FAMILY, 'c_custkey', 5)} AS last FROM customer)"


@query(f"""
WITH {SUPPLIERS}, {CUSTOMERS},
m AS (SELECT id, grp, CASE WHEN id % 3 = 0 THEN left(lower(first), 1) ELSE lower(first) END AS first, lower(last) AS last FROM c),
p AS (SELECT m.id, s.id AS person, CASE WHEN m.first = lower(s.first) THEN 2 WHEN length(m.first) = 1 AND left(s.first, 1) = upper(m.first) THEN 1 ELSE 0 END AS score
      FROM m JOIN s ON m.grp = s.grp AND m.last = lower(s.last)),
t AS (SELECT *, max(score) OVER (PARTITION BY id) AS top, count(*) OVER (PARTITION BY id) AS n FROM p),
w AS (SELECT *, count(*) OVER (PARTITION BY id) AS equal FROM t WHERE score = top)
SELECT id, person FROM w WHERE equal = 1 AND (top > 0 OR n = 1)
""")
def scored_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, some written with an initial, resolved to suppliers of their nation by scored names."""
    s = named(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey")
    people = s.select(F.col("id").alias("person"), "grp", T.fold(F.col("first")).alias("first"), T.fold(F.col("last")).alias("last"))
    c = named(table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey")
    written = F.when(F.col("id") % 3 == 0, F.concat(F.substring("first", 1, 1), F.lit(". "), F.col("last"))).otherwise(F.concat_ws(", ", "last", "first"))
    parsed = c.select("id", "grp", T.parse_person(written).alias("p")).select("id", "grp", "p.first", "p.last")
    return J.scored_match(parsed, people, "grp")


@query(f"""
WITH {SUPPLIERS},
k AS (SELECT grp, lower(last) AS last, lower(left(first, 1)) AS initial, arg_max(id, id) AS person FROM s GROUP BY 1, 2, 3), {CUSTOMERS}
SELECT c.id, k.person FROM c JOIN k ON c.grp = k.grp AND lower(c.last) = k.last AND lower(left(c.first, 1)) = k.initial
""")
def blocked_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers joined with suppliers of their nation on surname and initial; the last listed of equal keys counts."""
    keyed = lambda df: df.withColumn("key", T.name_key(F.concat_ws(" ", "first", "last"))).select("id", "grp", "key.last", "key.initial")
    s = keyed(named(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey")).withColumn("person", F.col("id"))
    c = keyed(named(table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey"))
    return J.blocked_match(c, s.withColumnRenamed("id", "pos"), ["grp", "last", "initial"], "pos", "person").select("id", "person")


@query(f"""
WITH {SUPPLIERS}
SELECT id, first || ' ' || last || '|' || last || ', ' || left(first, 1) AS parsed, 2::BIGINT AS n,
       upper(left(first, 1) || left(last, 1)) AS label FROM s
""")
def people_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of two people and a placeholder, split by their separators."""
    s = named(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey")
    full, flipped = F.concat_ws(" ", "first", "last"), F.concat(F.col("last"), F.lit(", "), F.substring("first", 1, 1))
    split = T.split_people(F.concat(full, F.lit("; Staff; "), flipped, F.lit(" ")))
    return s.select("id", F.array_join(split, "|").alias("parsed"), F.size(split).cast("long").alias("n"), T.initials(full).alias("label"))


@query("""
SELECT c_custkey, lower(trim(regexp_replace(c_name, '[^A-Za-z]+', '-', 'g'), '-')) || '-' || regexp_extract(c_name, '([0-9]+)', 1) AS slug,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'tenured' WHEN 'MACHINERY' THEN 'visiting' WHEN 'HOUSEHOLD' THEN 'teaching' WHEN 'AUTOMOBILE' THEN 'adjunct' ELSE 'tenure_track' END AS category
FROM customer
""")
def categorise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs of names, and categories of a title that stands for the market segment."""
    titles = {"BUILDING": "Professor of Computing", "MACHINERY": "Visiting Assistant Professor", "HOUSEHOLD": "Professor of Practice", "AUTOMOBILE": "Adjunct Lecturer"}
    title = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in titles.items() for x in p]), F.col("c_mktsegment")), F.lit("Assistant Professor"))
    return table(spark, sf_dir, "customer").select("c_custkey", T.slug(F.col("c_name")).alias("slug"), T.title_category(title).alias("category"))


@query("""
WITH p AS (SELECT c_custkey, s_suppkey, regexp_extract(c_name, '([0-9]+)', 1)::BIGINT::VARCHAR AS a, regexp_extract(s_name, '([0-9]+)', 1)::BIGINT::VARCHAR AS b, c_nationkey::VARCHAR AS x, s_nationkey::VARCHAR AS y
           FROM (SELECT DISTINCT o_custkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey) JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey),
q AS (SELECT *, regexp_matches(b, array_to_string(regexp_extract_all(a, '.'), '.*')) OR regexp_matches(a, array_to_string(regexp_extract_all(b, '.'), '.*')) AS name_ok,
             regexp_matches(y, array_to_string(regexp_extract_all(x, '.'), '.*')) OR regexp_matches(x, array_to_string(regexp_extract_all(y, '.'), '.*')) AS college_ok FROM p)
SELECT CASE WHEN name_ok AND college_ok THEN 'matched' WHEN name_ok THEN 'matched_name' WHEN college_ok THEN 'matched_college' ELSE 'no_match' END AS level, count(*)::BIGINT AS n FROM q GROUP BY 1
""")
def match_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the customers and suppliers of orders agree, by letters in order."""
    digits = lambda c: F.regexp_extract(c, r"(\d+)", 1).cast("long").cast("string")
    pairs = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("c"), F.col("l_suppkey").alias("s")).distinct()
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("c"), digits("c_name").alias("a"), F.col("c_nationkey").cast("string").alias("x"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s"), digits("s_name").alias("b"), F.col("s_nationkey").cast("string").alias("y"))
    return pairs.join(c, "c").join(s, "s").groupBy(X.match_level(F.col("a"), F.col("b"), F.col("x"), F.col("y")).alias("level")).agg(F.count("*").alias("n"))


@query("""
SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN s_acctbal WHEN s_suppkey % 2 = 0 THEN round(avg_bal, 2) END AS metric
FROM supplier LEFT JOIN (SELECT c_nationkey, avg(c_acctbal) AS avg_bal FROM customer GROUP BY 1) ON s_nationkey = c_nationkey
""")
def trust_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The own figure of trusted rows, the fallback source's for rows that have one, else null."""
    other = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("s_nationkey")).agg(F.avg("c_acctbal").alias("avg_bal"))
    s = table(spark, sf_dir, "supplier").join(other, "s_nationkey", "left")
    return s.select("s_suppkey", X.trusted_or(F.col("s_acctbal") > 5000, F.col("s_acctbal"), F.col("s_suppkey") % 2 == 0, F.round("avg_bal", 2)).alias("metric"))
