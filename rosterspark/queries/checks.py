"""Smaller operators: marks, alignment, codes, grids and cells over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields as X
from ..functions import grammars as G
from ..functions import text as T
from ..operators import aggregates as A
from ..operators import filters as P
from ..operators import joins as J
from ..operators import ordered as O
from ..operators import reshape as R
from ..operators import tables as S
from ..sources import web
from .registry import query, table


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) > 1 AS repeated FROM orders")
def mark_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.mark_repeats(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], ["o_orderkey"]).select("o_orderkey", "repeated")


@query("SELECT o_custkey, min(o_orderkey)::BIGINT AS o_orderkey FROM orders GROUP BY 1")
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.keep_first(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""
WITH u AS (SELECT c_nationkey AS grp, c_mktsegment AS code, count(DISTINCT CASE WHEN c_custkey % 9 = 0 THEN c_custkey % 4 END) AS n FROM customer GROUP BY 1, 2), a AS (SELECT c_nationkey AS grp, count(DISTINCT CASE WHEN c_custkey % 9 = 0 THEN c_custkey % 4 END) AS every FROM customer GROUP BY 1)
SELECT a.grp, CASE WHEN max(n) >= 2 THEN 'per term' WHEN any_value(every) <= 1 THEN 'none' ELSE 'per code' END AS mode FROM u JOIN a ON a.grp = u.grp GROUP BY 1
""")
def url_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How links of a nation's segments vary."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("grp"), F.col("c_mktsegment").alias("code"), F.when(k % 9 == 0, (k % 4).cast("string")).otherwise("").alias("url"))
    return A.url_mode(c, "grp", "code", "url")


@query("""
WITH a AS (SELECT c_nationkey AS k, count(*)::BIGINT AS n_left FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*)::BIGINT AS n_right FROM supplier GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, n_left, n_right FROM a FULL JOIN b ON a.k = b.k WHERE coalesce(n_left, 0) <> coalesce(n_right, 0)
""")
def misaligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations that don't stand equally often among customers and suppliers."""
    return J.misaligned(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")), ["k"])


@query("""
WITH n AS (SELECT DISTINCT user_id AS grp, event_type AS year, (event_id % 3)::VARCHAR AS term FROM events)
SELECT grp, year, term FROM n WHERE NOT (grp % 2 = 0 AND term = '0') AND NOT (grp % 5 = 0)
""")
def uncovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that are not covered; a done key with a blank term covers all terms."""
    n = table(spark, sf_dir, "events").select(F.col("user_id").alias("grp"), F.col("event_type").alias("year"), (F.col("event_id") % 3).cast("string").alias("term")).distinct()
    done = n.where("grp % 2 = 0 and term = '0'").unionByName(n.where("grp % 5 = 0").withColumn("term", F.lit("")))
    return J.uncovered(n, done, "year", "term", "grp").select("grp", "year", "term")


@query("""
WITH s AS (SELECT p_brand, p_type, count(DISTINCT p_name) AS names, count(*) AS n FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY names DESC, n, p_type) AS r FROM s)
SELECT p_brand, p_type, names::BIGINT AS names FROM r WHERE r = 1
""")
def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each brand the type with most names and fewest parts."""
    s = table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.count_distinct("p_name").alias("names"), F.count("*").alias("n"))
    return A.best_candidate(s, "p_brand", "p_type", [F.col("names"), -F.col("n")]).select("p_brand", "p_type", "names")


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY coalesce(c_acctbal, -1) DESC, c_custkey LIMIT 20")
def top_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of a table sorted by a column."""
    return O.sort_table(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", tie="c_custkey").limit(20)


@query("""
SELECT o_orderkey, (year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END)::VARCHAR || CASE WHEN month(o_orderdate) BETWEEN 8 AND 12 THEN '01' WHEN month(o_orderdate) BETWEEN 2 AND 5 THEN '03' WHEN month(o_orderdate) = 1 THEN '02' ELSE '04' END AS code,
  CASE WHEN month(o_orderdate) BETWEEN 8 AND 12 THEN 'F' WHEN month(o_orderdate) BETWEEN 2 AND 5 THEN 'S' WHEN month(o_orderdate) = 1 THEN 'W' ELSE 'Su' END AS term
FROM orders
""")
def term_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider codes of the terms of orders."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", X.academic_year(X.academic_start(F.col("o_orderdate"))).alias("year"), X.term_of_month(F.col("o_orderdate")).alias("term"))
    return o.select("o_orderkey", X.term_code(F.col("year"), F.col("term"), F.lit("{start}0{n}")).alias("code"), "term")


@query("SELECT c_custkey, n_name AS label FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20")
def code_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = table(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    return J.labelled(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("code")), codes, "code", "label").select("c_custkey", "label")


@query("""
SELECT count(*)::BIGINT AS rows, count(*) FILTER (WHERE p_type NOT IN ('PROMO') AND p_name NOT LIKE 'red%' AND p_size > 2)::BIGINT AS kept FROM part
""")
def publication_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publications that stay, where types stand for venue types and red parts for session notes."""
    p = table(spark, sf_dir, "part")
    keep = P.is_publication(F.when(F.col("p_type") == "PROMO", "book series").otherwise("journal"), F.when(F.col("p_name").startswith("red"), "Session details: x").otherwise(F.col("p_name")), F.lit("Rings"), F.lit("X"), F.when(F.col("p_size") > 2, F.lit(2020)))
    return A.coverage(p, kept=keep)


@query("SELECT p_partkey, left(upper(p_type), 4) || ' ' || lpad(p_size::VARCHAR, 3, '0') AS code, lpad((p_partkey % 30)::VARCHAR, 2, '0') AS section FROM part")
def code_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and sections put together and split again."""
    written = F.concat(F.substring(F.upper("p_type"), 1, 4), F.lit("-"), X.pad_digits(F.col("p_size").cast("string"), 3), F.lit("-"), F.lpad((F.col("p_partkey") % 30).cast("string"), 2, "0"))
    return table(spark, sf_dir, "part").select("p_partkey", G.split_code(written).alias("s")).select("p_partkey", "s.code", "s.section")


@query("SELECT o_custkey, arg_min(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS F, arg_min(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS O FROM orders GROUP BY 1")
def columns_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and values as columns: each customer's first order by status."""
    return R.columns_of(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", "o_totalprice", ["F", "O"], "o_orderkey")


@query("SELECT s_suppkey, name AS day, value AS cell FROM (UNPIVOT (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE '' END AS Mon, s_nationkey::VARCHAR AS Tue FROM supplier) ON Mon, Tue INTO NAME name VALUE value) WHERE value <> ''")
def unpivot_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of days as a row for each filled cell."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).otherwise("").alias("Mon"), F.col("s_nationkey").cast("string").alias("Tue"))
    return R.unpivot_grid(s, ["s_suppkey"], ["Mon", "Tue"])


@query("SELECT c_nationkey AS doc, c_custkey AS pos, c_custkey::VARCHAR AS code, c_mktsegment AS segment FROM customer")
def fixed_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as fixed-width text under a ruler and read again."""
    c = table(spark, sf_dir, "customer")
    body = c.select(F.col("c_nationkey").alias("doc"), F.col("c_custkey").alias("pos"), F.concat(F.rpad(F.col("c_custkey").cast("string"), 12, " "), F.col("c_mktsegment")).alias("line"))
    ruler = c.select(F.col("c_nationkey").alias("doc")).distinct().withColumn("pos", F.lit(-1).cast("long")).withColumn("line", F.concat(F.rpad(F.lit("----------"), 12, " "), F.lit("----------")))
    return web.fixed_width(body.unionByName(ruler), "doc", "pos", "line", ["code", "segment"])


@query("""
WITH w AS (SELECT DISTINCT p_name FROM part)
SELECT p_name, 'PROCEEDINGS' AS kind, list_sort(list_distinct([CASE WHEN x LIKE '%s' AND x NOT LIKE '%ss' THEN left(x, length(x) - 1) ELSE x END FOR x IN string_split(p_name, ' ')])) AS tokens FROM w
""")
def venue_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token sets of venue titles under a proceedings prefix."""
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    venue = F.concat(F.lit("Proceedings of the 2nd ACM "), "p_name")
    return names.select("p_name", F.lit("PROCEEDINGS").alias("kind"), F.array_sort(T.title_tokens(venue, T.ORDINAL_ONLY)).alias("tokens"))


@query("""
WITH p AS (SELECT p_partkey, p_size, p_partkey % 1000 AS n, lpad((p_partkey % 1000)::VARCHAR, 3, '0') AS d, chr((65 + p_size % 20)::INT) AS x, p_partkey % 9 AS kind FROM part)
SELECT p_partkey, CASE kind WHEN 0 THEN 'CSC-' || d WHEN 1 THEN 'CSC ' || d WHEN 2 THEN 'CSC ' || d WHEN 3 THEN 'CSC ' || d || x WHEN 4 THEN 'CS ' || d WHEN 5 THEN 'CSC ' || d WHEN 6 THEN 'CSCI ' || d WHEN 7 THEN 'CPS ' || d ELSE 'CMSCH' || d END AS code,
  CASE kind WHEN 0 THEN '0' || p_size WHEN 1 THEN 'B' || p_size WHEN 2 THEN x WHEN 3 THEN p_size::VARCHAR WHEN 4 THEN '00' || (p_size % 10) WHEN 5 THEN '' WHEN 6 THEN CASE WHEN p_size % 2 = 0 THEN x ELSE '' END
    WHEN 7 THEN CASE WHEN p_size % 3 = 0 THEN 'Lab' WHEN x = 'L' THEN 'Lab' ELSE x END ELSE '00' || x END AS section FROM p
""")
def codes_by_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Course codes as nine kinds of sources write them, split by the style of each."""
    k, d, size = F.col("p_partkey"), F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"), F.col("p_size").cast("string")
    x = F.char(65 + F.col("p_size") % 20)
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    written = [
        ("dashed", text("CSC-", d, "-0", size)), ("starred", text("CSC*", d, "*B", size)), ("named", text("CSC-", d, "-", x)), ("spaced", text(" CSC ", d, x, "  ", size)), ("dotted", text("CS ", d, " .00", (F.col("p_size") % 10).cast("string"))),
        ("joined", text("CSC", d, " ")), ("dated", text("CSCI", d, F.when(F.col("p_size") % 2 == 0, x).otherwise(""), "-F25")), ("lettered", text("CPS", d, " ", F.when(F.col("p_size") % 3 == 0, "l").otherwise(x))), ("registered", text("CMSCH", d, "00", x)),
    ]
    pick = F.element_at(F.array(*[F.struct(F.lit(s).alias("style"), w.alias("written")) for s, w in written]), (k % 9 + 1).cast("int"))
    rows = table(spark, sf_dir, "part").select("p_partkey", pick.alias("p")).select("p_partkey", "p.*")
    split = G.by_style(F.col("style"), [s for s, _ in written], lambda s: G.split_code(F.col("written"), s))
    return rows.select("p_partkey", split.alias("s")).select("p_partkey", "s.code", "s.section")


@query("""
WITH o AS (SELECT o_orderkey, o_orderkey % 8 AS kind, year(o_orderdate)::INT AS y FROM orders),
s AS (SELECT *, CASE WHEN kind IN (0, 3, 6) THEN y ELSE y - 1 END AS start, ['F', 'W', 'S', 'F', 'S', 'Su', 'F', 'Su'][kind + 1] AS term FROM o)
SELECT o_orderkey, start || '-' || lpad(((start + 1) % 100)::VARCHAR, 2, '0') AS year, term, CASE term WHEN 'F' THEN start || '90' WHEN 'W' THEN (start + 1) || '10' WHEN 'S' THEN (start + 1) || '20' ELSE (start + 1) || '65' END AS code,
  start || '-' || lpad(((start + 1) % 100)::VARCHAR, 2, '0') || ' ' || term AS back FROM s
""")
def terms_by_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of order dates as eight kinds of sources write them, read by the style of each, as a provider's codes and back."""
    k, y = F.col("o_orderkey"), F.year("o_orderdate")
    s, before, two = y.cast("string"), (y - 1).cast("string"), lambda n: F.lpad((n % 100).cast("string"), 2, "0")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    written = [
        ("any", text("Fall Term ", s)), ("any", text(s, " - Interim")), ("two terms", text("Winter ", before, "-", s)), ("church", text("Advent ", s)), ("church", text("Easter Semester ", s)), ("short", text("SUM1 ", s)),
        ("any", text("term term-Fall", s)), ("any", text(before, "/", two(y), " Maymester")),
    ]
    pick = F.element_at(F.array(*[F.struct(F.lit(st).alias("style"), w.alias("written")) for st, w in written]), (k % 8 + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", pick.alias("p")).select("o_orderkey", "p.*")
    read = G.by_style(F.col("style"), sorted({st for st, _ in written}), lambda st: G.parse_term(F.col("written"), st))
    coded = G.once(read, lambda t: F.struct(t["year"].alias("year"), t["term"].alias("term"), G.term_code(t["year"], t["term"], "tens").alias("code")))
    back = lambda code: G.once(G.parse_term_code(code, "tens"), lambda t: F.concat(t["year"], F.lit(" "), t["term"]))
    return rows.select("o_orderkey", G.once(coded, lambda t: F.struct(t["year"].alias("year"), t["term"].alias("term"), t["code"].alias("code"), back(t["code"]).alias("back"))).alias("r")).select("o_orderkey", "r.*")


@query("""
WITH e AS (SELECT event_id, isodow(ts)::INT AS d, event_id % 7 AS kind FROM events)
SELECT event_id, CASE WHEN kind = 6 THEN '' WHEN kind = 5 THEN substr('MTWRFSU', d, 1) WHEN d = 1 THEN 'MW' WHEN d = 2 THEN 'TR' WHEN d = 3 THEN 'MWF' WHEN d = 4 THEN 'R' WHEN d = 5 THEN 'TF' WHEN d = 6 THEN 'SU' ELSE 'MTWRF' END AS days FROM e
""")
def day_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of events as letters, pairs, names, lists, masks and in a sentence; what names no day is blank."""
    spelled = [
        ("MW", "MoWe", "Monday, Wednesday", "M, W", ".M.W..."), ("TTh", "TuTh", "Tuesday/Thursday", "T, Th", "..T.R.."), ("MWF", "MoWeFr", "Mon Wed & Fri", "M/W/F", ".M.W.F."), ("R", "Th", "Thursdays", "Thu", "....R.."),
        ("TF", "TuFr", "tues and fri", "t; f", "..T..F."), ("SaSu", "SaSu", "Saturday-Sunday", "Sat, Sun", "S.....U"), ("MTWThF", "MoTuWeThFr", "Mon., Tue., Wed., Thurs., Fri.", "m t w r f", ".MTWRF."),
    ]
    table_ = F.array(*[F.array(*[F.lit(x) for x in some]) for some in spelled])
    d, kind = F.weekday("ts") + 1, F.col("event_id") % 7
    sentence = F.concat(F.lit("meets on "), F.date_format("ts", "EEEE"), F.lit(" at most"))
    text = F.when(kind == 6, "TBA").when(kind == 5, sentence).otherwise(F.element_at(F.element_at(table_, d), (F.least(kind, F.lit(4)) + 1).cast("int")))
    return table(spark, sf_dir, "events").select("event_id", G.by_style(F.when(kind == 4, "mask"), ["mask"], lambda s: G.days(text, s)).alias("days"))


@query("""
WITH i AS (SELECT p_brand, p_type, p_name, p_size % 4 > 0 AND p_name NOT LIKE 'cold%' AS good, p_partkey % 3 > 0 AS linked FROM part),
k AS (SELECT p_brand, p_type, count(*) AS size, count(*) FILTER (WHERE good) AS valid, count(DISTINCT p_name) FILTER (WHERE good) AS uniq, count(*) FILTER (WHERE good AND linked) AS links FROM i GROUP BY 1, 2),
s AS (SELECT *, CASE WHEN valid > 0 THEN round_even(links / valid * 10, 0)::INT ELSE 0 END AS tenths FROM k),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY uniq DESC, tenths DESC, uniq - valid DESC, valid - size DESC, size, p_type) AS r FROM s WHERE uniq > 1 OR uniq = 1 AND tenths > 0)
SELECT p_brand, p_type, uniq AS "unique", tenths, valid - uniq AS repeats, size - valid AS wasted FROM r WHERE r = 1
""")
def scored_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each brand the type that names most parts, from the parts themselves: names, links, repeats and waste."""
    p = table(spark, sf_dir, "part")
    order = p.select("p_type").distinct().select("p_type", F.col("p_type").alias("place"))
    name = F.when(~F.col("p_name").startswith("cold"), F.col("p_name"))
    items = O.numbered(order, ["place"], place="n").select("p_type", F.col("n").alias("place")).join(p, "p_type").select("p_brand", "p_type", "place", name.alias("name"), (F.col("p_size") % 4 > 0).alias("titled"), F.when(F.col("p_partkey") % 3 > 0, "u").alias("link"))
    best = A.best_scored(items, "p_brand", "p_type", "place")
    return best.select("p_brand", "p_type", "score.unique", "score.tenths", (-F.col("score.repeats")).alias("repeats"), (-F.col("score.wasted")).alias("wasted"))


@query("SELECT c_custkey, c_acctbal, (row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1)::BIGINT AS place FROM customer QUALIFY place BETWEEN 60 AND 79")
def later_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fourth page of a sorted table, without sorting it into one partition."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", (-F.col("c_acctbal")).alias("key"))
    return O.page(rows, ["key", "c_custkey"], 3).drop("key")


@query("""
WITH c AS (SELECT c_nationkey, c_custkey, c_name, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1)::BIGINT AS place, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer)
SELECT c_nationkey, c_custkey, c_name, place, ((n + 36) // 37)::BIGINT AS chunks, n::BIGINT AS rows FROM c
""")
def nested_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers nested by nation in documents of at most 37, written and read again, with the manifest that puts them together."""
    path = f"{S.shared_dir(spark)}/chunks-{uuid.uuid4().hex}"
    R.nest_chunks(table(spark, sf_dir, "customer"), "c_nationkey", "c_custkey", ["c_custkey", "c_name"], "people", 37).write.json(path)
    back = spark.read.schema("c_nationkey int, chunk long, first long, people array<struct<c_custkey:long,c_name:string>>").json(path)
    return R.unchunked(back, "c_nationkey", "people").join(R.chunk_manifest(back, "c_nationkey", "people"), "c_nationkey")
