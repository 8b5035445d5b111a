"""Offerings: what a nation's customers order, by academic year and term of the order date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields as X
from ..operators import aggregates as A
from ..operators import ordered as O
from ..operators import reshape as R
from ..operators import tables as S
from .registry import query, table


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """group (nation), code (part type and brand), name, year, term, person, pos of every line of an order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("grp"))
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(parts, lines.l_partkey == parts.p_partkey).join(customers, orders.o_custkey == customers.c_custkey)
    start = X.academic_start(F.col("o_orderdate"))
    return joined.select(
        "grp", F.concat(F.substring("p_type", 1, 4), F.lit(" "), F.regexp_extract("p_brand", r"(\d+)", 1)).alias("code"), F.col("p_name").alias("name"),
        start.alias("start"), X.academic_year(start).alias("year"), X.term_of_month(F.col("o_orderdate")).alias("term"), F.col("l_suppkey").alias("person"),
        ((F.col("o_orderkey") * 10 + F.col("l_linenumber")) * 100_000 + F.col("l_partkey")).alias("pos"),
    )


OBSERVATIONS = """
WITH j AS (
  SELECT c_nationkey AS grp, left(p_type, 4) || ' ' || regexp_extract(p_brand, '([0-9]+)', 1) AS code, p_name AS name,
         CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS start, month(o_orderdate) AS m,
         l_suppkey AS person, (o_orderkey * 10 + l_linenumber) * 100000 + l_partkey AS pos
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey),
o AS (
  SELECT *, start::VARCHAR || '-' || lpad(((start + 1) % 100)::VARCHAR, 2, '0') AS year,
         CASE WHEN m BETWEEN 8 AND 12 THEN 'F' WHEN m = 1 THEN 'W' WHEN m BETWEEN 2 AND 5 THEN 'S' ELSE 'Su' END AS term,
         CASE WHEN m BETWEEN 8 AND 12 THEN 0 WHEN m = 1 THEN 1 WHEN m BETWEEN 2 AND 5 THEN 2 ELSE 3 END AS rank FROM j)
"""


@query(OBSERVATIONS + """
, axis AS (SELECT DISTINCT grp, year, term, rank FROM o WHERE term IN ('F', 'W', 'S')),
items AS (SELECT DISTINCT grp, code FROM o WHERE term IN ('F', 'W', 'S')),
seen AS (SELECT DISTINCT grp, code, year, term FROM o)
SELECT i.grp, i.code, a.year, a.term, term_label AS label, (s.code IS NOT NULL) AS offered FROM (
  SELECT *, term || CASE WHEN term = 'F' THEN substr(year, 3, 2) ELSE substr(year, 6, 2) END AS term_label FROM axis) a
JOIN items i ON i.grp = a.grp LEFT JOIN seen s ON s.grp = i.grp AND s.code = i.code AND s.year = a.year AND s.term = a.term
""")  # fmt: skip
def offerings_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item by period matrix of every group, a row for each cell."""
    # The small distinct table is computed once; axis and cells both come from it.
    o = S.staged(observations(spark, sf_dir).where(F.col("term").isin("F", "W", "S")).select("grp", "code", "year", "term").distinct(), "offered")
    period = F.struct(F.col("year"), X.term_rank(F.col("term")).alias("rank"), F.col("term"))
    matrix = R.offering_matrix(o, "grp", "code", period)
    cells = matrix.select("grp", "code", F.explode(F.arrays_zip("axis", "cells")).alias("z"))
    return cells.select("grp", "code", "z.axis.year", "z.axis.term", X.term_label(F.col("z.axis.year"), F.col("z.axis.term")).alias("label"), F.col("z.cells.on").alias("offered"))


@query(OBSERVATIONS + """
, seen AS (SELECT DISTINCT grp, code, year, rank FROM o WHERE term IN ('F', 'W', 'S')),
axis AS (SELECT grp, list(DISTINCT year || ':' || rank) AS terms FROM seen GROUP BY grp),
best AS (SELECT grp, code, arg_max(name, (start, rank, -pos)) AS latest_name FROM o WHERE term IN ('F', 'W', 'S') GROUP BY 1, 2)
SELECT s.grp, s.code, any_value(len(a.terms))::INT AS width, count(*)::BIGINT AS offered, any_value(b.latest_name) AS latest_name
FROM seen s JOIN axis a ON s.grp = a.grp JOIN best b ON b.grp = s.grp AND b.code = s.code GROUP BY 1, 2
""")  # fmt: skip
def offerings_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Width and filled cells of each item's row, and the item's latest name."""
    o = observations(spark, sf_dir).where(F.col("term").isin("F", "W", "S")).withColumn("rank", X.term_rank(F.col("term")))
    period = F.struct("year", "rank")
    # One pass over the observations: each period of an item, and its latest name in that period.
    seen = S.staged(o.groupBy("grp", "code", "year", "start", "rank").agg(F.min_by("name", "pos").alias("name"), F.min("pos").alias("pos")), "offered")
    matrix = R.offering_matrix(seen, "grp", "code", period)
    names = A.latest(seen.withColumn("item", F.struct("grp", "code")), "item", "name", [F.col("start"), F.col("rank")], "pos").select("item.grp", "item.code", F.col("name").alias("latest_name"))
    return matrix.select("grp", "code", F.size("axis").alias("width"), F.size(F.filter("cells", lambda c: c["on"])).cast("long").alias("offered")).join(names, ["grp", "code"])


@query(OBSERVATIONS + """
, cut AS (SELECT max(start) - 3 AS c FROM o),
stats AS (SELECT grp, code, count(DISTINCT (start, term)) AS periods, max(start) AS last FROM o GROUP BY 1, 2)
SELECT s.grp, s.code, s.periods::BIGINT AS periods, s.last::INT AS last FROM stats s, cut WHERE NOT (s.periods = 1 AND s.last < c)
  AND NOT EXISTS (SELECT 1 FROM stats b WHERE b.grp = s.grp AND b.code || 'L' = s.code)
""")  # fmt: skip
def recent_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items without those offered in one period long ago, and without labs of other items."""
    o = S.staged(observations(spark, sf_dir).select("grp", "code", "start", "term").distinct(), "offered")
    cutoff = o.agg(F.max("start") - 3).scalar()
    return A.prune_singletons(o, "grp", "code", "start", cutoff, "term").groupBy("grp", "code").agg(F.count("*").alias("periods"), F.max("start").alias("last"))


@query(OBSERVATIONS + """
, axis AS (SELECT DISTINCT grp, year, term FROM o), items AS (SELECT DISTINCT grp, code FROM o), who AS (SELECT grp, code, year, term, list_sort(list(DISTINCT person)) AS people FROM o GROUP BY 1, 2, 3, 4)
SELECT i.grp, i.code, a.year, a.term, array_to_string(people, ',') AS people FROM items i JOIN axis a USING (grp) LEFT JOIN who w ON w.grp = i.grp AND w.code = i.code AND w.year = a.year AND w.term = a.term
""")  # fmt: skip
def people_per_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The people of every item in each period of the group's axis; null where it isn't offered."""
    o = observations(spark, sf_dir).select("grp", "code", "year", "term", "person").distinct()
    cells = R.people_cells(o, "grp", "code", F.struct("year", "term"), "person")
    zipped = cells.join(R.axis(o, "grp", F.struct("year", "term")), "grp").select("grp", "code", F.explode(F.arrays_zip("axis", "people")).alias("z"))
    return zipped.select("grp", "code", "z.axis.year", "z.axis.term", F.array_join(F.col("z.people").cast("array<string>"), ",").alias("people"))


@query(OBSERVATIONS + """
, p AS (SELECT grp, year, dense_rank() OVER (PARTITION BY grp ORDER BY year DESC) AS r FROM (SELECT DISTINCT grp, year FROM o))
SELECT o.grp, o.year, count(*)::BIGINT AS n FROM o JOIN p ON o.grp = p.grp AND o.year = p.year AND r <= 4 GROUP BY 1, 2
""")  # fmt: skip
def latest_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.latest_periods(observations(spark, sf_dir), "grp", "year", 4).groupBy("grp", "year").agg(F.count("*").alias("n"))


@query("SELECT count(*)::BIGINT AS n, min(year(o_orderdate))::INT AS first, max(year(o_orderdate))::INT AS last FROM orders, (SELECT max(year(o_orderdate)) AS top FROM orders) WHERE year(o_orderdate) BETWEEN top - 3 AND top")
def default_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the last years before the latest."""
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"))
    return O.default_range(o, "y", 1990, 3).agg(F.count("*").alias("n"), F.min("y").alias("first"), F.max("y").alias("last"))


@query("""
WITH y AS (SELECT o_custkey, year(o_orderdate) AS y, o_orderpriority AS item FROM orders), t AS (SELECT o_custkey, max(y) AS top FROM y GROUP BY 1)
SELECT y.o_custkey, count(DISTINCT item)::BIGINT AS n FROM y JOIN t ON y.o_custkey = t.o_custkey AND y = top GROUP BY 1
""")
def active_in_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("item"))
    return O.active_in_latest(o, "o_custkey", "y", "item")


SLOTS = """
WITH s AS (SELECT user_id, event_type, event_id AS pos, substr('MTWRFSU', isodow(ts)::INT, 1) AS day, lpad(hour(ts)::VARCHAR, 2, '0') || ':00-' || lpad(hour(ts)::VARCHAR, 2, '0') || ':50' AS time, event_type AS place FROM events)
"""


@query(SLOTS + """
, d AS (SELECT user_id, time, place, min(pos) AS p, list(DISTINCT day) AS days FROM s GROUP BY 1, 2, 3),
t AS (SELECT user_id, p, array_to_string(list_filter(['M','T','W','R','F','S','U'], lambda x: list_contains(days, x)), '') || ' ' || time || ' (' || place || ')' AS text FROM d)
SELECT user_id, string_agg(text, '; ' ORDER BY p, text) AS meetings FROM t GROUP BY 1
""")
def meeting_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of a user (day and hour of events) merged by time and place."""
    day = F.substring(F.lit("MTWRFSU"), F.weekday("ts") + 1, F.lit(1))
    hour = F.date_format("ts", "HH")
    e = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("pos"), day.alias("days"), F.concat(hour, F.lit(":00-"), hour, F.lit(":50")).alias("time"), F.col("event_type").alias("location"))
    return A.merge_meetings(e, ["user_id"], "pos")


@query("""
SELECT event_id, strftime(ts, '%H:%M') AS clock,
       ((hour(ts) + 11) % 12 + 1)::VARCHAR || ':' || lpad(minute(ts)::VARCHAR, 2, '0') || CASE WHEN hour(ts) >= 12 THEN 'pm' ELSE 'am' END AS twelve,
       strftime(ts, '%H:%M') AS back, hour(ts)::VARCHAR || ':' || lpad(minute(ts)::VARCHAR, 2, '0') AS of_seconds FROM events
""")
def time_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clock times through military form to 12 hours and back."""
    e = table(spark, sf_dir, "events").select("event_id", X.time_of_day(F.col("ts")).alias("clock"), F.date_format("ts", "HHmm").alias("military"), (F.hour("ts") * 3600 + F.minute("ts") * 60).alias("s"))
    e = e.withColumn("twelve", X.military_to_12h(F.col("military")))
    return e.select("event_id", "clock", "twelve", X.to_24h(F.col("twelve")).alias("back"), X.seconds_clock(F.col("s")).alias("of_seconds"))


@query("""
SELECT user_id, array_to_string(list_filter(['M','T','W','R','F','S','U'], lambda x: list_contains(d, x)), '') AS days FROM (
  SELECT user_id, list(DISTINCT substr('MTWRFSU', isodow(ts)::INT, 1)) AS d FROM events WHERE event_type = 'error' GROUP BY 1)
""")
def days_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the week on which a user has errors, from a flag for each day."""
    e = table(spark, sf_dir, "events").where("event_type = 'error'").groupBy("user_id").agg(*[F.bool_or(F.weekday("ts") == i).alias(f"d{i}") for i in range(7)])
    return e.select("user_id", X.days_from_flags([F.col(f"d{i}") for i in range(7)]).alias("days"))


@query("""
WITH b AS (SELECT DISTINCT p_brand, lower(regexp_extract(p_brand, '^([^0-9]+)', 1)) || lpad(regexp_extract(p_brand, '([0-9]+)$', 1), 12, '0') AS key FROM part)
SELECT p_brand, key, (row_number() OVER (ORDER BY key) - 1)::BIGINT AS place FROM b
""")
def natural_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands with a text that sorts as their natural order does, Brand#2 before Brand#10, and their places in it."""
    parts = F.transform(X.natural_key(F.col("p_brand")), lambda p: F.when(p["digits"], F.lpad(p["n"].cast("string"), 12, "0")).otherwise(p["text"]))
    brands = table(spark, sf_dir, "part").select("p_brand").distinct().select("p_brand", F.array_join(parts, "").alias("key"), X.natural_key(F.col("p_brand")).alias("natural"))
    return O.numbered(brands, ["natural"]).drop("natural")
