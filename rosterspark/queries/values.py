"""Names, titles, terms, times, lists and filters, on texts that are put together from the tables' rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields as X
from ..functions import grammars as G
from ..functions import text as T
from ..operators import aggregates as A
from ..operators import filters as P
from ..operators import joins as J
from ..operators import ordered as O
from ..operators import reshape as R
from .people import CUSTOMERS, SUPPLIERS, named
from .registry import query, table


def by_rest(key: Column, *values: Column | str) -> Column:
    """The value whose place is the key's rest by their number."""
    listed = F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values])
    return F.element_at(listed, (key % len(values) + 1).cast("int"))


@query(f"""
WITH {CUSTOMERS}
SELECT id, CASE WHEN id % 9 = 7 THEN NULL WHEN id % 9 = 8 THEN 'Department of ' || last ELSE first || ' ' || last END AS cleaned, id % 9 < 7 AS is_name FROM c
""")
def person_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of customers as pages write them, cleaned, and whether they read as names."""
    c = named(table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey")
    first, last, full = F.col("first"), F.col("last"), F.concat_ws(" ", "first", "last")
    raw = by_rest(
        F.col("id"), full, F.concat(F.lit("Dr. "), full), F.concat(last, F.lit(", "), first), F.concat(full, F.lit(" (she/her)")), F.concat(F.lit("  "), first, F.lit("   "), last, F.lit(" '12")),
        F.concat(full, F.lit(", PhD")), F.concat(last, F.lit(", "), first, F.lit(", Ph.D.")), F.lit(" x "), F.concat(F.lit("Department of "), last),
    )
    cleaned = c.select("id", T.clean_name(raw).alias("cleaned"))
    return cleaned.select("id", "cleaned", T.looks_like_name(F.col("cleaned")).alias("is_name"))


@query("""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Associate Professor' WHEN 'MACHINERY' THEN 'Visiting Assistant Professor' WHEN 'HOUSEHOLD' THEN 'Senior Lecturer'
  WHEN 'AUTOMOBILE' THEN NULL ELSE 'Lab Instructor' END AS title, c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY' AS in_subject FROM customer
""")
def titles_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Academic titles that stand for the market segment, in rank words; and whether they name the subject."""
    titles = {"BUILDING": "Associate  Professor of Computer Science", "MACHINERY": "VISITING ASSISTANT PROFESSOR OF DATA SCIENCE", "HOUSEHOLD": "Senior Lecturer", "AUTOMOBILE": "Professor Emeritus of Computing"}
    title = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in titles.items() for x in p]), F.col("c_mktsegment")), F.lit("Lab Instructor"))
    return table(spark, sf_dir, "customer").select("c_custkey", T.clean_title(title).alias("title"), T.clean_title(title, include_subject=True).isNotNull().alias("in_subject"))


@query("""
SELECT o_orderkey, o_orderstatus || ', ' || o_custkey::VARCHAR AS relisted, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END AS number,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS person, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE o_orderpriority END AS filled,
  CASE WHEN o_custkey >= 1000 THEN CASE WHEN (o_custkey / 100)::BIGINT % 10 = 0 THEN ((o_custkey / 100)::BIGINT // 10)::VARCHAR || 'k' ELSE ((o_custkey / 100)::BIGINT // 10)::VARCHAR || '.' || ((o_custkey / 100)::BIGINT % 10)::VARCHAR || 'k' END ELSE o_custkey::VARCHAR END AS compact
FROM (SELECT * REPLACE (o_custkey * 100 AS o_custkey) FROM orders)
""")
def lists_and_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited lists, numbers written as text, placeholders and blanks of orders."""
    o, k = table(spark, sf_dir, "orders").withColumn("o_custkey", F.col("o_custkey") * 100), F.col("o_orderkey")
    listed = F.concat(F.lit(" ; "), F.col("o_orderstatus"), F.lit(" ;;"), F.col("o_custkey").cast("string"), F.lit("; "))
    person = F.when(k % 3 == 0, by_rest(F.col("o_custkey"), "TBA", "Staff", "None listed.")).otherwise(F.col("o_orderpriority"))
    blanked = T.blank_if_placeholder(person)
    number = F.when(k % 4 == 0, "n/a").otherwise(F.col("o_custkey").cast("string"))
    return o.select(
        "o_orderkey", T.relist(listed, ";").alias("relisted"), T.to_int(number).alias("number"), blanked.alias("person"),
        X.gap_fill(blanked, F.col("o_orderstatus")).alias("filled"), T.compact_number(F.col("o_custkey")).alias("compact"),
    )


@query(f"""
WITH {SUPPLIERS}
SELECT id, first || ' ' || last || CASE WHEN last <> 'Berg' OR first <> 'Ada' THEN ', Ada Berg' ELSE '' END AS people, last || ' rings' AS title, first || ' ' || last AS taught,
  first || ' ' || last AS flagged, 'https://x.example/' || id::VARCHAR AS link, last || ', ' || first AS once FROM s
""")
def people_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People with roles, titles with people, flags, links written as lists, and lists with repeats."""
    s, full = named(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey"), F.concat_ws(" ", "first", "last")
    person = lambda name, primary: F.struct(name.alias("name"), F.lit(primary).alias("primary"))
    people = F.array(person(F.lit("Ada Berg"), False), person(F.lit(" "), True), person(F.concat(full, F.lit(" (Primary)")), True), person(full, False))
    titled = T.title_and_people(F.concat(F.col("last"), F.lit("  rings ("), full, F.lit(") (with Lab)")))
    links = F.concat(F.lit("['https://x.example/"), F.col("id").cast("string"), F.lit("', 'https://y.example']"))
    repeats = F.array(F.concat(F.col("last"), F.lit(", "), F.col("first")), F.concat(F.col("last"), F.lit(","), F.col("first")))
    once = T.distinct_by(repeats, lambda p: F.regexp_replace(p, " ", ""))
    return s.select(
        "id", F.array_join(T.primary_first(people), ", ").alias("people"), titled["title"].alias("title"), F.array_join(titled["people"], "; ").alias("taught"),
        T.strip_flags(F.concat(F.lit("Pre FYF "), full)).alias("flagged"), X.first_listed(links).alias("link"), F.array_join(once, "|").alias("once"),
    )


@query("""
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN y || '-' || lpad(((y + 1) % 100)::VARCHAR, 2, '0') || ' F' WHEN 4 THEN NULL
  WHEN 2 THEN (y - 1) || '-' || lpad((y % 100)::VARCHAR, 2, '0') || ' Su' WHEN 3 THEN y || '-' || lpad(((y + 1) % 100)::VARCHAR, 2, '0') || ' S' ELSE (y - 1) || '-' || lpad((y % 100)::VARCHAR, 2, '0') || ' W' END AS parsed FROM (SELECT o_orderkey, year(o_orderdate) AS y FROM orders)
""")
def term_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of order dates as providers write them, read into year and term."""
    y = F.year("o_orderdate")
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    s = y.cast("string")
    label = by_rest(F.col("o_orderkey"), text("Fall ", s), text(s, " January Term"), text("SUMMER ", s), text("Spring ", s, "-", F.lpad(((y + 1) % 100).cast("string"), 2, "0")), text("Term ", s))
    parsed = G.parse_term(label)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(parsed.isNotNull(), F.concat(parsed["year"], F.lit(" "), parsed["term"])).alias("parsed"))


@query("""
WITH e AS (SELECT event_id, event_type, hour(ts)::INT AS h, minute(ts)::INT AS m, substr('MTWRFSU', isodow(ts)::INT, 1) AS day FROM events),
t AS (SELECT *, lpad(h::VARCHAR, 2, '0') || ':' || lpad(m::VARCHAR, 2, '0') AS clock, lpad(((h + 1) % 24)::VARCHAR, 2, '0') || ':' || lpad(m::VARCHAR, 2, '0') AS later FROM e)
SELECT event_id, clock || '-' || later AS span, day || ' ' || clock || '-' || later || CASE WHEN event_type = 'click' THEN '' ELSE ' (' || event_type || ')' END AS slot,
  CASE WHEN h % 12 = 0 AND m = 0 THEN '' WHEN h % 12 BETWEEN 1 AND 7 THEN lpad((h % 12 + 12)::VARCHAR, 2, '0') || ':' || lpad(m::VARCHAR, 2, '0') ELSE lpad((h % 12)::VARCHAR, 2, '0') || ':' || lpad(m::VARCHAR, 2, '0') END AS guessed,
  lpad(h::VARCHAR, 2, '0') || ':' || lpad(m::VARCHAR, 2, '0') AS plain, day AS letters FROM t
""")
def time_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of events written as ranges with am and pm, read as 24 hours; meetings; times without am or pm; days by index and by name."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.hour("ts").alias("h"), F.minute("ts").alias("m"), F.weekday("ts").alias("d"), "ts")
    twelve = lambda h: F.concat(((h + 11) % 12 + 1).cast("string"), F.lit(":"), F.lpad(F.col("m").cast("string"), 2, "0"), F.when(h % 24 >= 12, "pm").otherwise("am"))
    span = X.time_range(F.concat(twelve(F.col("h")), F.lit(" - "), twelve((F.col("h") + 1) % 24)))
    place = F.when(F.col("event_type") == "click", " ").otherwise(F.col("event_type"))
    bare = F.concat((F.col("h") % 12).cast("string"), F.lit(":"), F.lpad(F.col("m").cast("string"), 2, "0"))
    days = X.days_from_indexes(F.array("d", "d"))
    e = e.withColumn("span", span)
    return e.select("event_id", "span", X.meeting(days, F.col("span"), place).alias("slot"), X.infer_half(bare).alias("guessed"), X.hhmm(F.date_format("ts", "HHmm")).alias("plain"), X.days_from_text(F.date_format("ts", "EEE")).alias("letters"))


@query("""
WITH a AS (SELECT DISTINCT l_orderkey, l_suppkey, s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
n AS (SELECT l_orderkey, string_agg('Supplier ' || l_suppkey || ' A' || l_suppkey || ' [N' || s_nationkey || ']', '; ' ORDER BY l_suppkey) AS authors FROM a GROUP BY 1)
SELECT l_orderkey, authors, CASE l_orderkey % 3 WHEN 0 THEN 'Journal ' || o_orderstatus WHEN 1 THEN 'Findings of the Society: Talks ' || o_orderstatus ELSE '' END AS venue, CASE l_orderkey % 3 WHEN 0 THEN 'journal' ELSE '' END AS venue_type,
  CASE WHEN l_orderkey % 2 = 0 THEN 'doi:' || l_orderkey WHEN l_orderkey % 3 < 2 THEN 'https://land.example/' || l_orderkey ELSE '' END AS url, CASE l_orderkey % 3 WHEN 1 THEN 'Talks ' || o_orderstatus END AS parent,
  CASE WHEN l_orderkey % 3 < 2 THEN 'x' ELSE 'none' END AS filled, CASE WHEN o_orderkey % 2 = 0 THEN 'On $$x_' || o_orderkey || '$$ rings' ELSE 'Rings of ' || o_orderpriority END AS title
FROM n JOIN orders ON l_orderkey = o_orderkey
""")
def nested_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as nested records of works: authors, venue, link and parent volume with their fallbacks, titles without the text that repeats their formulas."""
    pairs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct().join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    key = F.col("l_suppkey").cast("string")
    inst = F.struct(F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("display_name"))
    one = F.struct(F.struct(F.concat(F.lit("https://o.example/A"), key).alias("id"), F.concat(F.lit("Supplier "), key).alias("display_name")).alias("author"), F.array(inst, inst).alias("institutions"))
    nested = pairs.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_suppkey", one.alias("a")))), lambda x: x["a"]).alias("authorships"))
    k, status = F.col("l_orderkey"), F.col("o_orderstatus")
    source = F.when(k % 3 == 0, F.struct(F.concat(F.lit("Journal "), status).alias("display_name"), F.lit("journal").alias("type")))
    location = F.when(k % 3 < 2, F.struct(source.alias("source"), F.concat(F.lit("Findings of the Society: Talks "), status).alias("raw_source_name"), F.concat(F.lit("https://land.example/"), k.cast("string")).alias("landing_page_url")))
    formula = F.concat(F.lit("x_"), k.cast("string"))
    title = F.when(k % 2 == 0, F.concat(F.lit("On $$"), formula, F.lit("$$ x "), k.cast("string"), F.lit(" rings"))).otherwise(F.concat(F.lit("Rings of "), "o_orderpriority"))
    works = nested.join(table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey").select("l_orderkey", "authorships", location.alias("location"), F.when(k % 2 == 0, F.concat(F.lit("doi:"), k.cast("string"))).otherwise("").alias("doi"), title.alias("title"))
    authors = F.transform(X.authors_of(F.col("authorships")), lambda a: F.concat(a["name"], F.lit(" "), a["id"], F.lit(" ["), F.array_join(a["affiliations"], ","), F.lit("]")))
    venue = X.work_venue(F.col("location"))
    return works.select(
        "l_orderkey", F.array_join(authors, "; ").alias("authors"), venue.alias("venue"), X.work_venue_type(F.col("location")).alias("venue_type"), X.work_url(F.col("doi"), F.col("location")).alias("url"),
        X.findings_parent(venue).alias("parent"), X.first_filled(F.lit(" "), F.when(venue != "", "x"), F.lit("none")).alias("filled"), T.drop_math_fallback(F.col("title")).alias("title"),
    )


@query("""
WITH d AS (SELECT doc_id, text, regexp_replace(left(text, 40), '\\s+\\S*$', '') AS cut FROM documents)
SELECT doc_id, CASE WHEN length(text) > 40 THEN CASE WHEN length(regexp_replace(cut, '[^$]', '', 'g')) % 2 = 1 THEN regexp_replace(cut, '\\s*\\$[^$]*$', '') ELSE cut END || '…' ELSE text END AS short FROM d
""")
def short_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts cut at a word's end."""
    return table(spark, sf_dir, "documents").select("doc_id", T.truncate_words(F.col("text"), 40).alias("short"))


FILTER_ROWS = """
WITH r AS (SELECT p_partkey, p_size, p_name, p_type, p_brand, (2018 + p_size % 10) AS y, CASE p_partkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'W' WHEN 2 THEN 'S' ELSE 'Su' END AS term FROM part)
"""


@query(FILTER_ROWS + """
SELECT p_partkey, (y >= 2021 AND term <> 'Su') AS in_years, p_type LIKE 'S%' AS prefixed, p_size % 7 = 0 AS excluded, p_size % 5 = 0 AND p_size % 7 <> 0 AS lab_only,
  p_size % 3 <> 2 AS to_do, p_type = 'PROMO' OR p_size % 6 = 1 AS marker, p_size % 4 <> 1 AS own_term, NOT (p_brand = 'Brand#1' AND p_size < 10) AS shown,
  p_size % 10 BETWEEN 1 AND 2 AND p_partkey % 4 < 2 AS eligible, p_size % 5 IN (0, 3) AS campus, p_size % 4 < 2 AS trusted, p_size % 3 = 0 AS listed, p_size % 2 = 0 AS several FROM r
""")
def row_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as course rows, pages and people; what each filter says of them."""
    r, k, size = table(spark, sf_dir, "part"), F.col("p_partkey"), F.col("p_size")
    term = by_rest(k, "F", "W", "S", "Su")
    name = F.concat(F.when(size % 7 == 0, by_rest(size, "Senior Thesis in ", "Independent Study: ", "Honors ")).when(size % 5 == 0, by_rest(k, "Lab for ", "Laboratory: ")).otherwise(by_rest(k, "", "Rings with Lab, ")), F.col("p_name"))
    plain = F.when(size % 7 == 0, F.col("p_name")).otherwise(name)
    kind, label = F.when(F.col("p_type") == "PROMO", by_rest(k, "grad", "Dual")).otherwise(F.col("p_type")), F.when(size % 6 == 1, F.concat(F.lit("Final Exam "), F.col("p_name"))).otherwise(F.col("p_name"))
    url = by_rest(size, "https://www.x.edu/a", "https://x.com/a", "https://linkedin.com/in/a", "https://cs.y.edu/~a", "not a link")
    fields = by_rest(size, "Computer Science and Mathematics", "Statistics alone")
    return r.select(
        "p_partkey", P.in_years(X.academic_year(2018 + size % 10), term).alias("in_years"), P.has_prefix(F.concat(F.lit(" "), F.lower("p_type")), "S").alias("prefixed"), P.is_excluded(name).alias("excluded"),
        P.is_lab_only(plain).alias("lab_only"), P.needs_processing(by_rest(size, F.lit(None).cast("string"), "rescrape ", "matched")).alias("to_do"), P.is_marker(kind, label).alias("marker"),
        P.in_partition(by_rest(size, "2020-21", "2019-20", F.lit(None).cast("string"), "2020-21"), by_rest(size, "F", "F", "F", F.lit(None).cast("string")), F.lit("2020-21"), F.lit("F")).alias("own_term"),
        P.hide_sublisting(F.col("p_brand"), size.cast("string"), "Brand#1", r"^\d$").alias("shown"),
        (P.eligible((size % 10).cast("string"), 1, by_rest(k, "ME", "VT", "NY", "TX"), ["ME", "VT"]) & (size % 10 <= 2)).alias("eligible"), P.is_campus_page(url).alias("campus"),
        P.is_trusted(by_rest(size, "matched", "manual_approved", "no_match", F.lit(None).cast("string"))).alias("trusted"), P.in_directory(by_rest(size, "Computer Science", "Other", F.lit(None).cast("string"))).alias("listed"), P.has_multiple_fields(fields).alias("several"),
    )


@query("""
SELECT p_partkey FROM part WHERE p_size BETWEEN 5 AND 40 AND p_type IN ('ECONOMY', 'PROMO') AND NOT (p_type = 'PROMO' AND p_brand = 'Brand#1') AND (p_type = 'ECONOMY' AND p_brand IN ('Brand#1', 'Brand#2') OR p_type = 'PROMO' AND p_brand = 'Brand#3')
""")
def facet_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a size range by included and excluded (type, brand) facets."""
    include = [("ECONOMY", "Brand#1"), ("ECONOMY", "Brand#2"), ("PROMO", "Brand#1"), ("PROMO", "Brand#3")]
    return table(spark, sf_dir, "part").where(P.in_facets(F.col("p_type"), F.col("p_brand"), F.col("p_size"), include, [("PROMO", "Brand#1")], (5, 40))).select("p_partkey")


@query("""
SELECT o_orderkey, coalesce(c_mktsegment, '') AS segment FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0
""")
def lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segment of each order's customer, blank for customers that aren't listed."""
    listed = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    return J.lookup(table(spark, sf_dir, "orders"), listed, ["o_custkey"], "segment").select("o_orderkey", "segment")


@query("""
WITH j AS (SELECT p_name AS title, min(CASE WHEN p_size % 5 < 4 THEN 'Q' || (p_size % 5 + 1) END) AS quartile FROM part WHERE p_size > 10 GROUP BY 1 HAVING quartile IS NOT NULL),
f AS (SELECT DISTINCT p_name AS title, '-' AS quartile FROM part)
SELECT title, quartile FROM j UNION ALL SELECT title, quartile FROM f WHERE title NOT IN (SELECT title FROM j)
""")
def best_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best quartile of each journal of several files; curated rows fill in the journals that those lack."""
    size = F.col("p_size")
    journals = table(spark, sf_dir, "part").where(size > 10).select(F.col("p_name").alias("title"), F.when(size % 5 == 4, "-").otherwise(F.concat(F.lit("Q"), (size % 5 + 1).cast("string"))).alias("quartile"), F.col("p_partkey").alias("pos"))
    main = A.best_by_key(journals, ["title"], "quartile", "pos").select("title", "quartile")
    fillers = table(spark, sf_dir, "part").select(F.col("p_name").alias("title"), F.lit("-").alias("quartile")).distinct()
    return A.with_fillers(main, fillers, ["title"])


@query("""
WITH c AS (SELECT s_suppkey, s_suppkey % 4 AS kind, 'CS' || (100 + s_suppkey % 7) AS a, 'MA' || (200 + s_suppkey % 5) || 'L' AS b, s_name FROM supplier),
t AS (SELECT s_suppkey, 0 AS nth, a AS code, s_name || ' of rings' AS title FROM c WHERE kind = 0 UNION ALL SELECT s_suppkey, 1, b, s_name || CASE kind WHEN 3 THEN ' of gears' ELSE '' END FROM c WHERE kind <> 2),
l AS (SELECT code, arg_min(title, (s_suppkey, nth)) AS title FROM t GROUP BY 1)
SELECT s_suppkey, code, title FROM (SELECT s_suppkey, a AS code FROM c UNION ALL SELECT s_suppkey, left(b, 5) FROM c) JOIN l USING (code)
UNION ALL SELECT s_suppkey, code, title FROM (SELECT s_suppkey, b AS code FROM c) JOIN l USING (code)
""")
def grid_legend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that hold several codes, cut before each, with the first title that the cells of the key give a code: titles up to a time, a day or another code, sections in a title's place, entries of the schedule."""
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    a, b = F.concat(F.lit("CS"), (100 + k % 7).cast("string")), F.concat(F.lit("MA"), (200 + k % 5).cast("string"), F.lit("L"))
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) and p != "s_name" else p for p in parts])
    cells = R.split_cell(s.select("s_suppkey", F.concat(a, F.lit(" "), b, F.lit(" "), F.substring(b, 1, 5)).alias("cell")), "cell").select("s_suppkey", F.trim("cell").alias("code"))
    kinds = [text(a, ": ", "s_name", " of\n rings; ", b, " ", "s_name", " 10:00-10:50"), text(a, " L06 ", "s_name", " ", b, ": ", "s_name", " Monday 9"), text(a, " ", "s_name", " (Hall 1) ", b, " ", "s_name"), text(a, " ", b, ": ", "s_name", " of gears")]
    notes = s.select("s_suppkey", F.element_at(F.array(*kinds), (k % 4 + 1).cast("int")).alias("cell"))
    return cells.join(R.legend(notes, "cell", "s_suppkey"), "code").select("s_suppkey", "code", "title")


@query("SELECT s_suppkey, substr('MTWRF', d::INT, 1) AS day, '9:0' || t AS label, s_name || d || t AS cell FROM supplier, range(1, 6) a(d), range(0, 3) b(t) WHERE (s_suppkey + d + t) % 4 <> 0 AND t < 2")
def transposed_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendars whose rows are days and whose columns are times; the last column has no time and goes."""
    s = table(spark, sf_dir, "supplier")
    cell = lambda d, t: F.when((F.col("s_suppkey") + d + t) % 4 != 0, F.concat("s_name", F.lit(f"{d}{t}"))).otherwise("")
    header = s.select("s_suppkey", F.lit(0).alias("row"), F.array(F.lit("Time"), F.lit("9:00"), F.lit("9:01"), F.lit("")).alias("cells"))
    grid = header
    for d, name in enumerate("MTWRF", 1):
        grid = grid.unionByName(s.select("s_suppkey", F.lit(d).alias("row"), F.array(F.lit(name), *[cell(d, t) for t in range(3)]).alias("cells")))
    return R.transposed(grid, "s_suppkey", "row", "cells", list("MTWRF")).withColumnRenamed("name", "day")


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_mktsegment, c_nationkey DESC, c_custkey LIMIT 40")
def stable_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of customers in an order of several keys."""
    return O.stable_sort(table(spark, sf_dir, "customer"), F.col("c_mktsegment"), F.desc("c_nationkey"), F.col("c_custkey")).select("c_custkey", "c_name").limit(40)


@query(r"""
WITH v AS (SELECT DISTINCT initcap_name, p_name FROM (SELECT p_name, array_to_string([upper(left(w, 1)) || substr(w, 2) FOR w IN string_split(p_name, ' ')], ' ') AS initcap_name FROM part))
SELECT p_name, 'Proc. of the Int''l Conf. on ' || initcap_name || ', Wksp.; ' || p_name || ' comput. & edu.' AS shown FROM v
""")
def venue_short_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venue titles around the parts' names, with their long words in short forms."""
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    title = F.concat(F.lit("Proceedings of the International Conference on "), F.initcap("p_name"), F.lit(", Workshop; "), "p_name", F.lit(" computing and education"))
    # What stands for a lower-cased word begins in lower case; '&' has none.
    return names.select("p_name", T.shorten_words(title).alias("shown"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'arXiv' WHEN 1 THEN NULL WHEN 2 THEN 'Vault' ELSE p_name || ' & Sons' END AS venue FROM part")
def venues_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of venues as providers write them: preprint servers, links, repositories, escaped names."""
    raw = by_rest(F.col("p_partkey"), F.concat(F.lit("ArXiv.org: "), "p_name"), F.concat(F.lit("http://x.example/"), F.col("p_partkey").cast("string")), F.concat(F.lit("Vault ("), "p_name", F.lit(")")), F.concat("p_name", F.lit(" &amp; Sons")))
    return table(spark, sf_dir, "part").select("p_partkey", T.clean_venue(raw).alias("venue"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'capekturcanu' || replace(p_name, ' ', '') WHEN 1 THEN 'zoenguyen' ELSE 'sao' || replace(p_name, ' ', '') END AS letters FROM part")
def accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with accents of several alphabets, also written with combining marks, as plain letters."""
    raw = by_rest(F.col("p_partkey"), F.concat(F.lit("Čapek-Ţurcanu "), "p_name"), F.lit("ZOË NGUYỄN"), F.concat(F.lit("Sa\u0303o "), "p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", T.letters(raw).alias("letters"))
