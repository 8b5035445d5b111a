"""The jobs that a user calls, on the driver's tables: nations stand for colleges, suppliers for people, orders for works, parts for courses."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import fields as X
from ..operators import joins as J
from ..operators import tables as S
from ..plans import jobs
from ..plans import search as Q
from .courses import OBSERVATIONS, observations
from .pages import PAIRS, VISIBLE
from .people import SUPPLIERS, named
from .registry import query, table

NOISE = "|".join(f"(?:{p})" for p in K.NOISE_LINES).replace("'", "''")
HOST = r"regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^www\.', '')"


@query(rf"""
WITH p AS (SELECT page_id, {HOST} AS site, regexp_extract({HOST}, '([a-z]+)$', 1) AS college, split_part(regexp_extract(html, '<h1>(.*?)</h1>', 1), ' ', 1) AS name, {VISIBLE} AS text FROM pages),
l AS (SELECT *, string_split(text, chr(10)) AS own FROM p WHERE text IS NOT NULL),
sizes AS (SELECT college, site, count(*) AS n, max(count(*)) OVER (PARTITION BY college) AS most FROM l WHERE site LIKE '%.example.com' GROUP BY 1, 2),
large AS (SELECT college, site FROM sizes WHERE n = most AND n >= 2),
inside AS (SELECT l.* FROM l JOIN large USING (college, site)),
g AS (SELECT college, site, min(page_id) AS first, arg_min(own, page_id) AS ref FROM inside GROUP BY 1, 2),
pairs AS (SELECT inside.*, ref AS a, own AS b FROM inside JOIN g USING (college, site) WHERE page_id <> first) {PAIRS},
firsts AS (SELECT college, site, arg_min(ref_lines, page_id) AS lines FROM trimmed WHERE ok GROUP BY 1, 2),
cleaned AS (SELECT page_id, lines FROM trimmed UNION ALL SELECT g.first, coalesce(firsts.lines, g.ref) FROM g LEFT JOIN firsts USING (college, site)),
every AS (SELECT l.page_id, l.college, l.name, coalesce(cleaned.lines, l.own) AS lines FROM l LEFT JOIN cleaned USING (page_id)),
spread AS (SELECT page_id, college, name, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM every),
hits AS (SELECT *, (regexp_matches(lower(line), 'area|research|interest|courses|teaching|paper|publication') OR length(name) >= 2 AND contains(lower(line), lower(name)))::INT AS hit FROM spread WHERE length(line) > 0),
near AS (SELECT *, max(hit) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS close, max(hit) OVER (PARTITION BY page_id) AS any_hit FROM hits),
kept AS (SELECT page_id, college, line, pos FROM near WHERE (close = 1 OR any_hit = 0) AND NOT (regexp_replace(lower(trim(line)), '[:.]+$', '') = '' OR regexp_matches(regexp_replace(lower(trim(line)), '[:.]+$', ''), '{NOISE}'))
  AND NOT (len(string_split(line, ' ')) < 8 AND len(regexp_extract_all(line, '(Mathematics|Statistics|Computer Science)')) > 1)),
n AS (SELECT college, count(DISTINCT page_id) AS pages FROM kept GROUP BY 1 HAVING pages >= 5),
df AS (SELECT college, trim(line) AS line, count(DISTINCT page_id) AS df FROM kept WHERE length(line) >= 3 GROUP BY 1, 2),
bad AS (SELECT df.college, line FROM df JOIN n USING (college) WHERE df >= greatest(2, floor(pages * 0.4))),
texts AS (SELECT page_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM kept WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.college = kept.college AND bad.line = trim(kept.line)) GROUP BY 1)
SELECT p.page_id, p.college, p.name, texts.text FROM p LEFT JOIN texts USING (page_id)
""")
def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as people's pages; hosts are folders, their last parts (of which one is the colleges' own) colleges: text without what pages share, noise, and lines far from what is looked for."""
    p = table(spark, sf_dir, "pages")
    name = F.substring_index(F.regexp_extract("html", "<h1>(.*?)</h1>", 1), " ", 1)
    host = X.host(F.col("url"))
    url = F.concat(F.lit("https://"), host, F.lit("/p"), F.lpad(F.col("page_id").cast("string"), 12, "0"))
    out = jobs.clean_pages(p.select(F.regexp_extract(host, "([a-z]+)$", 1).alias("college"), name.alias("name"), url.alias("url"), "html"), ending=".example.com")
    return out.select(F.regexp_extract("url", r"/p(\d+)$", 1).cast("long").alias("page_id"), "college", "name", "text")


WORK_ROWS = f"""
WITH {SUPPLIERS},
roster AS (SELECT s.*, first || ' ' || last AS name FROM s JOIN supplier ON s.id = s_suppkey WHERE s_acctbal > 3000)
"""


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as nested works: the suppliers of their lines are the authors, nations their institutions: two, one or none."""
    s = named(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey")
    place = lambda n: F.struct(n.cast("string").alias("ror"), F.concat(F.lit(" N"), n.cast("string")).alias("display_name"))
    none = F.array().cast("array<struct<ror:string,display_name:string>>")
    # One author in seven has no id.
    link = F.when(F.col("l_suppkey") % 7 > 0, F.concat(F.lit("https://o.example/A"), F.col("l_suppkey").cast("string")))
    at = F.when(F.col("l_suppkey") % 13 == 0, none).when(F.col("l_suppkey") % 5 == 0, F.array(place(F.col("grp")), place((F.col("grp") + 1) % 25))).otherwise(F.array(place(F.col("grp"))))
    author = F.struct(F.col("l_suppkey").alias("pos"), F.struct(F.struct(link.alias("id"), F.concat_ws(" ", "first", "last").alias("display_name")).alias("author"), at.alias("institutions")).alias("a"))
    by_work = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct().join(s.withColumnRenamed("id", "l_suppkey"), "l_suppkey").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.transform(F.array_sort(F.collect_list(author)), lambda x: x["a"]).alias("authorships"))
    k = F.col("o_orderkey")
    title = F.when(k % 11 != 0, F.concat(F.lit("On "), "o_orderpriority", F.lit(" "), (k % 200).cast("string")))
    kind = F.when(k % 5 == 0, "article").when(k % 5 == 1, "preprint").when(k % 5 == 2, "dataset").when(k % 5 == 3, "book-chapter").otherwise("report")
    text = k.cast("string")
    source = F.when(k % 4 > 0, F.struct(F.concat(F.lit("s"), (k % 9).cast("string")).alias("id"), F.when(k % 4 > 1, F.concat(F.lit("Venue "), (k % 9).cast("string"))).alias("display_name"), F.when(k % 2 == 0, "journal").alias("type")))
    location = F.when(k % 6 > 0, F.struct(F.concat(F.lit("https://l.example/"), text).alias("landing_page_url"), F.lit("raw venue").alias("raw_source_name"), source.alias("source")))
    topic = lambda n: F.struct(F.concat(F.lit("T"), n.cast("string")).alias("display_name"), F.struct(F.when(n % 2 == 0, F.concat(F.lit("S"), n.cast("string"))).alias("display_name")).alias("subfield"))
    o = table(spark, sf_dir, "orders").join(by_work, "o_orderkey")
    return o.select(
        F.concat(F.lit("W"), F.lpad(text, 9, "0")).alias("id"), F.when(k % 3 == 0, F.concat(F.lit("https://d.example/"), text)).alias("doi"), title.alias("title"), kind.alias("type"), F.year("o_orderdate").alias("publication_year"),
        F.col("o_totalprice").cast("int").alias("cited_by_count"), "authorships", location.alias("primary_location"), F.array(topic(k % 3), topic(k % 4)).alias("topics"),
    )


@query(WORK_ROWS + """
, i AS (SELECT s.id AS sid, grp, s.first || ' ' || s.last AS name, lower(s.last) AS last, lower(left(s.first, 1)) AS initial, CASE WHEN s.id % 13 = 0 THEN [] WHEN s.id % 5 = 0 THEN [grp, (grp + 1) % 25] ELSE [grp] END AS insts FROM s),
o AS (SELECT o_orderkey AS k, 'W' || lpad(o_orderkey::VARCHAR, 9, '0') AS id, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'On ' || o_orderpriority || ' ' || (o_orderkey % 200)::VARCHAR END AS title, year(o_orderdate)::INT AS year, [0, 2, 2, 1, 1][o_orderkey % 5 + 1] AS rank FROM orders),
a AS (SELECT DISTINCT o.k, o.id, i.* FROM lineitem JOIN o ON l_orderkey = o.k JOIN i ON i.sid = l_suppkey),
keyed AS (SELECT grp AS inst, lower(last) AS last, lower(left(first, 1)) AS initial, arg_max(name, id) AS name FROM roster GROUP BY 1, 2, 3),
m AS (SELECT x.id, x.inst AS college, x.sid, keyed.name FROM (SELECT *, unnest(insts) AS inst FROM a) x JOIN keyed USING (inst, last, initial)),
r AS (SELECT m.id, m.college, list(DISTINCT m.name) AS names, list(DISTINCT m.sid) AS sids FROM m GROUP BY 1, 2),
w AS (SELECT r.*, o.k, o.title, o.year, o.rank, CASE WHEN o.title IS NULL THEN o.id ELSE trim(regexp_replace(lower(o.title), '[^a-z0-9]+', ' ', 'g')) END AS key FROM r JOIN o USING (id)),
b AS (SELECT college, key, arg_min(id, (rank, year, id)) AS id, arg_min(k, (rank, year, id)) AS k, arg_min(title, (rank, year, id)) AS title, arg_min(sids, (rank, year, id)) AS sids, list_sort(list_distinct(flatten(list(names)))) AS matched FROM w GROUP BY 1, 2),
peers AS (SELECT list(n_nationkey) AS peers FROM nation WHERE n_regionkey < 3),
c AS (SELECT b.id, b.college, a.name, a.sid, CASE WHEN list_contains(a.insts, b.college) THEN CASE WHEN EXISTS (SELECT 1 FROM roster WHERE roster.grp = b.college AND lower(roster.last) = a.last) THEN 'faculty' ELSE 'student' END
        WHEN list_has_any(a.insts, peers) THEN 'other' ELSE 'external' END AS kind FROM b JOIN a USING (id), peers WHERE NOT list_contains(b.sids, a.sid)),
l AS (SELECT id, college, string_agg(name, '|' ORDER BY sid) FILTER (WHERE kind = 'student') AS student, string_agg(name, '|' ORDER BY sid) FILTER (WHERE kind = 'faculty') AS faculty,
        string_agg(name, '|' ORDER BY sid) FILTER (WHERE kind = 'other') AS other, string_agg(name, '|' ORDER BY sid) FILTER (WHERE kind = 'external') AS external FROM c GROUP BY 1, 2)
SELECT b.id, ('N' || b.college) AS college, b.title, array_to_string(b.matched, '|') AS matched, student, faculty, other, external,
  CASE WHEN k % 3 = 0 THEN 'https://d.example/' || k WHEN k % 6 > 0 THEN 'https://l.example/' || k ELSE '' END AS url,
  CASE WHEN k % 6 = 0 THEN '' WHEN k % 4 > 1 THEN 'Venue ' || (k % 9) ELSE 'raw venue' END AS venue, CASE WHEN k % 6 > 0 AND k % 4 > 0 AND k % 2 = 0 THEN 'journal' ELSE '' END AS venue_type,
  array_to_string(list_distinct_in_order, '|') AS topics, array_to_string(list_filter(list_distinct_in_order, lambda t: t IN ('T0', 'T2')), '|') AS topics_even
FROM (SELECT *, CASE WHEN k % 3 = k % 4 THEN ['T' || (k % 3)] ELSE ['T' || (k % 3), 'T' || (k % 4)] END AS list_distinct_in_order FROM b) b LEFT JOIN l USING (id, college)
""")
def link_publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders linked with the suppliers of good standing who wrote them, the best of each title for each nation, with co-authors by kind and the work's own fields."""
    s = named(table(spark, sf_dir, "supplier").where("s_acctbal > 3000"), "s_suppkey", "s_nationkey")
    inst = F.col("grp").cast("string")
    roster = s.select(F.concat_ws(" ", "first", "last").alias("name"), F.concat(F.lit("N"), inst).alias("college"), inst.alias("inst"), F.col("id").alias("pos"))
    peers = table(spark, sf_dir, "nation").where("n_regionkey < 3").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("name"))
    out = jobs.link_publications(works(spark, sf_dir), roster, peers)
    joined = lambda c: F.nullif(F.array_join(c, "|"), F.lit(""))
    shown = F.array_join(F.transform("subfields", lambda x: F.replace(x, F.lit("S"), F.lit("T"))), "|").alias("topics_even")
    return out.select("id", "college", "title", joined("matched").alias("matched"), *[joined(f"{k}_coauthors").alias(k) for k in ("student", "faculty", "other", "external")], "url", "venue", "venue_type", F.array_join("topics", "|").alias("topics"), shown)


@query(r"""
WITH n AS (SELECT p_name, min(p_partkey) AS pos, length(p_name) AS len, array_to_string([upper(left(w, 1)) || substr(w, 2) FOR w IN string_split(p_name, ' ')], ' ') AS shown, upper(array_to_string([left(w, 3) FOR w IN string_split(p_name, ' ')], '')) AS acronym FROM part GROUP BY p_name),
e AS (SELECT *, ['A*', 'A', 'B', 'C'][len % 4 + 1] AS rank, CASE WHEN len % 5 = 0 THEN '-' ELSE 'Q' || (len % 4 + 1) END AS quartile, p_name LIKE '%widget' AS ruled FROM n),
-- The best entry of an acronym keeps it, others are known by acronym and title: names that begin alike share one.
k AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY acronym ORDER BY len % 4, pos) = 1 THEN acronym ELSE acronym || ' (Conference on ' || shown || ' Systems)' END AS key FROM e),
p AS (SELECT p_partkey, p_partkey % 8 AS kind, k.* FROM part JOIN k USING (p_name)),
f AS (SELECT p.*, CASE WHEN p.ruled AND kind < 6 AND kind <> 4 THEN 'WIDGETS' END AS label, h.rank AS head_rank, h.shown AS head FROM p JOIN k h ON h.acronym = p.acronym AND h.key = h.acronym)
SELECT p_partkey,
  CASE WHEN label IS NOT NULL THEN label WHEN kind = 0 THEN key WHEN kind = 1 THEN acronym WHEN kind = 2 THEN acronym || ' (Findings)' WHEN kind = 5 AND len % 2 = 1 THEN 'DAY' || pos END AS acronym,
  CASE WHEN label IS NOT NULL THEN 'Widgets' END AS area, label IS NOT NULL AND kind <> 4 AS listed,
  CASE WHEN label IS NOT NULL THEN 'A' WHEN kind = 0 THEN rank WHEN kind IN (1, 2) THEN head_rank WHEN kind = 5 AND len % 2 = 1 THEN 'B' END AS rank,
  CASE WHEN label IS NOT NULL THEN 'r/W' WHEN kind = 0 THEN 'r/' || shown WHEN kind IN (1, 2) THEN 'r/' || head END AS rank_url,
  CASE WHEN kind = 3 AND len % 2 = 0 OR kind = 6 THEN quartile WHEN kind = 7 THEN 'Q1' END AS quartile, CASE WHEN kind = 3 AND len % 2 = 0 OR kind = 6 THEN 'i' || pos END AS issn
FROM f
""")
def tag_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts' names as venues of each kind, tagged by a rule and ranked: proceedings, acronyms in brackets, findings, journals (as such and called otherwise), a link, days and letters."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    parts = lambda f: F.transform(F.split("p_name", " "), f)
    shown, acronym, size = F.initcap("p_name"), F.upper(F.array_join(parts(lambda w: F.substring(w, 1, 3)), "")), F.length("p_name")
    title, text = F.concat(F.lit("Conference on "), shown, F.lit(" Systems")), lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y for y in x])
    journal = F.when(size % 2 == 0, "journal")
    kinds = [
        (text("Proceedings of the 5th ", title), F.lit("journal")), (text(title, " (", acronym, " 2020)"), F.lit("conference")), (text("Findings of the ", shown, " Society: ", acronym), F.lit("conference")),
        (text("IEEE/ACM Transactions on ", shown, " Networking"), journal), (F.lit("https://x.example/venue"), F.lit("repository")), (text(shown, " Days"), F.coalesce(journal, F.lit("conference"))),
        (text(shown, " Letters"), F.lit("journal")), (F.lit("Nature"), F.lit("journal")),
    ]
    picked = F.element_at(F.array(*[F.struct(v.alias("venue"), t.alias("venue_type")) for v, t in kinds]), (F.col("p_partkey") % 8 + 1).cast("int"))
    known = p.groupBy("p_name").agg(F.min("p_partkey").alias("pos"))
    rank = F.element_at(F.array(*[F.lit(r) for r in ("A*", "A", "B", "C")]), size % 4 + 1)
    days = known.select(F.concat(F.lit("DAY"), F.col("pos").cast("string")).alias("acronym"), text(shown, " Days").alias("title"), F.lit("B").alias("rank"), (F.col("pos") + 10_000_000).alias("pos"), F.lit(None).cast("string").alias("url"))
    widgets = spark.range(1).select(F.lit("WID").alias("acronym"), F.lit("Widgets").alias("title"), F.lit("A").alias("rank"), F.lit(-1).cast("long").alias("pos"), F.lit("r/W").alias("url"))
    conferences = known.select(acronym.alias("acronym"), title.alias("title"), rank.alias("rank"), "pos", text("r/", shown).alias("url")).unionByName(days).unionByName(widgets)
    quartile = F.when(size % 5 == 0, "-").otherwise(F.concat(F.lit("Q"), (size % 4 + 1).cast("string")))
    listed = lambda name, shift: known.select(name.alias("title"), quartile.alias("quartile"), (F.col("pos") + shift).alias("pos"), F.concat(F.lit("i"), F.col("pos").cast("string")).alias("issn"))
    journals = listed(text("IEEE Transactions on ", shown, " Networking"), 0).unionByName(listed(text(shown, " Letters, LTR"), 20_000_000))
    rules = [("WIDGETS", "Widgets", [r"\bwidget\b"], [r"\bletters$"])]
    out = jobs.tag_venues(p.select("p_partkey", picked.alias("v")).select("p_partkey", "v.*"), rules, conferences, journals, {"WIDGETS": "WID"})
    return out.select("p_partkey", "acronym", "area", F.coalesce("listed", F.lit(False)).alias("listed"), "rank", "rank_url", "quartile", "issn")


@query(WORK_ROWS + """
, w AS (SELECT DISTINCT l_orderkey AS k, l_suppkey AS sid, s.first || ' ' || s.last AS name, s.grp AS college, lower(s.last) AS last, lower(left(s.first, 1)) AS initial FROM lineitem JOIN s ON s.id = l_suppkey),
ids AS (SELECT *, CASE WHEN k % 5 = 0 THEN 'B' ELSE 'A' END || sid AS aid FROM w),
pairs AS (SELECT p.college, p.name, q.aid, p.k FROM (SELECT DISTINCT k, college, name, last, initial FROM w) p JOIN ids q USING (k, college, last, initial)),
n AS (SELECT college, name, aid, count(*) AS n, min(k) AS f FROM pairs GROUP BY 1, 2, 3),
best AS (SELECT college, name, arg_max(aid, (n, -f)) AS id, max(n)::BIGINT AS n FROM n GROUP BY 1, 2)
SELECT s.id AS person, best.n FROM s LEFT JOIN best ON best.college = s.grp AND best.name = s.first || ' ' || s.last
""")
def resolve_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many orders give each supplier the id that most of them do."""
    s = named(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey")
    college, name = F.col("grp").cast("string"), F.concat_ws(" ", "first", "last")
    w = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct().join(s.withColumnRenamed("id", "l_suppkey"), "l_suppkey")
    aid = F.concat(F.when(F.col("l_orderkey") % 5 == 0, "B").otherwise("A"), F.col("l_suppkey").cast("string"))
    author = F.struct(name.alias("name"), aid.alias("id"), F.array(college).alias("affiliations"))
    papers = w.groupBy(F.col("l_orderkey").alias("paper"), college.alias("college")).agg(F.array_sort(F.collect_set(name)).alias("matched"), F.array_sort(F.collect_list(author)).alias("authors")).withColumn("pos", F.col("paper"))
    roster = s.select("id", college.alias("college"), name.alias("name"))
    out = jobs.resolve_ids(papers, roster.withColumnRenamed("id", "person"))
    return out.select("person", "n")


@query(rf"""
WITH {SUPPLIERS},
r AS (SELECT s.*, first || ' ' || last AS name, n_name AS college, CASE WHEN id % 7 = 0 THEN 'manual_approved' WHEN id % 7 = 1 THEN 'rescrape' ELSE '' END AS done, CASE WHEN id % 5 = 0 THEN '' ELSE 'u' || id END AS url,
        CASE id % 3 WHEN 0 THEN first || ' M. ' || last WHEN 1 THEN last || ' ' || first ELSE first END AS profile, CASE WHEN id % 2 = 0 THEN n_name || ' University' ELSE 'Elsewhere' END AS affiliation FROM s JOIN nation ON n_nationkey = grp),
l AS (SELECT *, regexp_replace(lower(name), '[^a-z]', '', 'g') AS a, regexp_replace(lower(profile), '[^a-z]', '', 'g') AS b, regexp_replace(lower(college), '[^a-z]', '', 'g') AS x, regexp_replace(lower(affiliation), '[^a-z]', '', 'g') AS y FROM r),
q AS (SELECT *, regexp_matches(b, array_to_string(regexp_extract_all(a, '.'), '.*')) OR regexp_matches(a, array_to_string(regexp_extract_all(b, '.'), '.*')) AS n_ok, regexp_matches(y, array_to_string(regexp_extract_all(x, '.'), '.*')) OR regexp_matches(x, array_to_string(regexp_extract_all(y, '.'), '.*')) AS c_ok FROM l)
SELECT id AS person, CASE WHEN done = 'manual_approved' THEN done WHEN url = '' THEN 'no_url' WHEN id % 11 = 0 THEN 'fetch_error' WHEN n_ok AND c_ok THEN 'matched' WHEN n_ok THEN 'matched_name' WHEN c_ok THEN 'matched_college' ELSE 'no_match' END AS status FROM q
""")
def verify_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers against profile pages: approved ones stay, others get a status by names and nations; links may be written as lists."""
    s = named(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey").join(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("grp"), F.col("n_name").alias("college")), "grp")
    k, name, link = F.col("id"), F.concat(F.concat_ws(" ", "first", "last")), F.concat(F.lit("u"), F.col("id").cast("string"))
    # Names of persons repeat, so the id belongs to the college's name.
    college = F.concat("college", F.lit(" "), k.cast("string"))
    url = F.when(k % 5 == 0, "").when(k % 2 == 0, F.concat(F.lit("['"), link, F.lit("', 'v']"))).otherwise(link)
    roster = s.select(name.alias("name"), college.alias("college"), url.alias("url"), k.alias("pos"))
    written = F.when(k % 3 == 0, F.concat("first", F.lit(" M. "), "last")).when(k % 3 == 1, F.concat_ws(" ", "last", "first")).otherwise(F.col("first"))
    profiles = s.where(k % 11 != 0).select(link.alias("url"), written.alias("profile_name"), F.when(k % 2 == 0, F.concat("college", F.lit(" University"))).otherwise("Elsewhere").alias("affiliation"))
    done = s.where(k % 7 < 2).select(name.alias("name"), college.alias("college"), F.when(k % 7 == 0, "manual_approved").otherwise("rescrape").alias("status"))
    return jobs.verify_profiles(roster, profiles, done).select(F.col("pos").alias("person"), "status")


COURSE_ROWS = OBSERVATIONS.rstrip() + f""", {SUPPLIERS},
rows AS (
  SELECT o.grp AS college, (start + 26)::VARCHAR || '-' || lpad(((start + 27) % 100)::VARCHAR, 2, '0') AS year, term, o.rank, pos, pos % 7 = 0 AS lab, pos % 6 = 5 AS thesis, CASE WHEN left(o.code, 4) = 'PROM' THEN '' ELSE 'C' END || o.code || CASE WHEN pos % 7 = 0 THEN 'L' ELSE '' END AS code,
         o.name || CASE WHEN pos % 7 = 0 THEN ' Lab' ELSE '' END AS name, s.first, s.last, CASE WHEN pos % 3 = 0 THEN NULL WHEN o.grp % 3 = 0 THEN 'u' || o.code || o.term || (start + 26)::VARCHAR WHEN o.grp % 3 = 1 THEN 'u' || o.code ELSE 'same' END AS url
  FROM o JOIN s ON s.id = o.person)
"""


def course_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations as course rows of the years from 2020-21 on: labs, theses, quoted names, links of periods, of codes or of a whole college, and instructors."""
    s = named(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey").select(F.col("id").alias("person"), "first", "last")
    o, pos = observations(spark, sf_dir).join(s, "person"), F.col("pos")
    lab, start = pos % 7 == 0, F.col("start") + 26
    code = F.concat(F.when(F.col("code").startswith("PROM"), "").otherwise("C"), "code", F.when(lab, "L").otherwise(""))
    name = F.concat(F.when(pos % 6 == 5, "Senior Thesis: ").otherwise(""), "name", F.when(lab, " Lab").otherwise(""))
    group = F.col("grp") % 3
    url = F.when(pos % 3 == 0, " ").when(group == 0, F.concat(F.lit("u"), "code", "term", start.cast("string"))).when(group == 1, F.concat(F.lit("u"), "code")).otherwise("same")
    return o.select(
        F.col("grp").cast("string").alias("college"), X.academic_year(start).alias("academic_year"), "term", F.concat(F.lit(" "), code).alias("course_code"), F.lit("").alias("section"),
        F.when(pos % 2 == 0, F.concat(F.lit('"'), name, F.lit('" '))).otherwise(name).alias("course_name"), F.concat_ws(", ", "last", "first").alias("instructor"), F.lit("").alias("time"), url.alias("url"), "pos",
    )


@query(COURSE_ROWS + """
, inside AS (SELECT * FROM rows WHERE year >= '2021-22' AND term IN ('F', 'W', 'S')),
cut AS (SELECT max(left(year, 4)::INT) - 3 AS c FROM inside),
k AS (SELECT * FROM inside WHERE left(code, 1) = 'C' AND NOT thesis),
axis AS (SELECT DISTINCT college, year, term FROM k),
cells AS (SELECT college, code, year, term, arg_min(url, pos) FILTER (WHERE url IS NOT NULL) AS url FROM k GROUP BY 1, 2, 3, 4),
names AS (SELECT college, code, arg_max(name, (year, rank, -pos)) FILTER (WHERE NOT lab) AS name FROM k GROUP BY 1, 2),
stats AS (SELECT college, code, count(*) AS n, max(left(year, 4)::INT) AS last FROM cells GROUP BY 1, 2),
stay AS (SELECT s.college, s.code, name FROM stats s JOIN names USING (college, code), cut WHERE name IS NOT NULL AND NOT (n = 1 AND last < c) AND NOT EXISTS (SELECT 1 FROM stats b WHERE b.college = s.college AND b.code || 'L' = s.code)),
mine AS (SELECT cells.*, name FROM cells JOIN stay USING (college, code)),
modes AS (SELECT college, CASE WHEN max(n) >= 2 THEN 'term' WHEN any_value(every) <= 1 THEN 'none' ELSE 'code' END AS mode FROM (SELECT college, code, count(DISTINCT url) AS n FROM mine GROUP BY 1, 2) JOIN (SELECT college, count(DISTINCT url) AS every FROM mine GROUP BY 1) USING (college) GROUP BY 1),
links AS (SELECT college, code, max(url) AS link FROM mine GROUP BY 1, 2),
asked AS (SELECT DISTINCT k.college, k.code, k.year, k.term, lower(k.first) AS first, lower(k.last) AS last FROM k JOIN stay USING (college, code)),
known AS (SELECT id, grp, lower(first) AS first, lower(last) AS last FROM s),
scores AS (SELECT a.*, known.id, CASE WHEN known.first = a.first THEN 2 ELSE 0 END AS score FROM asked a JOIN known ON known.grp = a.college AND known.last = a.last),
tops AS (SELECT *, max(score) OVER w AS top, count(*) OVER w AS n FROM scores WINDOW w AS (PARTITION BY college, code, year, term, first, last)),
ties AS (SELECT *, count(*) OVER (PARTITION BY college, code, year, term, first, last) AS equal FROM tops WHERE score = top),
who AS (SELECT college, code, year, term, string_agg(DISTINCT 'p' || id, '|' ORDER BY 'p' || id) AS people FROM ties WHERE equal = 1 AND (top > 0 OR n = 1) GROUP BY 1, 2, 3, 4)
SELECT a.college::VARCHAR AS college, stay.code, stay.name, CASE WHEN mode = 'code' THEN link END AS url, a.year, a.term, m.code IS NOT NULL AS offered, CASE WHEN mode = 'term' THEN m.url END AS cell_url, who.people
FROM stay JOIN axis a USING (college) JOIN modes USING (college) JOIN links ON links.college = stay.college AND links.code = stay.code
LEFT JOIN mine m ON m.college = stay.college AND m.code = stay.code AND m.year = a.year AND m.term = a.term LEFT JOIN who ON who.college = stay.college AND who.code = stay.code AND who.year = a.year AND who.term = a.term
""")
def build_offerings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offering matrices of nations, a row for each cell, with links and the suppliers of the nation who teach."""
    s = named(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey")
    people = s.select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("person"), F.col("grp").cast("string").alias("college"), F.concat_ws(" ", "first", "last").alias("name"))
    out = jobs.build_offerings(course_rows(spark, sf_dir), people)
    missing = F.array_repeat(F.lit(None).cast("array<string>"), F.size("axis"))
    cells = out.select("college", "code", "name", "url", F.explode(F.arrays_zip("axis", "cells", F.coalesce("instructors", missing).alias("who"))).alias("z"))
    return cells.select("college", "code", "name", "url", F.col("z.axis.academic_year").alias("year"), "z.axis.term", F.col("z.cells.on").alias("offered"), F.col("z.cells.value").alias("cell_url"), F.array_join("z.who", "|").alias("people"))


@query(OBSERVATIONS + """
, r AS (SELECT DISTINCT grp::VARCHAR AS college, year AS academic_year, term, code AS course_code, name AS course_name FROM o),
old AS (SELECT * FROM r WHERE term <> 'W'), new AS (SELECT college, academic_year, term, course_code, 'New ' || course_name AS course_name FROM r WHERE term = 'F' AND college LIKE '1%' OR term = 'W')
SELECT *, '' AS section FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.college = old.college AND new.academic_year = old.academic_year AND new.term = old.term) UNION ALL SELECT *, '' AS section FROM new
""")
def merge_offerings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Course rows of an old table with those of some colleges' terms replaced, and terms that the old table lacks."""
    r = observations(spark, sf_dir).select(F.col("grp").cast("string").alias("college"), F.col("year").alias("academic_year"), "term", F.col("code").alias("course_code"), F.col("name").alias("course_name"))
    new = r.where("term = 'F' and college like '1%' or term = 'W'").withColumn("course_name", F.concat(F.lit("New "), "course_name"))
    return jobs.merge_offerings(r.where("term <> 'W'"), new, ["college", "academic_year", "term", "course_code", "course_name", "section"])


@query("""
WITH f AS (SELECT c_nationkey, c_custkey, c_name, CASE c_mktsegment WHEN 'BUILDING' THEN 'tenured' WHEN 'MACHINERY' THEN 'visiting' ELSE 'tenure_track' END AS category, c_mktsegment, floor(c_acctbal)::INT AS cites FROM customer),
t AS (SELECT c_nationkey, count(*)::BIGINT AS members, count(*) FILTER (WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))::BIGINT AS trusted, sum(cites)::BIGINT AS total FROM f GROUP BY 1),
p AS (SELECT c_nationkey, count(*)::BIGINT AS papers, count(*) FILTER (WHERE o_orderkey % 2 = 0)::BIGINT AS placed FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT n_name AS college, CASE WHEN n_regionkey = 0 THEN NULL ELSE r_name END AS state, members, trusted, total, c_name AS name, category, coalesce(papers, 0)::BIGINT AS papers, coalesce(placed, 0)::BIGINT AS placed, 0::BIGINT AS courses
FROM nation JOIN region ON n_regionkey = r_regionkey JOIN t ON t.c_nationkey = n_nationkey JOIN f ON f.c_nationkey = n_nationkey LEFT JOIN p ON p.c_nationkey = n_nationkey
""")
def build_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document for each nation with its customers and their orders; a row for each person, to compare."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    colleges = n.select(F.col("n_name").alias("college"), F.when(F.col("n_regionkey") == 0, "").otherwise(F.col("r_name")).alias("state"))
    c = table(spark, sf_dir, "customer").join(n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("college")), "c_nationkey")
    title = F.when(F.col("c_mktsegment") == "BUILDING", "Professor").when(F.col("c_mktsegment") == "MACHINERY", "Visiting Professor").otherwise("")
    status = F.when(F.col("c_mktsegment") == "BUILDING", "matched").when(F.col("c_mktsegment") == "MACHINERY", "manual_approved").otherwise("no_match")
    faculty = c.select("college", F.col("c_custkey").alias("pos"), F.col("c_name").alias("name"), title.alias("title"), status.alias("status"), F.floor("c_acctbal").cast("int").alias("citations"))
    papers = table(spark, sf_dir, "orders").join(c.select(F.col("c_custkey").alias("o_custkey"), "college"), "o_custkey").select("college", F.col("o_orderkey").alias("pos"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise("").alias("venue"))
    courses = spark.createDataFrame([], "college string, pos long, name string")
    d = jobs.build_directory(colleges, faculty, papers, courses)
    size = lambda c: F.greatest(F.size(c), F.lit(0)).cast("long")
    # Papers are counted before people become rows, so no person's row carries all papers of the college.
    counted = d.where("members > 0").select("college", "state", "members", "trusted", "total", "faculty", size("publications").alias("papers"), size(F.filter("publications", lambda p: p["venue"].isNotNull())).alias("placed"), size("courses").alias("courses"))
    return counted.select("college", "state", "members", "trusted", "total", F.explode("faculty").alias("f"), "papers", "placed", "courses").select("college", "state", "members", "trusted", "total", "f.name", "f.category", "papers", "placed", "courses")


#: Searches, each with what it is there for: a name, a college or its region, a paper's venue, an outside author, a course, interests, and words that find nothing.
SEARCHES = (("berg", "A"), ("NATION_3", "america"), ("venue 7", "urgent"), ("gomez", "ada", "nation_1"), ("widget", "c1"), ("rings", "elena"), ("no such", "word"))
#: Facets of papers that the searches leave out or ask for.
YEARS, HIDDEN, TOPICS, NOT_TOPICS = (1994, None), (("journal", "Q4"), ("other", "preprint")), ("T0", "T1", "T2"), ("T9",)
FACETS = {"years": YEARS, "exclude": HIDDEN, "subfields": TOPICS, "not_subfields": NOT_TOPICS}

SEARCH_SQL = f"""
WITH {SUPPLIERS},
words AS (SELECT unnest([{", ".join(str(n) for n in range(len(SEARCHES)))}]) AS n, unnest({[[w.lower() for w in some] for some in SEARCHES]}) AS ws),
college AS (SELECT n_nationkey AS grp, n_name AS college, lower(n_name || ' ' || r_name) AS text FROM nation JOIN region ON n_regionkey = r_regionkey),
every AS (SELECT s.id, s.grp, first || ' ' || last AS name, s_acctbal FROM s JOIN supplier ON s_suppkey = s.id),
person AS (SELECT 's' || e.id AS id, e.id AS pos, grp, college, name, CASE WHEN e.id % 3 = 0 THEN '' ELSE 'Professor' END AS title, CASE WHEN e.id % 4 = 0 THEN 'Bergs and rings' ELSE 'gears' END AS interests FROM every e JOIN college USING (grp) WHERE s_acctbal > 3000),
latest AS (SELECT grp, name, arg_max(id, pos) AS id FROM person GROUP BY 1, 2),
latest_lower AS (SELECT grp, lower(name) AS name, arg_max(id, pos) AS id FROM person GROUP BY 1, 2),
wrote AS (SELECT DISTINCT l_orderkey AS k, l_suppkey AS sid, grp, name, s_acctbal > 3000 AS own FROM lineitem JOIN every ON every.id = l_suppkey),
paper AS (
  SELECT 'W' || k || '@' || grp AS id, k, grp, CASE WHEN k % 11 = 0 THEN '' ELSE 'On ' || o_orderpriority || ' ' || (k % 200) END AS title, CASE WHEN k % 5 = 0 THEN NULL ELSE 'Venue ' || (k % 30) END AS venue, year(o_orderdate) AS year,
         CASE k % 3 WHEN 0 THEN 'conference' WHEN 1 THEN 'journal' ELSE CASE k % 4 WHEN 0 THEN 'book' WHEN 1 THEN 'preprint' ELSE 'report' END END AS pub_type, CASE WHEN k % 3 < 2 THEN 'Q' || (k % 4 + 1) END AS ranking
  FROM (SELECT DISTINCT k, grp FROM wrote WHERE own) JOIN orders ON o_orderkey = k),
shown AS (SELECT * FROM paper WHERE year >= {YEARS[0]} AND NOT (pub_type = 'journal' AND ranking = 'Q4') AND NOT pub_type = 'preprint' AND k % 7 > 0 AND k % 10 < 9 AND (k % 4 < 3 OR k % 10 < 3)),
course AS (SELECT 'c' || p_partkey AS id, e.grp, 'C' || p_size AS code, p_name AS name, e.name AS teacher FROM part JOIN every e ON e.id = p_partkey % (SELECT count(*) FROM supplier) + 1),
all_in AS (SELECT len(list_filter(ws, lambda w: NOT contains(college.text, w))) = 0 AS hit, n, grp, college FROM college, words),
hit_college AS (SELECT n, grp, college FROM all_in WHERE hit),
hit_name AS (SELECT n, p.id, p.grp, p.name FROM person p, words WHERE len(list_filter(ws, lambda w: NOT contains(lower(p.name), w))) = 0),
hit_interest AS (SELECT n, p.id, p.grp FROM person p, words WHERE len(list_filter(ws, lambda w: NOT contains(lower(concat_ws(' ', p.name, nullif(p.title, ''), p.interests, p.college)), w))) = 0 AND (n, p.id) NOT IN (SELECT (n, id) FROM hit_name)),
hit_title AS (SELECT n, p.id, p.k, p.grp FROM shown p, words WHERE len(list_filter(ws, lambda w: NOT contains(lower(concat_ws(' ', nullif(p.title, ''), p.venue)), w))) = 0),
-- Names and affiliations of authors are few, so they are searched once each.
author AS (SELECT n, w.grp AS author_grp, w.name FROM (SELECT DISTINCT grp, name FROM wrote) w JOIN college c USING (grp), words WHERE len(list_filter(ws, lambda x: NOT contains(lower(w.name || ' ' || c.college), x))) = 0),
own_name AS (SELECT n, w.name FROM (SELECT DISTINCT name FROM wrote WHERE own) w, words WHERE len(list_filter(ws, lambda x: NOT contains(lower(w.name), x))) = 0),
hit_author AS (SELECT DISTINCT a.n, p.id, p.grp FROM shown p JOIN wrote w ON w.k = p.k JOIN author a ON a.author_grp = w.grp AND a.name = w.name
  WHERE NOT EXISTS (SELECT 1 FROM wrote m JOIN own_name o ON o.name = m.name WHERE m.k = p.k AND m.grp = p.grp AND m.own AND o.n = a.n)),
hit_course AS (SELECT n, c.* FROM course c, words WHERE len(list_filter(ws, lambda w: NOT contains(lower(c.code || ' ' || c.name), w))) = 0),
paths AS (
  SELECT n, 'college' AS kind, college AS id, 'college' AS path FROM hit_college
  UNION SELECT n, 'person', p.id, 'member' FROM hit_college JOIN person p USING (grp) UNION SELECT n, 'paper', p.id, 'member' FROM hit_college JOIN shown p USING (grp) UNION SELECT n, 'course', c.id, 'member' FROM hit_college JOIN course c USING (grp)
  UNION SELECT n, 'person', id, 'name' FROM hit_name UNION SELECT n, 'person', id, 'interests' FROM hit_interest UNION SELECT n, 'paper', id, 'title' FROM hit_title UNION SELECT n, 'paper', id, 'author' FROM hit_author UNION SELECT n, 'course', id, 'course' FROM hit_course
  UNION SELECT h.n, 'paper', p.id, 'by person' FROM hit_name h JOIN latest_lower l ON l.id = h.id JOIN wrote w ON w.own AND w.grp = l.grp AND lower(w.name) = l.name JOIN shown p ON p.k = w.k AND p.grp = w.grp
  UNION SELECT h.n, 'course', c.id, 'taught by person' FROM hit_name h JOIN latest l ON l.id = h.id JOIN course c ON c.grp = l.grp AND c.teacher = l.name
  UNION SELECT h.n, 'person', l.id, 'of a paper' FROM hit_title h JOIN wrote w ON w.own AND w.k = h.k AND w.grp = h.grp JOIN latest l ON l.grp = w.grp AND l.name = w.name
  UNION SELECT h.n, 'person', l.id, 'of a course' FROM hit_course h JOIN latest l ON l.grp = h.grp AND l.name = h.teacher
  UNION SELECT n, 'college', college, 'inside' FROM (SELECT n, grp FROM hit_name UNION SELECT n, grp FROM hit_interest UNION SELECT n, grp FROM hit_title UNION SELECT n, grp FROM hit_author UNION SELECT n, grp FROM hit_course) JOIN college USING (grp))
SELECT n::INT AS search, kind, id, array_to_string(list_sort(list(DISTINCT path)), '|') AS paths FROM paths GROUP BY 1, 2, 3
"""


def directory(spark: SparkSession, sf_dir: str, **facets: object) -> Q.Directory:
    """Nations as colleges in regions, suppliers in good standing as people, orders (which the facets show) as a row for each nation of their people with all authors, parts as courses."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    colleges = n.select(F.col("n_name").alias("college"), F.col("r_name").alias("state"))
    s = named(table(spark, sf_dir, "supplier"), "s_suppkey", "s_nationkey").join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), "s_acctbal"), "id")
    every = s.join(n.select(F.col("n_nationkey").alias("grp"), F.col("n_name").alias("college")), "grp").select("id", "grp", "college", F.concat_ws(" ", "first", "last").alias("name"), (F.col("s_acctbal") > 3000).alias("own"))
    sid = F.col("id").cast("string")
    faculty = every.where("own").select(
        F.concat(F.lit("s"), sid).alias("id"), "college", "name", F.when(F.col("id") % 3 == 0, "").otherwise("Professor").alias("title"),
        F.when(F.col("id") % 4 == 0, "Bergs and rings").otherwise("gears").alias("interests"), F.col("id").alias("pos"),
    )
    wrote = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("id")).join(J.small(every, 500_000), "id")
    # A row for each college of the paper's people, with its own people; all authors beside it. Each paper's authors meet once.
    by_paper = wrote.groupBy("k").agg(F.collect_set(F.struct("grp", "college", "name", "own")).alias("w"))
    own = F.filter("w", lambda x: x["own"])
    homes = F.array_distinct(F.transform(own, lambda x: F.struct(x["grp"].alias("grp"), x["college"].alias("college"))))
    authors = F.array_distinct(F.transform("w", lambda x: F.struct(x["name"].alias("name"), x["college"].alias("affiliation"))))
    rows = by_paper.select("k", authors.alias("authors"), own.alias("own"), F.explode(homes).alias("home")).select(
        "k", "home.grp", "home.college", F.array_distinct(F.transform(F.filter("own", lambda x: x["grp"] == F.col("home.grp")), lambda x: x["name"])).alias("matched"), "authors"
    )
    k = F.col("k")
    kind = F.when(k % 3 == 0, "conference").when(k % 3 == 1, "journal").when(k % 4 == 0, "book").when(k % 4 == 1, "preprint").otherwise("report")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority", F.year("o_orderdate").alias("year"))
    publications = rows.join(o, "k").select(
        F.concat(F.lit("W"), k.cast("string"), F.lit("@"), F.col("grp").cast("string")).alias("id"), "college",
        F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("On "), "o_orderpriority", F.lit(" "), (k % 200).cast("string"))).alias("title"),
        F.when(k % 5 != 0, F.concat(F.lit("Venue "), (k % 30).cast("string"))).alias("venue"), "year", kind.alias("pub_type"),
        F.when(k % 3 < 2, F.concat(F.lit("Q"), (k % 4 + 1).cast("string"))).alias("ranking"),
        # Some have no topics, some one that is left out.
        F.when(k % 7 > 0, F.array(F.concat(F.lit("T"), (k % 4).cast("string")), F.concat(F.lit("T"), (k % 10).cast("string")))).alias("subfields"), "matched", "authors",
    )
    # Texts, edges and facets all come from these rows, which are joined once.
    publications = S.staged(Q.shown_publications(publications, **facets), "directory-papers")
    people = table(spark, sf_dir, "supplier").count()
    teacher = every.select(F.col("id").alias("teacher"), "college", F.array("name").alias("instructors"))
    courses = table(spark, sf_dir, "part").withColumn("teacher", F.col("p_partkey") % people + 1).join(teacher, "teacher").select(F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("id"), "college", F.concat(F.lit("C"), F.col("p_size").cast("string")).alias("code"), F.col("p_name").alias("name"), "instructors")
    return Q.directory(colleges, faculty, publications, courses)


def _searches(d: Q.Directory, **facets: object) -> DataFrame:
    return Q.search_each(d, SEARCHES, **facets).select("search", "kind", "id", F.array_join("paths", "|").alias("paths"))


@query(SEARCH_SQL)
def search_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What several searches find by one look through all texts: by college and region, name, interests, title and venue, outside author and course, under facets, with what hits lead to."""
    return _searches(directory(spark, sf_dir, **FACETS))


@query(SEARCH_SQL)
def search_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same searches over a written directory, whose postings of trigrams say which texts to look into."""
    path = f"{S.shared_dir(spark)}/directory-{uuid.uuid4().hex}"
    Q.write_directory(directory(spark, sf_dir), path)
    return _searches(Q.read_directory(spark, path), **FACETS)


@query("""
SELECT p_partkey AS doc, 3 AS pos, 'CS ' || p_size || ' ' || p_name AS heading, 'Intro MWF 9:00-9:50 am Hall ' || p_size || ' Berg,Ada goes on ' || p_type AS line, 'MWF' AS days, '9:00-9:50 am' AS time, 'Berg,Ada' AS person FROM part
UNION ALL SELECT p_partkey, 5, 'CS ' || p_size || ' ' || p_name, 'More TR 1:00-2:15 pm ' || p_brand, 'TR', '1:00-2:15 pm', NULL FROM part WHERE p_partkey % 2 = 0
""")
def sectionise_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as line dumps: records inside a section, under their heading, with continuations folded in."""
    p, size = table(spark, sf_dir, "part"), F.col("p_size").cast("string")
    text = lambda *parts: F.concat(*[x if not isinstance(x, str) or x.startswith("p_") else F.lit(x) for x in parts])
    dump = [
        F.lit("before 8:00-8:50"), F.lit("COMPUTING"), text("CS ", size, " ", "p_name"), text("Intro MWF 9:00-9:50 am Hall ", size, " Berg,Ada"), text("goes on ", "p_type"),
        F.when(F.col("p_partkey") % 2 == 0, text("More TR 1:00-2:15 pm ", "p_brand")).otherwise(F.lit("MATH")), F.lit("MATH"), F.lit("MA 1 Sums"), F.lit("after M 3:00-3:50 pm"),
    ]
    lines = p.select(F.col("p_partkey").alias("doc"), F.posexplode(F.array(*dump)).alias("pos", "line"))
    out = jobs.sectionise_lines(lines, "^COMPUTING$", "^MATH$", r"^CS \d", r"\d:\d\d")
    return out.select("doc", "pos", "heading", "line", "at.days", "at.time", "at.person")
