"""Web pages: text, cells, links and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields as X
from ..functions import text as T
from ..operators import aggregates as A
from ..operators import filters as P
from ..operators import joins as J
from ..sources import markup, web
from .registry import query, table


#: SQL of web.visible_text over the column html, for pages like those of the tables, which hide nothing by an attribute.
_SPACE = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_SHOWN = "regexp_replace(regexp_replace(html, '(?is)<!--.*?-->|" + "|".join(rf"<{t}\b.*?</{t}\s*>" for t in ("script", "style", "noscript", "template", "head")) + "', '', 'g'), '<[^>]+>', chr(10), 'g')"
_UNESCAPED = "x"
for _name, _char in {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "''", "&copy;": "©", "&middot;": "·", "&amp;": "&"}.items():
    _UNESCAPED = f"replace({_UNESCAPED}, '{_name}', '{_char}')"
VISIBLE = f"CASE WHEN regexp_matches(html, '(?i)<body') THEN array_to_string(list_filter(list_transform(string_split({_SHOWN}, chr(10)), lambda x: trim(regexp_replace({_UNESCAPED}, '{_SPACE}', ' ', 'g'))), lambda x: x <> ''), chr(10)) END"


@query(r"""
SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^www\.', '') AS host,
       regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^www\.', '') || regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1), '/index\.html?$', ''), '/$', ''), '/[^/]*$', '') AS grp,
       regexp_extract(url, '([^/]*)$', 1) AS last FROM pages
""")
def url_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", X.host(u).alias("host"), X.page_group(u).alias("grp"), X.last_segment(u).alias("last"))


#: Pairs of a group's first page (a) and another one (b): their lines without the header and footer that they share, and whether they share any.
PAIRS = """
, cut AS (
  SELECT *, a[2:6] AS ha, b[2:6] AS hb, list_reverse(a) AS ra, list_reverse(b) AS rb FROM pairs),
found AS (
  SELECT *, len(list_filter(range(1, len(b) - 3), lambda i: b[i:i+4] = ha)) > 0 AS h_ab, len(list_filter(range(1, len(a) - 3), lambda i: a[i:i+4] = hb)) > 0 AS h_ba,
         len(list_filter(range(1, len(b) - 3), lambda i: rb[i:i+4] = ra[1:5])) > 0 AS f_ab, len(list_filter(range(1, len(a) - 3), lambda i: ra[i:i+4] = rb[1:5])) > 0 AS f_ba FROM cut),
spots AS (
  SELECT *, CASE WHEN NOT h_ab AND h_ba THEN coalesce(list_min(list_filter(range(2, len(a) + 1), lambda i: a[i] = b[2])), len(a) + 1) ELSE 2 END AS i,
         CASE WHEN h_ab THEN coalesce(list_min(list_filter(range(2, len(b) + 1), lambda i: b[i] = a[2])), len(b) + 1) ELSE 2 END AS j,
         CASE WHEN NOT f_ab AND f_ba THEN coalesce(list_min(list_filter(range(1, len(a) + 1), lambda i: ra[i] = rb[1])), len(a) + 1) ELSE 1 END AS fi,
         CASE WHEN f_ab THEN coalesce(list_min(list_filter(range(1, len(b) + 1), lambda i: rb[i] = ra[1])), len(b) + 1) ELSE 1 END AS fj FROM found),
runs AS (
  SELECT *, CASE WHEN h_ab OR h_ba THEN coalesce(list_min(list_filter(range(0, least(len(a) - i, len(b) - j) + 1), lambda k: a[i + k] <> b[j + k])), least(len(a) - i, len(b) - j) + 1) ELSE 0 END AS top,
         CASE WHEN f_ab OR f_ba THEN coalesce(list_min(list_filter(range(0, least(len(a) - fi, len(b) - fj) + 1), lambda k: ra[fi + k] <> rb[fj + k])), least(len(a) - fi, len(b) - fj) + 1) ELSE 0 END AS bottom FROM spots),
usable AS (
  SELECT *, len(a) >= 10 AND len(b) >= 10 AND (h_ab OR h_ba OR f_ab OR f_ba) AND NOT (i - 1 + top >= len(a) OR j - 1 + top >= len(b)) AS ok FROM runs),
trimmed AS (
  SELECT *, CASE WHEN ok THEN a[i + top : len(a) - CASE WHEN f_ab OR f_ba THEN fi - 1 + bottom ELSE 0 END] END AS ref_lines,
         CASE WHEN NOT ok THEN own ELSE b[j + top : len(b) - CASE WHEN f_ab OR f_ba THEN fj - 1 + bottom ELSE 0 END] END AS lines FROM usable)
"""


LINKS = r"""
WITH l AS (SELECT page_id, url, html, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link, unnest(range(len(regexp_extract_all(html, 'href="([^"]*)"', 1)))) AS i FROM pages),
w AS (SELECT *, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS host, regexp_extract(url, '^https?://[^/?#]+/([^/?#]+)', 1) AS seg, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/[^/]*$', '') AS folder FROM l)
"""


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, html, i, link: the links of pages, in turns as they are, whole, without scheme, relative, from the first folder on, to mail and to a picture."""
    first = F.regexp_extract("url", "^https?://[^/?#]+/([^/?#]+)", 1)
    found = table(spark, sf_dir, "pages").select("page_id", "url", "html", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("i", "raw"))
    kinds = ["raw", F.concat(F.lit("https://o.example"), "raw"), F.concat(F.lit("//o.example"), "raw"), F.concat(F.lit("x"), "raw"), F.concat(first, "raw"), F.concat(F.lit("mailto:a@x.example?"), "raw"), F.concat("raw", F.lit(".png"))]
    return found.withColumn("link", F.element_at(F.array(*kinds), ((F.col("i") + F.col("page_id")) % 7 + 1).cast("int")))


@query(LINKS + """
SELECT page_id, i::INT AS i, CASE (i + page_id) % 7 WHEN 0 THEN host || link WHEN 1 THEN 'https://o.example' || link WHEN 2 THEN regexp_extract(url, '^([a-z]+:)', 1) || '//o.example' || link WHEN 3 THEN folder || '/x' || link ELSE host || '/' || seg || link END AS whole
FROM w WHERE (i + page_id) % 7 < 5
""")
def absolutise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages as whole URLs; those to mail and pictures go."""
    kept = links(spark, sf_dir).where(X.page_link(F.col("link")).isNotNull())
    return kept.select("page_id", "i", X.absolute_url(F.col("url"), F.col("link")).alias("whole"))


@query(LINKS + r"""
, n AS (SELECT page_id, list_filter(string_split(lower(strip_accents(regexp_extract(any_value(html), '<h1>(.*?)</h1>', 1))), ' '), lambda t: length(t) >= 3) AS parts FROM w GROUP BY 1)
SELECT page_id, arg_min(link, (NOT coalesce(list_bool_or(list_transform(parts, lambda p: contains(lower(link), p))), false), length(link), i)) AS best FROM w JOIN n USING (page_id) GROUP BY 1
""")
def best_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shortest link that holds a word of the page's heading, else the shortest."""
    found = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    heading = F.regexp_extract("html", "<h1>(.*?)</h1>", 1)
    return table(spark, sf_dir, "pages").withColumn("links", found).where(F.size("links") > 0).select("page_id", X.best_link(F.col("links"), heading).alias("best"))


@query(r"""
WITH t AS (SELECT page_id, unnest(range(len(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1))))::INT AS pos, unnest(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1)) AS cell FROM pages)
SELECT page_id, pos, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(cell, '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS cell FROM t
""")
def html_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list items of every page, as text."""
    return web.cells(table(spark, sf_dir, "pages"), "page_id", "html", r"(?is)<li[^>]*>(.*?)</li>")


@query(f"SELECT page_id, {VISIBLE} AS text FROM pages")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page, a line for each text node."""
    return table(spark, sf_dir, "pages").select("page_id", web.visible_text(F.col("html")).alias("text"))


@query(f"""
WITH v AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN html WHEN 1 THEN replace(html, '<article>', '<noscript>Please turn on JavaScript</noscript><article>') WHEN 2 THEN '<body><div id="root"> </div>' || html
  WHEN 3 THEN '<body>' || repeat('<script src=a></script>', 5) || left(regexp_extract(html, '<h1>(.*?)</h1>', 1), 250) WHEN 4 THEN '<body>' || left(html, 100) ELSE NULL END AS html FROM pages),
t AS (SELECT page_id, html, length(coalesce({VISIBLE}, '')) AS n FROM v)
SELECT page_id, CASE WHEN html IS NULL OR html = '' THEN 'no html' WHEN page_id % 6 = 1 AND contains(html, '<noscript>') THEN 'needs scripts' WHEN page_id % 6 = 2 THEN 'empty app root'
  WHEN len(regexp_extract_all(html, '(?i)<script')) >= 5 AND n < 300 THEN 'many scripts, little text' WHEN n < 200 THEN 'little text' ELSE 'ok' END AS reason FROM t
""")
def page_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a page would give no text, by the length of its visible text; pages as they are, with a noscript note, an empty root, scripts alone, cut, and missing."""
    html, heading = F.col("html"), F.regexp_extract("html", "<h1>(.*?)</h1>", 1)
    kinds = [
        html, F.replace(html, F.lit("<article>"), F.lit("<noscript>Please turn on JavaScript</noscript><article>")), F.concat(F.lit('<body><div id="root"> </div>'), html),
        F.concat(F.lit("<body>" + "<script src=a></script>" * 5), F.substring(heading, 1, 250)), F.concat(F.lit("<body>"), F.substring(html, 1, 100)), F.lit(None).cast("string"),
    ]
    pages = table(spark, sf_dir, "pages").select("page_id", F.element_at(F.array(*kinds), (F.col("page_id") % 6 + 1).cast("int")).alias("html"))
    return pages.select("page_id", P.page_gate(F.col("html"), F.length(F.coalesce(web.visible_text(F.col("html")), F.lit("")))).alias("reason"))


@query(rf"""
WITH l AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^www\.', '') AS host, string_split({VISIBLE}, chr(10)) AS own FROM pages),
g AS (SELECT host, min(page_id) AS first, arg_min(own, page_id) AS ref FROM l WHERE own IS NOT NULL GROUP BY 1),
pairs AS (SELECT l.*, ref AS a, own AS b FROM l JOIN g USING (host) WHERE own IS NOT NULL AND page_id <> first) {PAIRS},
firsts AS (SELECT host, arg_min(ref_lines, page_id) AS lines FROM trimmed WHERE ok GROUP BY 1)
SELECT page_id, host, array_to_string(lines, chr(10)) AS text FROM trimmed
UNION ALL SELECT g.first, g.host, array_to_string(coalesce(firsts.lines, g.ref), chr(10)) FROM g LEFT JOIN firsts USING (host)
""")
def header_footer_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a host without the lines that they share with its first page at top and bottom; the first one as compared with the first that shares any."""
    p = table(spark, sf_dir, "pages").select("page_id", X.host(F.col("url")).alias("host"), F.split(web.visible_text(F.col("html")), "\n").alias("lines")).where("lines is not null")
    return J.trim_shared_edges(p, "host", "page_id", "lines").select("page_id", "host", F.array_join("lines", "\n").alias("text"))


@query(r"""
WITH g AS (SELECT regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1) AS host, regexp_extract(url, '^[a-zA-Z]+://[^/]+/([^/?#]*)', 1) AS seg, count(*) AS n FROM pages GROUP BY 1, 2)
SELECT regexp_replace(lower(host), '^www\.', '') AS host, seg, n::BIGINT AS n FROM (SELECT *, rank() OVER (PARTITION BY regexp_replace(lower(host), '^www\.', '') ORDER BY n DESC) AS r FROM (SELECT host, seg, sum(n) AS n FROM g GROUP BY 1, 2)) WHERE r = 1 AND n >= 2
""")
def largest_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest first folder or folders of each host."""
    p = table(spark, sf_dir, "pages").select(X.host(F.col("url")).alias("host"), F.regexp_extract(X.path(F.col("url")), "^/([^/]*)", 1).alias("seg"))
    return A.largest_groups(p, "host", "seg")


@query(r"""SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) <> '' AS titled, length(regexp_replace(html, '<[^>]+>', '', 'g'))::INT AS chars FROM pages""")
def tag_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a title, and their characters outside of tags."""
    return table(spark, sf_dir, "pages").select("page_id", (F.regexp_extract("html", "<title>(.*?)</title>", 1) != "").alias("titled"), F.length(F.regexp_replace("html", "<[^>]+>", "")).alias("chars"))


_LIST = "list_transform(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1), lambda x: trim(regexp_replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'), '\\s+', ' ', 'g')))"


def _tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose list items stand in a table inside a table: cells that span, rows and cells without end tags, a hidden row, a script."""
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract_all("html", F.lit("(?is)<li[^>]*>(.*?)</li>"), 1).alias("items"))
    inner = F.array_join(F.transform("items", lambda x, i: F.concat(F.lit("<tr><td>"), x, F.lit("<td>n"), i.cast("string"))), "")
    key = F.col("page_id").cast("string")
    html = F.concat(
        F.lit("<body><table><tr><th colspan=2>Head</th><th rowspan='3'>Side</th></tr><tr hidden><td>gone<table><tr><td>gone</table></tr><tr><td>A<td>B<tr><td>"), key, F.lit("</td><td>at <b>once</b> <table class=\"<td>\">"), inner,
        F.lit("</table> after</td><td>end</td></tr></table><script>var x = '<table><tr><td>no</td></tr></table>'</script><table><tr><td>last"),
    )
    return p.select("page_id", html.alias("html"))


@query(f"""
WITH p AS (SELECT page_id, {_LIST} AS items FROM pages),
i AS (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS n FROM p),
whole AS (SELECT page_id, trim(regexp_replace('at once ' || coalesce(string_agg(item || ' n' || n, ' ' ORDER BY n), '') || ' after', '\\s+', ' ', 'g')) AS text FROM p LEFT JOIN i USING (page_id) GROUP BY 1)
SELECT page_id, 0 AS "table", 0 AS "row", 'Head|Head|Side' AS cells FROM p UNION ALL SELECT page_id, 0, 1, 'A|B|Side' FROM p
UNION ALL SELECT page_id, 0, 2, page_id || '|' || text || '|Side|end' FROM whole UNION ALL SELECT page_id, 1, n, item || '|n' || n FROM i
UNION ALL SELECT page_id, 2, 0, 'last' FROM p
""")
def table_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of nested tables, with spanning cells in every column that they cover."""
    out = markup.grid(markup.tables(_tables(spark, sf_dir), "page_id", "html"), "page_id")
    return out.select("page_id", "table", "row", F.array_join("cells", "|").alias("cells"))


@query(f"""
WITH p AS (SELECT page_id, {_LIST} AS items FROM pages), i AS (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS n FROM p)
SELECT page_id, 2 AS "row", 1 AS "col", string_agg(CASE WHEN item <> '' THEN item || ' ' ELSE '' END || 'n' || n, '; ' ORDER BY n) AS joined FROM i GROUP BY 1
""")
def nested_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What tables inside cells hold, row by row in one text."""
    return markup.inner_rows(markup.tables(_tables(spark, sf_dir), "page_id", "html"), "page_id").select("page_id", "row", "col", "joined")


@query(f"SELECT page_id, {VISIBLE} AS text FROM (SELECT page_id, replace(html, '<article>', '<article><a>link</a> <p>shown</p>') AS html FROM pages)")
def hidden_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of pages with hidden parts that nest, links and classes that only speak of hiding, and an input that is hidden."""
    more = "<article><div hidden><div>a</div>b<br>c</div><p style=\"color: red; DISPLAY : none\"><b>d</b></p><a href=\"/hidden/x\" title=\"a > b\">link</a><input type=hidden><p class=hidden aria-hidden=true>shown</p><!-- <p>e</p> -->"
    pages = table(spark, sf_dir, "pages").select("page_id", F.replace("html", F.lit("<article>"), F.lit(more)).alias("html"))
    return pages.select("page_id", markup.visible_text(F.col("html")).alias("text"))
