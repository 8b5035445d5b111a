"""Lines in order: conversations by turn, documents by line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields as X
from ..functions import constants as K
from ..operators import aggregates as A
from ..operators import filters as P
from ..operators import ordered as O
from .registry import query, table


@query("""
SELECT conv_id, turn, (SELECT max(turn) FROM conversations b WHERE b.conv_id = a.conv_id AND b.turn <= a.turn AND role = 'user')::BIGINT AS heading FROM conversations a
""")
def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last user turn up to each turn."""
    c = table(spark, sf_dir, "conversations")
    return O.carry_forward(c, "conv_id", "turn", F.col("role") == "user", heading=F.col("turn")).select("conv_id", "turn", "heading")


@query("""
SELECT conv_id, turn FROM (SELECT *, max(CASE WHEN turn % 4 = 0 THEN turn END) OVER w AS s, max(CASE WHEN turn % 4 = 3 THEN turn END) OVER w AS e FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
WHERE s > coalesce(e, -1) AND turn % 4 NOT IN (0, 3)
""")
def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns between a start and a stop."""
    return O.section(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.col("turn") % 4 == 0, F.col("turn") % 4 == 3).select("conv_id", "turn")


@query("""
WITH h AS (SELECT *, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS head FROM conversations)
SELECT conv_id, head, string_agg(role, '; ' ORDER BY f) AS role, sum(n)::BIGINT AS rows FROM (SELECT conv_id, head, role, min(turn) AS f, count(*) AS n FROM h WHERE head IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2
""")
def fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that follow a user's join it."""
    return O.fold_continuations(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.col("role") == "user", "role")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


LINES = r"WITH l AS (SELECT doc_id, lang, unnest(range(len(string_split(text, chr(10)))))::INT AS pos, unnest(string_split(text, chr(10))) AS line FROM documents) "


@query(LINES + r"""
, n AS (SELECT lang, count(DISTINCT doc_id) AS pages FROM documents GROUP BY 1),
c AS (SELECT lang, trim(line) AS line, count(DISTINCT doc_id) AS df FROM l WHERE length(trim(line)) >= 3 GROUP BY 1, 2)
SELECT c.lang, c.line, c.df::BIGINT AS df FROM c JOIN n ON c.lang = n.lang WHERE pages >= 5 AND df >= greatest(2, floor(pages * 0.05))
""")
def boilerplate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that stand in a twentieth of a language's documents."""
    return A.frequent_lines(document_lines(spark, sf_dir), "lang", "doc_id", "line", share=0.05).select("lang", "line", "df")


NOISE = "|".join(f"(?:{p})" for p in K.NOISE_LINES).replace("'", "''")


@query(LINES + rf"""
SELECT doc_id, count(*)::BIGINT AS lines, count(*) FILTER (WHERE s = '' OR regexp_matches(s, '{NOISE}'))::BIGINT AS noise
FROM (SELECT doc_id, regexp_replace(lower(trim(line)), '[:.]+$', '') AS s FROM l) GROUP BY 1
""")
def noise_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and noise lines of each document."""
    return document_lines(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(P.is_noise_line(F.col("line"))).alias("noise"))


@query(LINES + r"""
, h AS (SELECT *, CASE WHEN contains(lower(line), 'thing') THEN pos END AS hit FROM l),
w AS (SELECT *, max(hit) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS near, max(hit) OVER (PARTITION BY doc_id) AS any_hit FROM h)
SELECT doc_id, count(*)::BIGINT AS kept FROM w WHERE near IS NOT NULL OR any_hit IS NULL GROUP BY 1
""")
def keyword_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines within three lines from a keyword on; documents without it stay whole."""
    hit = F.contains(F.lower("line"), F.lit("thing"))
    return O.near_hits(document_lines(spark, sf_dir), "doc_id", "pos", hit, 3).groupBy("doc_id").agg(F.count("*").alias("kept"))


@query("""
WITH f AS (SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2) SELECT user_id, event_type, event_id FROM f
""")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.first_per_key(table(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")


@query("""
SELECT event_id, event_type AS before, substr('MTWRFSU', isodow(ts)::INT, 1) AS days, strftime(ts, '%H') || ':00-' || strftime(ts, '%H') || ':50' AS time, 'Doe,U' || user_id AS person FROM events
""")
def anchored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written on one line and read around their time."""
    e = table(spark, sf_dir, "events")
    hour, day = F.date_format("ts", "HH"), F.substring(F.lit("MTWRFSU"), F.weekday("ts") + 1, F.lit(1))
    line = F.concat_ws(" ", "event_type", day, F.concat(hour, F.lit(":00-"), hour, F.lit(":50")), F.lit("Hall 3"), F.concat(F.lit("Doe,U"), "user_id"))
    return e.select("event_id", X.anchored(line).alias("a")).select("event_id", "a.before", "a.days", "a.time", "a.person")
