"""Search of a directory: words find texts, and what they find leads on over typed edges.

A directory is three tables: texts that can be found (a row for each node and field), edges between nodes and the facets of papers. For repeated
searches, each different text is kept once, with postings of its trigrams, and the rows of texts only say which one they hold. Nodes are written kind:id. One equi-join of the hits with the edges applies all rules at once;
which edges a hit may follow depends on the field that was hit:

    college or state    the college, all its people and courses and its shown papers
    a person's name     the person, their shown papers and their courses
    title or interests  the person alone, so that a common subject doesn't drag in all papers about it
    a paper's title, venue or acronym    the paper and its people
    another author      the paper alone; not looked at where the name of one of its people was hit
    a course            the course and its teachers

A blank text is never found. Papers that the facets hide neither count nor lead on. Colleges come with all that is found in them.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields as X
from ..operators import filters as P
from ..operators import tables as S

#: field that was hit -> (kind of edge that it follows, name of the path).
RULES = {
    "college": [("member", "member")],
    "name": [("wrote", "by person"), ("teaches", "taught by person")],
    "title": [("written by", "of a paper")],
    "course": [("taught by", "of a course")],
}
#: What publications may lack, with their types.
PAPER_FIELDS = {"venue": "string", "acronym": "string", "year": "int", "pub_type": "string", "ranking": "string", "subfields": "array<string>", "matched": "array<string>", "authors": "array<struct<name:string,affiliation:string>>"}
#: Letters of a gram; folders of the posting table; rarest grams of each word that are looked up.
GRAM, BUCKETS, RAREST = 3, 64, 2


@dataclass(frozen=True)
class Directory:
    """texts: node, field, part, college, text. edges: src, how, dst. papers: node, year, group, value, subfields.

    With postings, texts hold the id of their text instead of it. strings: tid, text. postings: bucket, gram, tid. grams: gram, n.
    """

    texts: DataFrame
    edges: DataFrame
    papers: DataFrame
    strings: DataFrame | None = None
    postings: DataFrame | None = None
    grams: DataFrame | None = None


def _node(kind: str, key: str = "id") -> Column:
    return F.concat(F.lit(f"{kind}:"), F.col(key).cast("string"))


def _filled(df: DataFrame, **types: str) -> DataFrame:
    """df with the columns that it lacks as nulls of their types."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns})


def _facets() -> dict[str, Column]:
    """year, group, value and subfields of a publication, as facets name them."""
    kind = F.col("pub_type")
    venue = kind.isin("conference", "journal")
    value = F.when(venue, F.coalesce("ranking", F.lit(""))).when(kind == "book", "other").otherwise(kind)
    return {"year": F.col("year"), "group": F.when(venue, kind).otherwise("other"), "value": value, "subfields": F.col("subfields")}


def directory(colleges: DataFrame, faculty: DataFrame, publications: DataFrame, courses: DataFrame) -> Directory:
    """The tables of a search.

    colleges: college, state (its code and name). faculty: id, college, name, title, interests, pos. publications: id (of a college's row), college,
    title, venue, acronym, year, pub_type, ranking, subfields, matched array<string>, authors array<struct<name,affiliation>>. courses: id, college, code, name,
    instructors array<string>. Columns other than ids, college and names may be missing. Of people with one name in a college the last listed has its papers and courses.
    """
    colleges = _filled(colleges, state="string").select(_node("college", "college").alias("node"), "college", "state")
    people = _filled(faculty, title="string", interests="string", pos="long").withColumn("node", _node("person"))
    papers = _filled(publications, **PAPER_FIELDS).withColumn("node", _node("paper"))
    taught = _filled(courses, code="string", instructors="array<string>").withColumn("node", _node("course"))

    def text(df: DataFrame, field: str, *columns: Column) -> DataFrame:
        return df.select("node", F.lit(field).alias("field"), F.lit(0).alias("part"), "college", X.search_text(*[F.nullif(c, F.lit("")) for c in columns]).alias("text"))

    def each(df: DataFrame, field: str, items: str, *columns: str) -> DataFrame:
        spread = df.select("node", "college", F.posexplode(items).alias("part", "item"))
        found = X.search_text(*[F.nullif(F.col(c), F.lit("")) for c in columns]) if columns else F.lower("item")
        return spread.select("node", F.lit(field).alias("field"), "part", "college", found.alias("text"))

    col = F.col
    texts = [
        text(colleges, "college", col("college"), col("state")), text(people, "name", col("name")), text(people, "interests", col("name"), col("title"), col("interests"), col("college")),
        text(papers, "title", col("title"), col("venue"), col("acronym")), each(papers, "matched", "matched"), each(papers, "author", "authors", "item.name", "item.affiliation"), text(taught, "course", col("code"), col("name")),
    ]

    named = people.where("coalesce(name, '') <> ''")
    by_name = named.groupBy("college", "name").agg(F.max_by("node", "pos").alias("person"))
    by_lower = named.groupBy("college", F.lower("name").alias("name")).agg(F.max_by("node", "pos").alias("person"))
    mentions = lambda df, items: df.select("college", "node", F.explode(F.array_distinct(items)).alias("name"))
    edge = lambda df, src, how, dst: df.select(F.col(src).alias("src"), F.lit(how).alias("how"), F.col(dst).alias("dst"))
    teachers = mentions(taught, col("instructors")).join(by_name, ["college", "name"])
    member = lambda df: df.select(_node("college", "college").alias("src"), F.lit("member").alias("how"), F.col("node").alias("dst"))
    edges = [
        member(people), member(papers), member(taught),
        edge(mentions(papers, F.transform("matched", F.lower)).join(by_lower, ["college", "name"]), "person", "wrote", "node"),
        edge(mentions(papers, col("matched")).join(by_name, ["college", "name"]), "node", "written by", "person"),
        edge(teachers, "person", "teaches", "node"), edge(teachers, "node", "taught by", "person"),
    ]
    facets = papers.select("node", *[c.alias(name) for name, c in _facets().items()])
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    return Directory(union(texts).where("text <> ''"), union(edges), facets)


def _bucket(gram: str) -> int:
    return zlib.crc32(gram.encode()) % BUCKETS


def _shelf(c: Column) -> Column:
    return (F.crc32(c.cast("binary")) % BUCKETS).cast("int")


def _near(df: DataFrame, nodes: DataFrame, node: str = "node") -> DataFrame:
    """df, of a stored table only the folders in which the nodes' rows lie (as many as BUCKETS at most)."""
    if "shelf" not in df.columns:
        return df
    return df.where(F.col("shelf").isin([r.shelf for r in nodes.select(_shelf(F.col(node)).alias("shelf")).distinct().collect()])).drop("shelf")


def _identified(d: Directory) -> tuple[DataFrame, DataFrame]:
    """Texts with the id (a hash of 128 bits) of what they say, and each different text once."""
    texts = d.texts.withColumn("tid", F.unhex(F.md5("text")))
    return texts.select("node", "field", "college", "tid"), texts.select("text").distinct().select(F.unhex(F.md5("text")).alias("tid"), "text")


def _indexed(d: Directory) -> Directory:
    """The directory with postings of its different texts: a row for each different gram of a text, and how many of them hold each gram."""
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("text") - GRAM + 1), lambda i: F.substring(F.col("text"), i, F.lit(GRAM))))
    postings = d.strings.where(F.length("text") >= GRAM).select(F.explode(grams).alias("gram"), "tid")
    postings = postings.withColumn("bucket", (F.crc32(F.col("gram").cast("binary")) % BUCKETS).cast("int"))
    return replace(d, postings=postings, grams=postings.groupBy("gram").agg(F.count("*").alias("n")))


def with_postings(d: Directory) -> Directory:
    """The directory with each different text once, and its postings."""
    texts, strings = _identified(d)
    return _indexed(replace(d, texts=texts, strings=strings))


TABLES = ("texts", "edges", "papers", "strings", "postings", "grams")


def write_directory(d: Directory, path: str) -> None:
    """All tables below path, in folders by bucket of the node or text that they are looked up by, postings by that of their gram; so a search reads only what its grams and hits lead to."""
    spark = d.texts.sparkSession
    texts, strings = _identified(d)
    for name, df, key in (("texts", texts, "tid"), ("strings", strings, "tid"), ("edges", d.edges, "src"), ("papers", d.papers, "node")):
        # Small folders meet in a task, large ones are cut into several; equal keys lie together, where they take little room.
        df.withColumn("shelf", _shelf(F.col(key))).hint("rebalance", "shelf").sortWithinPartitions("shelf", key).write.mode("overwrite").partitionBy("shelf").parquet(f"{path}/{name}")
    d = _indexed(replace(d, strings=spark.read.parquet(f"{path}/strings").drop("shelf")))
    d.postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    d.grams.write.mode("overwrite").parquet(f"{path}/grams")


def read_directory(spark: SparkSession, path: str) -> Directory:
    return Directory(**{name: spark.read.parquet(f"{path}/{name}") for name in TABLES})


def hits(d: Directory, words: Sequence[str]) -> DataFrame:
    """Texts (node, field, college) that contain all words, in any case.

    With postings, only different texts that hold the rarest grams of each word are read and looked into; words shorter than a gram, and directories
    without postings, need a look into all of them.
    """
    return _hits(d, [words]).drop("search")


def _lowered(words: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(w.lower() for w in words if w))


def _hits(d: Directory, searches: Sequence[Sequence[str]]) -> DataFrame:
    """The hits of several searches, with their numbers: search, node, field, college. Searches without words find nothing."""
    own = ("search", "node", "field", "college")
    asked = {n: _lowered(words) for n, words in enumerate(searches) if any(words)}
    if d.strings is None or d.postings is None or d.grams is None:
        # One look through all texts serves all searches. A generated text is made once, not again in each condition.
        texts = d.texts.select("node", "field", "college", F.explode(F.array("text")).alias("text"))
        some = {n: P.contains_all(F.col("text"), words) for n, words in asked.items()}
        found = texts.where(reduce(lambda a, b: a | b, some.values())) if some else texts.limit(0)
        numbers = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in some.items()])) if some else F.array().cast("array<int>")
        return found.select(F.explode(numbers).alias("search"), "node", "field", "college").distinct()
    found = S.staged(reduce(DataFrame.unionByName, [_posted(d, words).select(F.lit(n).alias("search"), "tid") for n, words in asked.items()]), "search-found")
    return _near(d.texts, found, "tid").join(found, "tid").select(*own).distinct()


def _posted(d: Directory, words: Sequence[str]) -> DataFrame:
    """Ids (tid) of the stored texts that contain all words."""
    look = lambda df: df.where(P.contains_all(F.col("text"), words))
    grams = {w: [w[i : i + GRAM] for i in range(len(w) - GRAM + 1)] for w in words if len(w) >= GRAM}
    if not grams:
        return look(d.strings).select("tid")
    wanted = sorted({g for some in grams.values() for g in some})
    # As many rows as the words have grams.
    counts = dict(tuple(r) for r in d.grams.where(F.col("gram").isin(wanted)).collect())
    if len(counts) < len(wanted):
        return d.strings.limit(0).select("tid")
    rare = sorted({g for some in grams.values() for g in sorted(set(some), key=lambda g: (counts[g], g))[:RAREST]})
    listed = d.postings.where(F.col("bucket").isin(sorted({_bucket(g) for g in rare})) & F.col("gram").isin(rare))
    likely = S.staged(listed.groupBy("tid").agg(F.count("*").alias("held")).where(F.col("held") == len(rare)).select("tid"), "search-likely")
    return look(_near(d.strings, likely, "tid")).join(likely, "tid").select("tid")


def _is_shown(of: dict[str, Column], years: tuple[int | None, int | None] = (None, None), include: Sequence[tuple[str, str]] = (), exclude: Sequence[tuple[str, str]] = (), subfields: Sequence[str] = (), not_subfields: Sequence[str] = ()) -> Column:
    return P.in_facets(of["group"], of["value"], of["year"], include, exclude, years) & P.tagged(of["subfields"], subfields, not_subfields)


def shown(papers: DataFrame, **facets: object) -> DataFrame:
    """Papers of a year range (years), of included and not of excluded facets (group, value), with one of some subfields and none of others (not_subfields)."""
    return papers.where(_is_shown({c: F.col(c) for c in ("year", "group", "value", "subfields")}, **facets)).select("node")


def shown_publications(publications: DataFrame, **facets: object) -> DataFrame:
    """The same of a directory's publications (see `directory`): a search under these facets needs no texts and edges of others."""
    rows = _filled(publications, **{c: PAPER_FIELDS[c] for c in ("year", "pub_type", "ranking", "subfields")})
    return rows.where(_is_shown(_facets(), **facets)).select(*publications.columns)


def search(d: Directory, words: Sequence[str], **facets: object) -> DataFrame:
    """What the words find, each node once: kind, id, paths. facets: as `shown` takes them. Without words nothing is found."""
    return search_each(d, [words], **facets).drop("search")


def search_each(d: Directory, searches: Sequence[Sequence[str]], **facets: object) -> DataFrame:
    """What each of several searches finds under the same facets: search (its number, from 0), kind, id, paths. The tables are read for all of them at once."""
    if not any(any(words) for words in searches):
        return d.texts.sparkSession.createDataFrame([], "search int, kind string, id string, paths array<string>")
    is_paper = F.col("node").startswith("paper:")

    def allowed(df: DataFrame) -> DataFrame:
        """df without papers that are hidden; an inner join, in which the few hits can be broadcast, not the papers."""
        if not facets:
            return df.where("node is not null")
        papers = df.where(is_paper)
        return df.where(~is_paper).unionByName(papers.join(shown(_near(d.papers, papers), **facets), "node").select(*df.columns))

    hit = S.staged(_hits(d, searches), "search-hits")
    own = hit.where("field = 'matched'").select("search", "node").distinct()
    others = hit.where("field = 'author'").join(own, ["search", "node"], "left_anti")
    names = hit.where("field = 'name'").select("search", "node")
    interests = hit.where("field = 'interests'").join(names, ["search", "node"], "left_anti")
    seeds = S.staged(allowed(reduce(DataFrame.unionByName, [hit.where(F.col("field").isin("college", "name", "title", "course")), interests, others])), "search-seeds")
    follow = F.explode(F.element_at(F.create_map(*[x for field, ways in RULES.items() for x in (F.lit(field), F.array(*[F.struct(F.lit(how).alias("how"), F.lit(path).alias("path")) for how, path in ways]))]), F.col("field")))
    led = seeds.select("search", F.col("node").alias("src"), follow.alias("way")).select("search", "src", "way.how", "way.path").join(_near(d.edges, seeds), ["src", "how"]).select("search", F.col("dst").alias("node"), "path")
    inside = seeds.where("field <> 'college'").select("search", _node("college", "college").alias("node"), F.lit("inside").alias("path")).distinct()
    paths = S.search_paths(*[df.withColumn("id", F.struct("search", "node")).select("id", "path") for df in (seeds.select("search", "node", F.col("field").alias("path")), allowed(led), inside)])
    return paths.select("id.search", F.substring_index("id.node", ":", 1).alias("kind"), F.expr("substring(id.node, instr(id.node, ':') + 1)").alias("id"), "paths")
