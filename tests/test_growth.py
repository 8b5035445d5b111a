"""What keeps queries from growing faster than their tables."""

import random

from oracle import SF
from pyspark.sql import functions as F

from rosterspark.functions import text as T
from rosterspark.operators import joins as J
from rosterspark.plans import jobs, search
from rosterspark.queries import QUERIES
from rosterspark.sources import records, web


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_directory_people_carry_no_papers(spark):
    """A college's papers are counted before its people become rows; else each person's row holds all of them."""
    above, _, below = optimized(QUERIES["build_directory"](spark, SF)).partition("Generate explode(faculty")
    assert "publications" in below and "publications" not in above


def test_a_bad_payload_does_not_make_its_batch_single_rows(spark):
    """The reading of good rows doesn't fall back to rows one by one; each bad row still comes with its reason, null payloads and sources too."""
    data = [("p", None if n % 21 == 0 else "x" if n % 7 == 0 else str(n)) for n in range(2100)] + [(None, "a"), ("q", "b")]

    def picky(pdf):
        if pdf.payload.isin(["x", None]).any():
            raise ValueError("bad")
        return pdf.assign(code=pdf.payload, name=str(len(pdf)))

    good, bad = records.by_source(spark.createDataFrame(data, "source string, payload string").coalesce(1), {"p": picky}, ["code", "name"])
    got = good.collect()
    assert sorted(int(r.code) for r in got) == [n for n in range(2100) if n % 7] and max(int(r.name) for r in got) > 500
    errors = [tuple(r) for r in bad.collect()]
    assert errors.count(("p", "ValueError: bad")) == 300 and len(errors) == 302 and ("q", "KeyError: 'q'") in errors


def test_times_are_read_once(spark):
    """The parts of a time are found once and then used, instead of being found again at each use."""
    df = QUERIES["time_ranges"](spark, SF)
    assert optimized(df).count("regexp_extract(") < 30


def test_scored_match_counts_people_of_one_name(spark):
    """Mentions meet counted names, not all people of a surname; what wins is what a look at all pairs finds, odd names included."""
    rng = random.Random(3)
    first = ("ada", "a", "abe", "eva", "e", "", None)
    people = [(n, rng.choice("xy"), rng.choice(first), rng.choice(("berg", "haas", "x y"))) for n in range(14)]
    mentions = [(n, g, f, last) for n, (g, f, last) in enumerate([(g, f, last) for g in "xy" for f in (*first, "zoe") for last in ("berg", "van haas", "none")])] + [(0, "x", "eva", "berg")]
    score = lambda a, b: 0 if a is None or b is None else 2 if a == b else int(a[:1] == b[:1] and 1 in (len(a), len(b)))
    pairs = {}
    for n, g, a, last in mentions:
        pairs.setdefault(n, []).extend((score(a, b), p) for p, h, b, own in people if h == g and own == last.split(" ")[-1])
    tops = {n: [p for s, p in some if s == max(some)[0]] for n, some in pairs.items() if some}
    for alone in (True, False):
        out = J.scored_match(spark.createDataFrame(mentions, "id int, grp string, first string, last string"), spark.createDataFrame(people, "person int, grp string, first string, last string"), "grp", alone)
        assert {(r.id, r.person) for r in out.collect()} == {(n, some[0]) for n, some in tops.items() if len(some) == 1 and (alone or max(pairs[n])[0])}
    assert optimized(out).count("Aggregate [") > 3


def test_coauthors_are_not_grouped_by_all_columns(spark):
    """Peers are found for different lists of institutions; authors themselves are neither spread nor grouped."""
    rows = spark.createDataFrame([("p", n, "x", ["y"], ["Y", " Z "] if n % 2 else ["Q"], "a") for n in range(6)], "paper string, at int, home string, insts array<string>, names array<string>, last string")
    out = J.coauthor_classes(rows, "home", spark.createDataFrame([("Z",)], "name string"), spark.createDataFrame([("x", "a")], "inst string, last string"))
    assert [r.kind for r in out.orderBy("at").collect()] == ["external", "other"] * 3
    assert "Aggregate [paper" not in optimized(out)


def test_searches_look_through_shown_texts_once(spark):
    """Several searches read the texts together, of shown papers alone; each finds what it finds by itself."""
    people = spark.createDataFrame([(f"f{n}", "X", f"Ada Berg{n}") for n in range(9)], "id string, college string, name string")
    papers = spark.createDataFrame([(f"p{n}", "X", "Berg1 lakes", 2000 + n, [f"Ada Berg{n}"]) for n in range(9)], "id string, college string, title string, year int, matched array<string>")
    tables = spark.createDataFrame([("X",)], "college string"), people, papers, spark.createDataFrame([], "id string, college string, name string")
    d, asked = search.directory(*tables), (["berg1"], [], ["ada", "Berg"], ["lakes"], ["no"])
    shown = search.directory(*tables[:2], search.shown_publications(papers, years=(2004, None)), tables[3])
    got = {(r.search, r.kind, r.id, *r.paths) for r in search.search_each(shown, asked).collect()}
    assert got == {(n, r.kind, r.id, *r.paths) for n, words in enumerate(asked) for r in search.search(d, words, years=(2004, None)).collect()} and len(got) > 20
    looks = optimized(search._hits(shown, asked))
    assert looks.count("Join") == 0 and looks.count("written") == 0 and search.shown_publications(papers, years=(2004, None)).count() == 5


def test_works_are_made_once(spark):
    """Linking makes its works once, however often it reads them; an author who matches at one place of a work is its co-author at none."""
    made = spark.sparkContext.accumulator(0)

    def seen(title):
        made.add(1)
        return title

    shape = "id string, title string, type string, publication_year int, authorships array<struct<author:struct<id:string,display_name:string>,institutions:array<struct<ror:string,display_name:string>>>>"
    lists = [(("A1", "Ada Berg"), [("r", "X")]), (("A2", "Bo Haas"), [("r", "X")]), (("A1", "A. Berg-Costa"), [("q", "Y")])]
    data = spark.createDataFrame([(f"W{n}", f"T{n % 3}", "article", 2000 + n, lists) for n in range(9)], shape)
    roster = spark.createDataFrame([("Ada Berg", "X", "r", 1)], "name string, college string, inst string, pos int")
    works = data.withColumn("title", F.udf(seen, "string")("title"))
    out = jobs.link_publications(works, roster, spark.createDataFrame([("Y",)], "name string")).collect()
    assert sorted((r.id, r.matched, r.student_coauthors, r.other_coauthors) for r in out) == [(f"W{n}", ["Ada Berg"], ["Bo Haas"], []) for n in range(3)]
    assert made.value == 9


def test_instructor_lists_are_read_once(spark, monkeypatch):
    """Different lists of instructors are split, read and resolved, not those of every row."""
    stage, staged = jobs.S.staged, {}
    monkeypatch.setattr(jobs.S, "staged", lambda df, label: staged.setdefault(label, stage(df, label)))
    lists = ("Berg, Ada; Bo Haas", "Bo Haas")
    data = [("X", f"202{3 + n % 3}-2{4 + n % 3}", "FS"[n % 2], f"CS {n % 5}", f"Rings {n % 5}", lists[n % 2], "", n) for n in range(120)]
    rows = spark.createDataFrame(data, "college string, academic_year string, term string, course_code string, course_name string, instructor string, url string, pos int")
    out = jobs.build_offerings(rows, spark.createDataFrame([("ada", "X", "Ada Berg"), ("bo", "X", "Bo Haas")], "person string, college string, name string")).collect()
    assert [[[c.on, w] for c, w in zip(r.cells, r.instructors)] for r in out] == [[[True, ["ada", "bo"]], [True, ["bo"]]] * 3] * 5
    assert staged["course-people"].count() == 3


def test_profile_pages_are_read_once(spark):
    """Pages aren't joined with themselves; a page without metrics, name or html gives nulls, and first metrics and years count."""
    row = "<tr><td>Works</td><td>{}</td><td>x</td></tr>"
    span = '<span class="year">{}</span><span class="count">{}</span>'
    pages = [(1, "<h1>A</h1><table>" + row.format(3) + row.format(4) + "</table>" + span.format(2001, 5) + span.format(2001, 6) + span.format(2002, 7)), (2, "<h1>B</h1>"), (3, "<table>" + row.format(1) + "</table>"), (4, None)]
    out = web.profile(spark.createDataFrame(pages, "page int, html string"), "page", "html")
    got = {r.page: (r.name, r.by_year, r.metrics and {k: tuple(v) for k, v in r.metrics.items()}) for r in out.collect()}
    assert got == {1: ("A", {2001: 5, 2002: 7}, {"works": (3, None)}), 2: ("B", {}, None), 3: (None, None, None), 4: (None, None, None)}
    assert "Join" not in optimized(out)


def test_items_are_made_once(spark):
    """What is made of a list before equal items go isn't made again for each item."""
    items = F.transform(F.sequence(F.lit(0), F.lit(400)), lambda n: F.concat(F.lit("k"), (n % 7).cast("string")))
    df = spark.range(1).select(T.distinct_by(items, F.upper).alias("kept"))
    assert df.first().kept == [f"k{n}" for n in range(7)] and spark.sql("select null n").select(T.distinct_by(F.col("n").cast("array<string>"), F.upper)).first()[0] is None
    assert optimized(spark.range(1).select(T.distinct_by(F.sequence(F.lit(0), F.col("id")), lambda n: n % 7).alias("kept"))).count("sequence(") == 1


def test_token_lists_are_made_once(spark):
    """Sets and owners come from one reading of the queries; equal sets in any order have one answer."""
    made = spark.sparkContext.accumulator(0)

    def seen(tokens):
        made.add(1)
        return tokens

    queries = spark.createDataFrame([(n, ["b", "a", "c"] if n % 2 else ["a", "c", "b", "b"]) for n in range(20)], "qid int, tokens array<string>").withColumn("tokens", F.udf(seen, "array<string>")("tokens"))
    titles = spark.createDataFrame([(7, ["a", "b", "c"]), (9, ["c", "b", "a"]), (1, ["a", "b", "x", "y"])], "tid int, tokens array<string>")
    assert sorted(tuple(r) for r in J.token_similarity(queries, titles).collect()) == [(n, 7, 1.0, 1.0) for n in range(20)]
    assert made.value == 20
