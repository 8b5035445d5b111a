"""Search of a directory: each rule, the facets, and postings against a look through all texts."""

import random

import pytest

from rosterspark.plans import jobs, search

COLLEGES = [("North College", "ME Maine"), ("South College", "TX Texas")]
FACULTY = [
    ("f1", "North College", "Ada Berg", "Professor", "Gears, Rings", 1), ("f2", "North College", "Eva Haas", "", "Berg studies", 2), ("f3", "South College", "Bo Ivers", None, None, 3),
    ("f4", "North College", "Ada Berg", "Lecturer", "", 4), ("f5", "North College", "", "", "", 5),
]
PAPERS = [
    ("p1", "North College", "Rings", "Ring Days", "RD", 2020, "conference", "A", ["AI"], ["ada berg"], [("Ada Berg", "North College"), ("Max Outer", "Far Institute")]),
    ("p2", "North College", "Berg lakes", None, None, 2010, "journal", "Q1", ["ML"], ["Eva Haas"], [("Eva Haas", "North College")]),
    ("p3", "South College", "Knots", "", "", 2021, "book", None, None, ["Bo Ivers", "Berg Unlisted"], [("Al Berg", "Far Institute")]),
    ("p4", "South College", "Loops", "", "", 2022, "preprint", "", [], ["Bo Ivers"], [("Al Berg", "Far Institute"), ("Bo Ivers", "South College")]),
]
COURSES = [("c1", "North College", "CS 1", "Intro", ["Ada Berg", "Eva Haas"]), ("c2", "South College", "MA 2", "Knots and Rings", ["Bo Ivers", "No Body"]), ("c3", "North College", None, "Berg walks", None)]


@pytest.fixture(scope="module")
def tables(spark):
    return (
        spark.createDataFrame(COLLEGES, "college string, state string"), spark.createDataFrame(FACULTY, "id string, college string, name string, title string, interests string, pos int"),
        spark.createDataFrame(PAPERS, "id string, college string, title string, venue string, acronym string, year int, pub_type string, ranking string, subfields array<string>, matched array<string>, authors array<struct<name:string,affiliation:string>>"),
        spark.createDataFrame(COURSES, "id string, college string, code string, name string, instructors array<string>"),
    )


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("directory"))
    search.write_directory(search.directory(*tables), path)
    return search.read_directory(spark, path)


def found(df):
    return {r.id: r.paths for r in df.collect()}


def both(tables, stored, words, look=False, **facets):
    """What the postings find and, if asked for, a look through all texts too."""
    got = found(search.search(stored, words, **facets))
    if look:
        assert found(jobs.search_directory(*tables, words, **facets)) == got
    return got


def test_a_name_leads_to_papers_and_courses_interests_do_not(tables, stored):
    got = both(tables, stored, ["ada", "berg"], look=True)
    # Of two people with one name the last listed has the papers and courses; papers match names in any case.
    assert got == {"f1": ["name"], "f4": ["name"], "p1": ["by person"], "c1": ["taught by person"], "North College": ["inside"]}
    assert both(tables, stored, ["studies"]) == {"f2": ["interests"], "North College": ["inside"]}


def test_titles_lead_to_people_alone(tables, stored):
    assert both(tables, stored, ["lakes"]) == {"p2": ["title"], "f2": ["of a paper"], "North College": ["inside"]}
    assert both(tables, stored, ["ring", "RD"]) == {"p1": ["title"], "North College": ["inside"]}  # "ada berg" of p1 is no name exactly as listed
    assert both(tables, stored, ["knots", "rings"]) == {"c2": ["course"], "f3": ["of a course"], "South College": ["inside"]}


def test_outside_authors(tables, stored):
    assert both(tables, stored, ["far institute", "max"]) == {"p1": ["author"], "North College": ["inside"]}
    # p3 has a matched name with the word, so its other authors aren't looked at; that name belongs to nobody.
    got = both(tables, stored, ["berg"], look=True)
    assert "p3" not in got and got["p4"] == ["author"]


def test_a_college_or_state_brings_everything(tables, stored):
    assert both(tables, stored, ["texas"]) == {"South College": ["college"], "f3": ["member"], "p3": ["member"], "p4": ["member"], "c2": ["member"]}
    assert both(tables, stored, ["south", "tx"], look=True, years=(2022, None)).keys() == {"South College", "f3", "p4", "c2"}


def test_hidden_papers_neither_count_nor_lead_on(tables, stored):
    assert both(tables, stored, ["lakes"], years=(2015, None)) == {}
    assert both(tables, stored, ["lakes"], exclude=[("journal", "Q1")]) == {}
    assert both(tables, stored, ["ada", "berg"], include=[("journal", "Q1")]).keys() == {"f1", "f4", "c1", "North College"}
    assert both(tables, stored, ["texas"], include=[("other", "other")]).keys() == {"South College", "f3", "p3", "c2"}
    assert both(tables, stored, ["texas"], subfields=["AI"]).keys() == {"South College", "f3", "c2"}  # papers without tags go once one is asked for
    assert both(tables, stored, ["ada", "berg"], not_subfields=["AI"]).keys() == {"f1", "f4", "c1", "North College"}


def test_odd_words(tables, stored):
    assert both(tables, stored, []) == both(tables, stored, [""]) == both(tables, stored, ["zzz"]) == both(tables, stored, ["lakes", "%"], look=True) == {}
    assert both(tables, stored, ["BERG", "berg", "l"])["p2"] == ["title"]  # short words need a look into all texts, or into those that others leave
    assert "c1" in both(tables, stored, ["cs", "1"])


def test_postings_find_what_a_look_finds(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abc", k=rng.randint(1, 5)))
    faculty = spark.createDataFrame([(f"f{i}", "X", " ".join(word() for _ in range(4)), i) for i in range(200)], "id string, college string, name string, pos int")
    none = spark.createDataFrame([], "id string, college string, title string")
    d = search.directory(spark.createDataFrame([("X",)], "college string"), faculty, none, spark.createDataFrame([], "id string, college string, name string"))
    p = search.with_postings(d)
    texts = {r.node: r.text for r in d.texts.where("field = 'name'").collect()}
    for words in (["abc"], ["ab", "bca"], ["aaaa", "b"]):
        want = {n for n, t in texts.items() if all(w in t for w in words)}
        assert {r.node for r in search.hits(p, words).where("field = 'name'").collect()} == want == {r.node for r in search.hits(d, words).where("field = 'name'").collect()}


def test_a_text_of_many_nodes_is_posted_once(spark):
    """Postings grow with the different texts, not with the rows that hold them."""
    faculty = spark.createDataFrame([(f"f{i}", "X", "Ada Berg", i) for i in range(50)], "id string, college string, name string, pos int")
    none = spark.createDataFrame([], "id string, college string, title string")
    d = search.directory(spark.createDataFrame([("X",)], "college string"), faculty, none, spark.createDataFrame([], "id string, college string, name string"))
    p = search.with_postings(d)
    assert p.postings.where("gram = 'ada'").count() == 2 and p.strings.count() == 3  # the name, the name with its college, and the college
    assert search.hits(p, ["ada"]).where("field = 'name'").count() == search.hits(p, ["a"]).where("field = 'name'").count() == 50
