"""Linking of publications and tagging of venues: rows written by hand from what the jobs are meant to do."""

import pytest

from rosterspark.functions import constants as K
from rosterspark.operators import joins as J
from rosterspark.plans import jobs

AUTHORSHIPS = "array<struct<author:struct<id:string,display_name:string>,institutions:array<struct<ror:string,display_name:string>>>>"
PLACE = "struct<landing_page_url:string,raw_source_name:string,source:struct<id:string,display_name:string,type:string>>"
TOPICS = "array<struct<display_name:string,subfield:struct<display_name:string>>>"
WORKS = f"id string, doi string, title string, type string, publication_year int, cited_by_count int, authorships {AUTHORSHIPS}, primary_location {PLACE}, topics {TOPICS}"


def author(name, *insts, link=True):
    return ((f"https://o.example/{name}" if link else None, name), [(i, i.upper()) for i in insts])


def work(i, title, kind, year, *authors, **more):
    return {"id": i, "title": title, "type": kind, "year": year, "authors": list(authors), **more}


ADA, FRIEND = author("Ada Berg", "x"), lambda i: author(f"Friend {i}", "z")
MANY = [
    author("Zoe Student", "x"), author("A. Berg", "x"), author("Carl Berg", "x"), author("Two Places", "z", "x"), author("Eva Haas", "z", "y"), author("No Place"), author("Abe Out", "z"),
    author("Un Known", "z", link=False), author("Mono", "x"), author("Own Too", "y", "x"),
]
LINKED = [
    work("a1", "Alone", "article", 2020, ADA), work("m1", "Many", "article", 2020, *MANY), work("b1", "Both", "article", 2020, ADA, author("Eva Haas", "y")),
    # Of one title each: which stays?
    work("d3", "On Rings", "dataset", 2019, ADA), work("d4", "On  rings!", "report", 2021, ADA), work("e1", "Gears", "preprint", 2010, ADA), work("e2", "Gears", "article", 2021, ADA), work("e3", "Gears", "book-chapter", 2001, ADA),
    work("f1", "Knots", "article", None, ADA), work("f2", "Knots", "article", 2021, ADA), work("f3", "Knots", "article", 2021, ADA), work("g1", "Loops", "preprint", 2019, ADA, FRIEND("g1")), work("g2", "Loops", "article", 2020, author("B. Costa", "x"), FRIEND("g2")),
    work("u1", None, "article", 2020, ADA), work("u2", "", "article", 2020, ADA),
    work("w1", "A", None, None, ADA, doi="d1", place=("l1", "raw", ("s1", "Journal", "journal")), topics=[("T1", ("S1",)), ("T1", ("S2",)), (None, None), ("T2", ("S1",))]),
    work("w2", "B", None, None, author("Ada Berg", "x", "x"), author("Out", "z"), doi="", place=("l2", "raw", None)), work("w3", "C", None, None, ADA), work("n1", "Nobody", "article", 2020, author("Abe Out", "z")),
]


@pytest.fixture(scope="module")
def linked(spark):
    rows = [(w["id"], w.get("doi"), w["title"], w["type"], w["year"], 1, w["authors"], w.get("place"), w.get("topics")) for w in LINKED]
    roster = spark.createDataFrame([("Ada Berg", "X", "x", 1), ("Bea Costa", "X", "x", 2), ("Mono", "X", "x", 3), ("Eva Haas", "Y", "y", 4)], "name string, college string, inst string, pos int")
    out = jobs.link_publications(spark.createDataFrame(rows, WORKS), roster, spark.createDataFrame([("Y",), ("PEER",)], "name string"))
    return {(r.id, r.college): r for r in out.collect()}


def test_which_works_stay(linked):
    # Datasets stand with preprints, behind all else but those; untitled works stay apart.
    assert set(linked) == {(i, "X") for i in ("a1", "m1", "b1", "d4", "e2", "f2", "g2", "u1", "u2", "w1", "w2", "w3")} | {("b1", "Y"), ("m1", "Y")}
    assert linked["g2", "X"].matched == ["Ada Berg", "Bea Costa"] and linked["g2", "X"].external_coauthors == ["Friend g2"]


def test_matched_people_are_no_coauthors(linked):
    r = linked["a1", "X"]
    assert r.matched == ["Ada Berg"] and r.faculty_coauthors == r.student_coauthors == r.other_coauthors == r.external_coauthors == []


def test_one_class_an_author_in_their_order(linked):
    r = linked["m1", "X"]
    assert r.matched == ["Ada Berg"]
    # Carl has the surname of one of the roster, Mono's only name is on it; other people of the institution are students, whatever else they belong to.
    assert r.faculty_coauthors == ["Carl Berg", "Mono"] and r.student_coauthors == ["Zoe Student", "Two Places", "Own Too"]
    assert r.other_coauthors == ["Eva Haas"] and r.external_coauthors == ["No Place", "Abe Out", "Un Known"]


def test_a_paper_of_two_colleges_is_seen_from_both(linked):
    assert linked["b1", "X"].other_coauthors == ["Eva Haas"] and linked["b1", "Y"].external_coauthors == ["Ada Berg"]


def test_a_work_keeps_its_fields(linked):
    one, two, three = linked["w1", "X"], linked["w2", "X"], linked["w3", "X"]
    assert (one.url, one.venue, one.venue_url, one.venue_type, one.topics, one.subfields) == ("d1", "Journal", "s1", "journal", ["T1", "T2"], ["S1", "S2"])
    assert (two.url, two.venue, two.venue_url, two.venue_type, two.topics) == ("l2", "raw", "", "", None)
    assert [tuple(a) for a in two.authors] == [("Ada Berg", "Ada Berg", ["X"]), ("Out", "Out", ["Z"])]
    assert (three.url, three.venue, three.cited_by_count) == ("", "", 1)


def test_coauthor_classes_without_institutions(spark):
    rows = spark.createDataFrame([("p", 1, "x", ["x", "y"], ["X", "Y"], "a"), ("p", 2, "x", None, None, "b"), ("p", 3, "x", [], [], "a"), ("p", 4, "x", ["y"], ["  Y "], "a")], "paper string, at int, home string, insts array<string>, names array<string>, last string")
    got = J.coauthor_classes(rows, "home", spark.createDataFrame([("Y",)], "name string"), spark.createDataFrame([("x", "a")], "inst string, last string"))
    assert {r["at"]: r.kind for r in got.collect()} == {1: "faculty", 2: "external", 3: "external", 4: "other"}


CONFERENCES = [("RING", "Conference on Ring Theory", "A*", 1, "u1"), ("GEAR", "Symposium on Gear Systems", "B", 2, "u2"), ("GEAR", "Gear Days", "C", 3, "u3"), ("ACL", "Meeting of Linguists", "A", 4, "u4"), ("S&P", "Privacy Days", "A*", 5, "u5")]
JOURNALS = [("IEEE Transactions on Ring Networking", "Q2", 1, "i1"), ("Ring Letters, RL", "-", 2, "i2"), ("Ring Letters", "", 3, "i3"), ("Gear Studies", "Q3", 4, "i4"), ("Gear Studies", "Q1", 5, "i5"), ("Nature", "Q4", 6, "i6"), ("Conference on Ring Theory", "Q2", 7, "i7")]
RULES = [("RING", "Theory", [r"\bring theory\b"], ["workshop"]), ("Oakland", "Security", [r"security and privacy"], [])]


VENUES = {
    "rule": ("Ring Theory 2020", "conference"), "workshop": ("Workshop on Ring Theory and Knots", "conference"), "bracket": ("Some Meeting (GEAR 21)", "repository"), "title": ("Proceedings of the 5th Symposium on Gear Systems", "journal"),
    "renamed": ("IEEE Security and Privacy", None), "link": ("https://x.example/(GEAR)", "conference"), "conference days": ("Gear Days", "conference"), "journal days": ("Knot Days", "journal"), "series days": ("Loop Days", "book series"),
    "both days": ("Bolt Days", "journal"), "both again": ("Bolt Days", "conference"), "quartile of a conference": ("Rod Studies", "conference"), "quartile of a repository": ("Nature", "repository"), "ordered": ("IEEE/ACM Transactions on Ring Networking", "journal"),
    "other order": ("Studies Gear", "journal"), "best": ("Gear Studies", "journal"), "dash": ("Ring Letters", "journal"), "own": ("science", "journal"), "curated": ("ACM SIGPLAN Notices", "journal"),
    "acl": ("Findings of the Association for Computational Linguistics: ACL", "conference"), "emnlp": ("Findings of the Association for Computational Linguistics: EMNLP", None), "gear": ("Findings of the Society: GEAR", None), "none": ("Findings of the Society: OTHER", None), "blank": ("", "journal"), "missing": (None, None),
}


@pytest.fixture(scope="module")
def tags(spark):
    days = [(f"D{n}", f"{x} Days", "C", 10 + n, None) for n, x in enumerate(("Knot", "Loop", "Bolt"))]
    conferences = spark.createDataFrame([*CONFERENCES, *days], "acronym string, title string, rank string, pos int, url string")
    journals = spark.createDataFrame([*JOURNALS, ("Rod Studies", "Q1", 8, "i8"), ("Science", "Q4", 9, "i9")], "title string, quartile string, pos int, issn string")
    rows = spark.createDataFrame([(n, *v) for n, v in VENUES.items()], "n string, venue string, venue_type string")
    found = jobs.tag_venues(rows, RULES, conferences, journals).collect()
    assert len(found) == len(VENUES)
    return {r.n: r for r in found}


def test_ranks_by_rule_bracket_and_title(tags):
    rule, workshop, bracket = tags["rule"], tags["workshop"], tags["bracket"]
    assert (rule.acronym, rule.area, rule.listed, rule.rank, rule.rank_url) == ("RING", "Theory", True, "A*", "u1")
    assert (workshop.acronym, workshop.listed, workshop.rank) == (None, False, None)
    # What no rule names takes the acronym of its rank.
    assert (bracket.acronym, bracket.listed, bracket.rank, bracket.rank_url) == ("GEAR", False, "B", "u2")
    assert (tags["title"].acronym, tags["title"].rank) == ("GEAR", "B") and (tags["renamed"].acronym, tags["renamed"].rank) == ("Oakland", "A*")
    assert [(tags[n].acronym, tags[n].rank) for n in ("link", "blank", "missing")] == [(None, None)] * 3


def test_journals_have_no_rank_by_title_and_only_journals_have_quartiles(tags):
    assert (tags["conference days"].rank, tags["conference days"].acronym) == ("C", "GEAR (Gear Days)")
    # A venue that is a journal in one row is one in all.
    assert [tags[n].rank for n in ("journal days", "series days", "both days", "both again")] == [None] * 4
    assert [tags[n].quartile for n in ("quartile of a conference", "quartile of a repository", "other order", "conference days")] == [None] * 4
    assert (tags["ordered"].quartile, tags["ordered"].issn) == ("Q2", "i1")


def test_best_quartile_dashes_and_curated_journals(tags):
    assert (tags["best"].quartile, tags["best"].issn) == ("Q1", "i5") and (tags["dash"].quartile, tags["dash"].issn) == ("-", "i2")
    assert (tags["own"].quartile, tags["own"].issn) == ("Q4", "i9") and (tags["curated"].quartile, tags["curated"].issn) == ("Q3", None)
    assert len(K.CURATED_QUARTILES) == 24


def test_findings(tags):
    assert (tags["acl"].acronym, tags["acl"].rank, tags["acl"].rank_url) == ("ACL (Findings)", "A", "u4") and (tags["emnlp"].acronym, tags["emnlp"].rank) == ("EMNLP (Findings)", None)
    assert (tags["gear"].acronym, tags["gear"].rank) == ("GEAR (Findings)", "B") and (tags["none"].acronym, tags["none"].rank) == (None, None)
