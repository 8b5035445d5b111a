"""Worked examples: one row in, one value out."""

import pytest
from pyspark.sql import functions as F

from rosterspark.functions import fields as X
from rosterspark.functions import grammars as G
from rosterspark.functions import text as T
from rosterspark.operators import filters as P

S = F.lit


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def plain(v):
    return tuple(v) if hasattr(v, "asDict") else v


CASES = [
    (lambda: T.collapse(S(" a   b\n c ")), "a b c"),
    (lambda: T.title_key(S("On\\nGraphs: A  Survey!")), "on graphs a survey"),
    (lambda: T.fold(S("  Zoë Ñandú ")), "zoe nandu"),
    (lambda: T.letters(S("O'Brien-Núñez")), "obriennunez"),
    (lambda: T.clean_name(S("Dr. Ada  Berg (she/her) '10")), "Ada Berg"),
    (lambda: T.clean_name(S("Berg, Ada")), "Ada Berg"),
    (lambda: T.clean_name(S("Ada Berg, PhD")), "Ada Berg"),
    (lambda: T.clean_name(S("A")), None),
    (lambda: T.looks_like_name(S("Yi Lu")), True),
    (lambda: T.looks_like_name(S("Of An")), False),
    (lambda: T.looks_like_name(S("Ada van Berg")), True),
    (lambda: T.looks_like_name(S("Read More")), False),
    (lambda: T.looks_like_name(S("Ada")), False),
    (lambda: T.looks_like_name(S(None).cast("string")), False),
    (lambda: T.name_key(S("Ada M. Berg")), ("berg", "a")),
    (lambda: T.name_key(S("Ada")), None),
    (lambda: T.parse_person(S("A. B. Berg")), ("a", "berg")),
    (lambda: T.parse_person(S("Berg, Ada M.")), ("ada", "berg")),
    (lambda: T.parse_person(S("Ada M. Berg")), ("ada", "berg")),
    (lambda: T.parse_person(S("Staff")), None),
    (lambda: T.parse_person(S("Berg")), None),
    (lambda: T.split_people(S("Berg, Ada; Staff; Eva Haas")), ["Berg, Ada", "Eva Haas"]),
    (lambda: T.split_people(S("Ada Berg, Eva Haas")), ["Ada Berg", "Eva Haas"]),
    (lambda: T.split_people(S("TBA")), []),
    (lambda: T.initials(S("Ada M. Berg")), "AB"),
    (lambda: T.initials(S("Ada")), "AD"),
    (lambda: T.initials(S("")), "?"),
    (lambda: T.clean_title(S("Visiting Assistant Professor of Computer Science")), "Visiting Assistant Professor"),
    (lambda: T.clean_title(S("Senior Lecturer")), "Senior Lecturer"),
    (lambda: T.clean_title(S("Professor of History")), None),
    (lambda: T.clean_title(S("Professor Emerita")), None),
    (lambda: T.clean_title(S("Lab Instructor")), "Lab Instructor"),
    (lambda: T.title_category(S("Visiting Professor")), "visiting"),
    (lambda: T.title_category(S("Associate Professor")), "tenured"),
    (lambda: T.title_category(S(None).cast("string")), "tenure_track"),
    (lambda: T.relist(S(" a ;; b "), ";"), "a, b"),
    (lambda: T.relist(S(" ; "), ";"), None),
    (lambda: T.to_int(S("12.9")), 12),
    (lambda: T.to_int(S("x")), None),
    (lambda: T.slug(S("St. Example's College of Somewhere")), "st-example-s-college-of-somewhere"),
    (lambda: T.clean_venue(S("arXiv (Some Library)")), "arXiv"),
    (lambda: T.clean_venue(S("Zenodo (Repository)")), "Zenodo"),
    (lambda: T.clean_venue(S("https://x.example")), None),
    (lambda: T.clean_venue(S("Art &amp; Science")), "Art & Science"),
    (lambda: T.shorten_words(S("International Conference on COMPUTING and Rings")), "Int'l Conf. on Comput. & Rings"),
    (lambda: T.shorten_words(S("Workshop on Computing, Conference; COMPUTING")), "Wksp. on Comput., Conf.; Comput."),
    (lambda: T.shorten_words(S("international workshops")), "int'l wksps."),
    (lambda: T.letters(S("Čapek Ţurcanu-Łukasz")), "capekturcanuukasz"),
    (lambda: T.clean_name(S("Berg, Ada, PhD")), "Ada Berg"),
    (lambda: T.clean_name(S("Ada Berg, Ph.D.")), "Ada Berg"),
    (lambda: T.drop_math_fallback(S("On $$x+y$$ x y and $$z$$ z rings")), "On $$x+y$$ and $$z$$ rings"),
    (lambda: T.drop_math_fallback(S("On $$x+y$$ sums")), "On $$x+y$$ sums"),
    (lambda: T.journal_key(S("The Journal of Rings & Things (Print), JRT")), "journal of rings and things"),
    (lambda: sorted_array(T.title_tokens(S("Proceedings of the 15th ACM Conference on Studies of Rings 2016"))), ["conference", "ring", "study"]),
    (lambda: sorted_array(T.title_tokens(S("Proceedings of the Genetic and Evolutionary Computation Conference"), T.ORDINAL_ONLY)), ["computation", "conference", "evolutionary", "genetic"]),
    (lambda: T.journal_tokens(S("advances in software engineering advances")), ["advances", "software", "engineering"]),
    (lambda: T.distinct_by(F.array(S("Doe,Ann"), S("Doe, Ann"), S("Roe")), lambda x: F.replace(x, S(" "), S(""))), ["Doe,Ann", "Roe"]),
    (lambda: T.strip_flags(S("FYF Pre Rings")), "Rings"),
    (lambda: T.truncate_words(S("one two three"), 8), "one two…"),
    (lambda: T.compact_number(S(1640)), "1.6k"),
    (lambda: T.compact_number(S(11245)), "11.2k"),
    (lambda: T.drop_math_fallback(S("On $$x^2$$ x2 rings")), "On $$x^2$$ rings"),
    (lambda: T.plain_text(S("<b>A&amp;B</b>  c")), "A&B c"),
    (lambda: T.title_and_people(S("Rings (Ada Berg, Eva Haas) (4 credits)")), ("Rings", ["Ada Berg", "Eva Haas"])),
    (lambda: X.absolute_url(S("https://x.example/a/b.html"), S("c.html")), "https://x.example/a/c.html"),
    (lambda: X.absolute_url(S("https://x.example/a/b.html"), S("/c")), "https://x.example/c"),
    (lambda: X.absolute_url(S("https://x.example/a/b.html"), S("a/c")), "https://x.example/a/c"),
    (lambda: X.absolute_url(S("https://x.example"), S("c")), "https://x.example/c"),
    (lambda: X.absolute_url(S("https://x.example/a/"), S("//y.example/z")), "https://y.example/z"),
    (lambda: X.page_link(S("mailto:a@x.example")), None),
    (lambda: X.page_link(S("/p.png")), None),
    (lambda: X.page_link(S("/p")), "/p"),
    (lambda: X.best_link(F.array(S("/z"), S("/people/berg"), S("/berg")), S("Ada Berg")), "/berg"),
    (lambda: X.plausible_link(S("https://x.example/~aberg"), S("Ada Berg")), True),
    (lambda: X.plausible_link(S("https://x.example/contact"), S("Eva Haas")), False),
    (lambda: X.shares_run(S("abcdef"), S("zzcdefz")), True),
    (lambda: X.shares_run(S("abc"), S("abc")), False),
    (lambda: X.page_group(S("https://www.x.example/people/ada/index.html")), "x.example/people"),
    (lambda: X.first_listed(S("['https://a.example', 'b']")), "https://a.example"),
    (lambda: X.first_listed(S("[broken")), None),
    (lambda: G.split_code(S("CPS121 L")), ("CPS 121", "Lab")),
    (lambda: G.split_code(S("CSCI0145A-F25")), ("CSCI 0145", "A")),
    (lambda: G.split_code(S("CSCI 201.001")), ("CSCI 201", "001")),
    (lambda: G.split_code(S("CSC-201-01")), ("CSC 201", "01")),
    (lambda: G.split_code(S("COSC120")), ("COSC 120", "")),
    (lambda: X.pad_digits(S("5L"), 3), "005L"),
    (lambda: X.academic_year(S(2025)), "2025-26"),
    (lambda: X.academic_year(S(1999)), "1999-00"),
    (lambda: X.past_years(S(2025), 2), ["2025-26", "2024-25"]),
    (lambda: X.term_label(S("2021-22"), S("S")), "S22"),
    (lambda: X.term_label(S("2021-22"), S("F")), "F21"),
    (lambda: X.term_label(S("2021-22"), S("")), "21-22"),
    (lambda: G.parse_term(S("Fall 2026")), ("2026-27", "F")),
    (lambda: G.parse_term(S("Spring 2027")), ("2026-27", "S")),
    (lambda: G.parse_term(S("Spring 2026-27")), ("2026-27", "S")),
    (lambda: G.parse_term(S("whenever")), None),
    (lambda: X.to_24h(S("12:40 PM")), "12:40"),
    (lambda: X.to_24h(S("12:05 am")), "00:05"),
    (lambda: X.to_24h(S("noon")), None),
    (lambda: X.military_to_12h(S("1400")), "2:00pm"),
    (lambda: X.military_to_12h(S("0830")), "8:30am"),
    (lambda: X.time_range(S("3:00-4:15pm")), "15:00-16:15"),
    (lambda: X.time_range(S("11:30-12:20pm")), "11:30-12:20"),
    (lambda: X.infer_half(S("1:30")), "13:30"),
    (lambda: X.infer_half(S("9:00")), "09:00"),
    (lambda: X.infer_half(S("0:00")), ""),
    (lambda: X.days_from_text(S("MoWeFr")), "MWF"),
    (lambda: X.days_from_text(S("Tuesday, Thursday")), "TR"),
    (lambda: X.days_from_mask(S(".M.W.F.")), "MWF"),
    (lambda: X.meeting(S("MWF"), S("09:00-09:50"), S("West 112")), "MWF 09:00-09:50 (West 112)"),
    (lambda: X.meeting(S("T"), S("13:00-15:50"), S("")), "T 13:00-15:50"),
    (lambda: X.publication_type(S("Workshop on X"), S("conference"), S(""), S("A"), S("")), "workshop"),
    (lambda: X.publication_type(S("X"), S("journal"), S("preprint"), S(""), S("-")), "journal"),
    (lambda: X.publication_type(S("X"), S("repository"), S(""), S(""), S("-")), "preprint"),
    (lambda: X.findings_parent(S("Findings of the Society: EMNLP")), "EMNLP"),
    (lambda: X.is_subsequence(S("abc"), S("xaybzc")), True),
    (lambda: X.is_subsequence(S("acb"), S("abc")), False),
    (lambda: X.match_level(S("ada"), S("adam"), S("x"), S("y")), "matched_name"),
    (lambda: X.anchored(S("CS 101 Rings MWF 9:00-9:50 am Hall 3 Berg,Ada"))["person"], "Berg,Ada"),
    (lambda: P.is_noise_line(S("  Home: ")), True),
    (lambda: P.is_noise_line(S("(555) 123-4567")), True),
    (lambda: P.is_noise_line(S("12 North Main Street, Town")), True),
    (lambda: P.is_noise_line(S("she/her/hers")), True),
    (lambda: P.is_noise_line(S("Rings and things")), False),
    (lambda: P.is_lab_only(S("Rings Lab")), True),
    (lambda: P.is_lab_only(S("Rings with Lab")), False),
    (lambda: P.is_excluded(S("Senior Capstone in Rings")), True),
    (lambda: P.has_prefix(S(" csci 1")), True),
    (lambda: P.has_multiple_fields(S("Mathematics and Computer Science")), True),
    (lambda: P.needs_processing(S(None).cast("string")), True),
    (lambda: P.needs_processing(S("manual_approved")), False),
]


def sorted_array(c):
    return F.array_sort(c)


@pytest.mark.parametrize("case", range(len(CASES)))
def test_example(spark, case):
    make, expected = CASES[case]
    got = plain(value(spark, make()))
    assert got == expected


def test_natural_order(spark):
    df = spark.createDataFrame([("CS 10",), ("CS 9",), ("AB 100",), ("CS 9L",)], "c string")
    assert [r.c for r in df.orderBy(X.natural_key(F.col("c"))).collect()] == ["AB 100", "CS 9", "CS 9L", "CS 10"]
